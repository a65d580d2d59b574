"""Operator 5, exact dedup by deterministic block naming.

A text is cut into blocks of ``block_bytes``; equal blocks get one integer name, adjacent names
are named as pairs, and so on until one name stands for the whole text. Names come from
sorting the distinct blocks (or pairs), so two texts share a name exactly if they are equal.

* A text with a block, or pair, that no other text has is unique at once and needs no name. A
  count of 64-bit fingerprints (eight bytes a block) finds most of these; a bitmap of fixed size tells a
  second scan which texts to ship. Fingerprints only rule texts out; names are given to, and matched by,
  the blocks' content, so no collision can join two texts.
* All groupings combine map-side and all joins back are on counted keys, so that a
  block held by a third of the rows is one row for each task, then a join that Spark splits.

Rules. Null text counts as empty. Texts are equal when identical after lower-casing A-Z. Of
equal texts the row with the largest ``doc_id`` stays (null ids come last; among rows with the
same id exactly one stays). Repeated rows are rows of one group. Other columns are not touched, and may have any
name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.llm.sieve import passes, sieve
from etoile.llm.text import small, utf8
from etoile.session import dematerialize, materialize

BLOCK_BYTES = 4096


def _cut(text: bytes, block_bytes: int) -> list[bytes]:
    return [text[i:i + block_bytes] for i in range(0, len(text), block_bytes)] or [b""]


def _key(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _marks(block_bytes: int):
    """Of each row: a key of the text, and the fingerprints of its blocks."""
    def run(batches):
        for batch in small(batches):
            texts = utf8(batch.column("text"), lower=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(t) for t in texts], pa.int64()),
                 pa.array([[_key(b) for b in _cut(t, block_bytes)] for t in texts], pa.list_(pa.int64()))], ["key", "marks"])
    return run


def _blocks(block_bytes: int, wanted):
    """Of each row: its columns, the digest of the text, and its blocks if its key may be wanted."""
    def run(batches):
        for batch in small(batches):
            texts = utf8(batch.column("text"), lower=True)
            some = passes(wanted.value, np.array([_key(t) for t in texts], dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                 pa.array([_cut(t, block_bytes) if s else None for t, s in zip(texts, some)], pa.list_(pa.binary()))],
                [*batch.schema.names, "text_sha256", "parts"])
    return run


def _named(state: DataFrame, keys: list[str]) -> DataFrame:
    """(row, pos, keys...) -> (row, names): for rows whose every key occurs more than once, the names in order.

    Sorting the distinct keys of each task gives the names; the sorted table is written, so that they hold.
    """
    often = state.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    names = materialize(often.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()), "names")
    sizes = state.groupBy("row").agg(F.count("*").alias("n"))
    held = (state.join(names, keys).groupBy("row")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("s")))     # one row's own blocks
    named = (held.join(sizes, "row").where(F.size("s") == F.col("n"))
             .select("row", F.col("s.name").alias("names")))
    out = materialize(named, "named")
    dematerialize(names)
    return out


def text_names(rows: DataFrame) -> DataFrame:
    """(row, parts) -> (row, depth, name) of the rows whose text occurs more than once; equal depth and
    name: equal texts."""
    state = _named(rows.select("row", F.posexplode("parts").alias("pos", "block")), ["block"])
    done, depth = [], 0
    while True:
        done.append(state.where(F.size("names") == 1).select("row", F.lit(depth).alias("depth"),
                                                             F.col("names")[0].alias("name")))
        rest = state.where(F.size("names") > 1)
        if rest.isEmpty():
            break
        pair = F.transform(F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")), lambda i: F.struct(
            F.get("names", 2 * i).alias("a"), F.coalesce(F.get("names", 2 * i + 1), F.lit(-1)).alias("b")))
        state = _named(rest.select("row", F.posexplode(pair).alias("pos", "p")).select("row", "pos", "p.a", "p.b"), ["a", "b"])
        depth += 1
    return reduce(DataFrame.union, done)


def _identified(docs: DataFrame, block_bytes: int, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, ids). rows: the columns ``keep`` of every row, a number ``row``, and whether it may have an equal (``parts``). ids: those that
    may, with ``depth`` and ``name`` of the text; null where it has no equal."""
    marks = materialize(docs.select("text").mapInArrow(_marks(block_bytes), "key long, marks array<long>")
                        .withColumn("row", F.monotonically_increasing_id()), "marks")
    each = marks.select("row", F.explode("marks").alias("mark"))
    often = materialize(each.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark"), "often")
    alone = each.join(often, "mark", "left_anti").select("row")
    wanted = sieve(marks.join(alone, "row", "left_anti").select("key"))
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", text_sha256 string, parts array<binary>"
    rows = materialize(docs.mapInArrow(_blocks(block_bytes, wanted), schema).select(*keep, "text_sha256", "parts")
                       .withColumn("row", F.monotonically_increasing_id()), "blocks")
    wanted.destroy()
    dematerialize(marks)
    dematerialize(often)
    some = rows.where("parts is not null")
    ids = materialize(some.select("row", "doc_id", "text_sha256").join(text_names(some), "row", "left"), "ids")
    return rows, ids


def _best(ids: DataFrame) -> DataFrame:
    """One row per shared text; written, so that a join with it is of two plain shuffles, which Spark splits at a hot text."""
    return materialize(ids.where("name is not null").groupBy("depth", "name")
                       .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")), "best")


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, ids = _identified(docs, block_bytes, ["doc_id"])
    shared = (ids.join(_best(ids), ["depth", "name"])
              .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"))
    single = rows.where("parts is null").select("doc_id", "text_sha256").union(ids.where("name is null").select("doc_id", "text_sha256"))
    return shared.union(single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                      F.lit(True).alias("kept"), "text_sha256"))


def distinct_texts(docs: DataFrame, columns: list[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns of ``docs`` (doc_id and text among them), of one row for each text: the one that ``exact_groups`` keeps."""
    rows, ids = _identified(docs.select(*columns), block_bytes, columns)
    gone = ids.join(_best(ids), ["depth", "name"]).where(F.col("row") != F.col("best.row")).select("row")
    some = rows.where("parts is not null").join(gone, "row", "left_anti")       # only texts that may have an equal are shuffled
    return rows.where("parts is null").select(*columns).union(some.select(*columns))
