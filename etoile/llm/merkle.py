"""Operator 13, Merkle manifest of a dataset: a tree per group, a tree over their roots, and octopus multiproofs.

``H`` is the lowercase hex SHA-256 of its inputs laid end to end, digests as hex text. A row's leaf is ``H`` of its fields, each ``-`` if null, else its UTF-8 byte count,
``:`` and its value. In each group leaves ascend by key; two neighbours (a last one alone) become their ``H``, until one node is left: the group's
root. The groups' roots, in order of the group (null first, then bytewise), make a tree of the same kind, whose root names the whole dataset.

1. ``number``: leaves are sorted over ranges of (group, key) and numbered by two-level counting: position in the partition plus the counts of the
   group in the partitions before. No task sees a whole group.
2. ``climb``: a leaf partition is a block of 2^BLOCK_LEVELS numbered leaves, whatever group it is of. One task a block computes the nodes above it; the blocks'
   roots are numbered leaves again for the next 2^BLOCK_LEVELS leaves, until every tree has one. Only nodes from the block roots up are kept.
3. ``prove``: each leaf partition computes the minimal union of node coordinates that its proofs need and its own leaves do not give (``missing``), all
   of them are fetched by one join, the interiors that the proofs share are derived once, and each leaf's proof and its folded root are expanded locally.

Plan. The rows' text is only read, hashed in the JVM and never shuffled; a leaf is some 100 bytes. A hot group is many ranges and many blocks. Per block some
2 x log2(rows) coordinates are joined; the upper nodes that many blocks ask for have one row each, so a hot one is a skewed side that adaptive execution splits. The only windows run
over one row per partition and group.

Rules. Null keys come first; rows of one key stand by leaf hash; equal rows are leaves of their own. Empty and very long texts are values like others. A group of one row is
its own root; one group's root is the dataset's. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from etoile.session import dematerialize, materialize

BLOCK_LEVELS = 10                     # a leaf partition has 2^BLOCK_LEVELS leaves at most
TOP = "top"                           # name of the tree over the groups' roots; groups' own begin with "=" or are empty
NODE = "tree string, level int, index long, hash string"


def digest(*fields: Column) -> Column:
    """Leaf hash of a row's fields."""
    return F.sha2(F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string"))) for c in fields]), 256)


def tree_name(group: Column) -> Column:
    """A name for each group that sorts as the groups do: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def combine(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def above(size: int) -> int:
    """Nodes one level above ``size`` nodes."""
    return (size + 1) // 2


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    return int(size - 1).bit_length() if size > 1 else 0


def missing(leaves: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(level, index) of the nodes that the proofs of these leaves need and the leaves themselves do not give; each once."""
    out, level, held = [], 0, np.unique(leaves)
    while size > 1:
        beside = held ^ 1
        beside = beside[beside < size]
        out += [(level, int(i)) for i in np.setdiff1d(beside, held)]
        held, size, level = np.unique(held >> 1), above(size), level + 1
    return out


def climb(hashes: list[str], first: int, size: int, levels: int) -> list[list[str]]:
    """Nodes over consecutive ones of a tree's level that holds ``size``, level by level, up to ``levels`` or the root. ``first`` is a multiple of 2^levels."""
    out = [hashes]
    while size > 1 and len(out) <= levels:
        hashes = [combine(hashes[i:i + 2]) for i in range(0, len(hashes), 2)]
        out.append(hashes)
        size = above(size)
    return out


@dataclass
class Manifest:
    leaves: DataFrame                 # tree, index, key, leaf, other, size of the tree, place and number of the tree among all
    nodes: DataFrame                  # tree, level, index, hash: from the blocks' roots up; of the tree over the groups, all


def number(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, key, leaf, other) with ``index`` in the tree, by key and leaf, and the tree's ``size``."""
    rows = materialize(leaves.select("tree", "key", "leaf", "other", F.monotonically_increasing_id().alias("row")), "merkle-leaves")   # equal rows can be told apart
    order = ["tree", "key", "leaf", "other", "row"]
    ranges = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row").withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    at = ranges.withColumn("part", F.shiftright("at", 33))           # the id's upper bits are the partition, the lower ones the row in it
    runs = at.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("tree", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(W.partitionBy("tree")).alias("size"))
    out = materialize(at.join(runs, ["tree", "part"]).select("tree", (F.col("at") - F.col("first") + F.col("before")).alias("index"), "key", "leaf", "other", "size"),
                      "merkle-numbered")
    for spent in (rows, ranges):
        dematerialize(spent)
    return out


def _climb_blocks(level: int, lowest: int | None):
    """Of one block of a tree's level: the nodes ``lowest`` or more levels above it (None: only the last one, the block's or the tree's root)."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("index")
        tree, first, size = block["tree"].iat[0], int(block["index"].iat[0]), int(block["size"].iat[0])
        made = climb(block["hash"].tolist(), first, size, BLOCK_LEVELS)
        rows = [(tree, level + up, (first >> up) + i, h) for up, hashes in enumerate(made) if up >= (len(made) - 1 if lowest is None else lowest)
                for i, h in enumerate(hashes)]
        return pd.DataFrame(rows, columns=["tree", "level", "index", "hash"])
    return run


def upper_nodes(leaves: DataFrame, every_level: bool = False) -> DataFrame:
    """Nodes of all trees from the roots of their leaf partitions up; with ``every_level``, the leaves and all nodes."""
    step = 1 << BLOCK_LEVELS
    largest = leaves.agg(F.max("size")).first()[0] or 0
    now, level, nodes = leaves.select("tree", "index", F.col("leaf").alias("hash"), "size"), 0, None
    while True:
        lowest = 1 if level else 0 if every_level else None
        made = materialize(now.groupBy("tree", F.shiftright("index", BLOCK_LEVELS).alias("_block")).applyInPandas(_climb_blocks(level, lowest), NODE), "merkle-nodes")
        nodes = made if nodes is None else nodes.unionByName(made)
        if largest <= step:
            return nodes
        sizes = now.where(F.col("index") == 0).select("tree", F.ceil(F.col("size") / step).alias("size")).where("size > 1")     # one row a tree
        level, largest = level + BLOCK_LEVELS, -(-largest // step)
        now = made.where(F.col("level") == level).join(sizes, "tree").select("tree", "index", "hash", "size")


def _height(size: Column) -> Column:
    """``height`` as a column: the digits of size - 1 in binary."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0)


def build(leaves: DataFrame) -> Manifest:
    """The trees over ``leaves``: tree (``tree_name`` of the group), key, leaf, and ``other``: a leaf to be checked in its place (null: itself)."""
    leaves = number(leaves)
    nodes = upper_nodes(leaves)
    sizes = leaves.where(F.col("index") == 0).select("tree", "size")
    roots = (nodes.join(sizes, "tree").where((F.col("level") == _height(F.col("size"))) & (F.col("index") == 0))
             .select(F.lit(TOP).alias("tree"), F.col("tree").alias("key"), F.col("hash").alias("leaf"), F.lit(None).cast("string").alias("other")))
    groups = number(roots)
    nodes = nodes.unionByName(upper_nodes(groups, every_level=True))
    place = groups.select(F.col("key").alias("tree"), F.col("index").alias("place"), F.col("size").alias("trees"))
    return Manifest(leaves.join(place, "tree"), nodes)


def _coordinates(batches):
    """The nodes that each leaf partition asks for: what its proofs miss, in its own tree and in the one above, and the two roots."""
    for pdf in batches:
        out = []
        for b in pdf.itertuples(index=False):
            own = missing(np.arange(b.first, b.last + 1), b.size) + [(height(b.size), 0)]
            over = missing(np.array([b.place]), b.trees) + [(height(b.trees), 0)]
            out += [(b.tree, b.block, name, level, i) for name, some in ((b.tree, own), (TOP, over)) for level, i in dict.fromkeys(some)]
        yield pd.DataFrame(out, columns=["of_tree", "of_block", "tree", "level", "index"])


def expand(held: dict[int, str], size: int, given: dict[tuple[int, int], str]) -> dict[int, list[tuple[str, int]]]:
    """Proof of each of the ``held`` leaves of a tree of ``size``: per level the sibling ("": none) and its side (1: right).

    ``given`` are the nodes that ``missing`` names. Interior nodes that proofs share are derived once.
    """
    paths, at, level = {i: [] for i in held}, {i: i for i in held}, 0
    while size > 1:
        def node(i):
            return held[i] if i in held else given[level, i]
        steps = {i: (node(i ^ 1) if i ^ 1 < size else "", 1 - (i & 1)) for i in held}
        for leaf, path in paths.items():
            path.append(steps[at[leaf]])
            at[leaf] >>= 1
        held = {p: combine([node(i) for i in (2 * p, 2 * p + 1) if i < size]) for p in {i >> 1 for i in held}}
        size, level = above(size), level + 1
    return paths


def fold(leaf: str, path: list[tuple[str, int]]) -> str:
    """The root that a leaf and its proof give."""
    for sibling, right in path:
        leaf = combine([leaf, sibling] if right else [sibling, leaf])
    return leaf


def _prove_block(leaves: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
    if not len(leaves):
        return pd.DataFrame({c: [] for c in ("tree", "key", "leaf", "subroot", "root", "proof", "folded_root")})
    tree, size, place, trees = (leaves[c].iat[0] for c in ("tree", "size", "place", "trees"))
    hashes: dict[bool, dict] = {False: {}, True: {}}
    for name, level, i, h in zip(given["tree"], given["level"], given["index"], given["hash"]):
        hashes[name == TOP][level, i] = h
    subroot, root = hashes[False][height(size), 0], hashes[True][height(trees), 0]
    upper = expand({int(place): subroot}, trees, hashes[True])[place]
    paths = expand(dict(zip(leaves["index"], leaves["leaf"])), size, hashes[False])
    proofs = [paths[i] + upper for i in leaves["index"]]
    return pd.DataFrame({
        "tree": tree, "key": leaves["key"], "leaf": leaves["leaf"], "subroot": subroot, "root": root,
        "proof": [[s for s, _ in p if s] for p in proofs],
        "folded_root": [fold(o if isinstance(o, str) else h, p) for o, h, p in zip(leaves["other"], leaves["leaf"], proofs)]})


def prove(manifest: Manifest) -> DataFrame:
    """tree, key, leaf, subroot, root, proof (siblings from the leaf to the root), folded_root (of ``other``, else the leaf)."""
    kind = manifest.leaves.schema["key"].dataType
    leaves = manifest.leaves.withColumn("block", F.shiftright("index", BLOCK_LEVELS)).withColumn("key", F.col("key").cast("string"))
    blocks = leaves.groupBy("tree", "block").agg(F.min("index").alias("first"), F.max("index").alias("last"), *[F.first(c).alias(c) for c in ("size", "place", "trees")])
    wanted = blocks.mapInPandas(_coordinates, "of_tree string, of_block long, tree string, level int, index long")
    given = wanted.join(manifest.nodes, ["tree", "level", "index"])
    out = (leaves.groupBy("tree", "block").cogroup(given.groupBy("of_tree", "of_block"))
           .applyInPandas(_prove_block, "tree string, key string, leaf string, subroot string, root string, proof array<string>, folded_root string"))
    return out.withColumn("key", F.col("key").cast(kind))
