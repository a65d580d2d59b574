"""Operator 1, personal data: patterns, and terms that disclose a protected entity.

Base spans are e-mail addresses, IP addresses, card and phone numbers found by fixed patterns. They are
also the protected entities. Over the distinct texts of the corpus, a term ``t`` and an entity ``e``
that occur together in ``n(t,e)`` texts have

    disclosure  P(e|t) = n(t,e) / n(t)
    information I(t;e) = log2( n(t,e) N / (n(t) n(e)) )     bits

No term has more information of an entity than the entity's own, log2( N / n(e) ) bits. A term that meets ``min_together``,
``min_disclosure`` and ``min_bits`` (or half of the entity's own bits, if that is less) for some entity reveals it, and
every place it stands in any text is a span of kind ``term``: removed where its disclosure is at
least ``remove_at``, else generalised to a placeholder.

Plan. One scan keeps the texts with entities (a small share) with their terms; grouped counts give the pairs
that occur together often enough, and whose terms are not already too common among these texts. Their terms mark a bitmap of fixed size (2^22 bits, the only broadcast), and a
second scan finds base spans and the words that pass the bitmap; joins on the exact word keys then count n(t) over
all texts and pick the spans. A copy of a text is no further evidence: counts are over distinct texts.

A term is a run of ASCII letters, digits and non-ASCII characters outside base spans, A-Z lower-cased; its key is a 64-bit hash.
One of fewer than ``MIN_BYTES`` bytes keeps its case and is a term only if it has a capital, a digit or a non-ASCII character, as
names and codes have; short words all in small letters are never terms.

Rules. Null text counts as empty and has no spans. Null ids, repeated ids and repeated rows are rows like others.
Order of spans: kind as listed, then start; ties do not occur, as spans of a kind never overlap. Other
columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.llm.text import Words, chunked, small
from etoile.session import dematerialize, materialize

KINDS = ("email", "ip", "card", "phone")
MIN_TOGETHER, MIN_DISCLOSURE, MIN_BITS, REMOVE_AT = 3, 0.5, 6.0, 0.9
MIN_BYTES = 4
BITS = 1 << 22

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A match that began inside a run of digits would have begun at its start: the look-behind keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = np.zeros(256, dtype=bool)
_TERM[[*map(ord, string.ascii_letters + string.digits), *range(128, 256)]] = True
_NAMED = _TERM.copy()
_NAMED[[*map(ord, string.ascii_lowercase)]] = False


def _emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = last + len(text[last:at].rstrip(_LOCAL))
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((begin, m.end()))
            last = m.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _parts(address: str) -> list[str]:
    return [p.lstrip("0") for p in address.split(".")]


def _luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, leftmost and not overlapping; matches that fail the kind's test are dropped."""
    ips = [m.span() for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in _parts(m.group()))]
    cards = [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and _luhn(d)]
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15] if "+" in text else []
    return {"email": _emails(text), "ip": ips, "card": cards, "phone": phones}


def _entities(text: str, spans: dict) -> list[str]:
    return sorted({f"{k}:{text[a:b].lower() if k == 'email' else _digits(text[a:b]) if k != 'ip' else text[a:b]}"
                   for k, found in spans.items() for a, b in found})


def _blank(text: str, spans: dict) -> str:
    """The text with spaces in place of its base spans, of the same length."""
    for found in spans.values():
        for a, b in found:
            text = text[:a] + " " * (b - a) + text[b:]
    return text


def _terms(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, indices of the terms, keys). A short word is a term if it is written like a name or a code; its key keeps its case."""
    words, lower = Words(texts, _TERM), Words([t.lower() for t in texts], _TERM)
    named = np.concatenate([[0], np.cumsum(_NAMED[words.buffer])])
    long = words.size >= MIN_BYTES
    keys = np.where(long, lower.hashes(seed=101), words.hashes(seed=102)).view(np.int64)
    return words, np.flatnonzero(long | (named[words.start + words.size] > named[words.start])), keys


def _texts(batch) -> list[str]:
    return ["" if t is None else t for t in batch.column("text").to_pylist()]


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _with_entities(batches):
    """(digest, entities, terms) of the texts that have an entity."""
    for batch in small(batches):
        digests, entities, terms = [], [], []
        for text in _texts(batch):
            spans = base_spans(text)
            if any(spans.values()):
                _, long, keys = _terms([_blank(text, spans).encode()])
                digests.append(_digest(text))
                entities.append(_entities(text, spans))
                terms.append(np.unique(keys[long]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.int64()), pa.array(entities, pa.list_(pa.string())), pa.array(terms, pa.list_(pa.int64()))],
            ["digest", "entities", "terms"])


def _found(bitmap):
    """Base spans of every row, and the places of the words that pass the bitmap."""
    def run(batches):
        marked = np.unpackbits(np.frombuffer(bitmap.value, dtype=np.uint8)).astype(bool)
        for batch in small(batches):
            texts = _texts(batch)
            base = [base_spans(t) for t in texts]
            blank = [_blank(t, s).encode() for t, s in zip(texts, base)]
            places = [([], [], []) for _ in texts]
            for i, j in chunked(blank):
                words, long, keys = _terms(blank[i:j])
                hit = long[marked[keys[long] & (BITS - 1)]]
                begin = np.cumsum([0, *(len(b) + 1 for b in blank[i:j - 1])])
                for w in hit.tolist():
                    row = int(words.text[w])
                    at, b = int(words.start[w] - begin[row]), blank[i + row]
                    start = len(b[:at].decode())
                    for column, v in zip(places[i + row], (int(keys[w]), start, start + len(b[at:at + int(words.size[w])].decode()))):
                        column.append(v)
            joined = [",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in s[k]) for s in base]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([_digest(t) for t in texts], pa.int64()),
                *(pa.array([len(s[k]) for s in base], pa.int64()) for k in KINDS),
                pa.array([hashlib.sha256(j.encode()).hexdigest() for j in joined]), pa.array(joined),
                *(pa.array([p[k] for p in places], pa.list_(kind)) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))),
            ], ["doc_id", "digest", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "keys", "starts", "ends"])
    return run


_FOUND = ("doc_id long, digest long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
          "keys array<long>, starts array<int>, ends array<int>")


def disclosures(docs: DataFrame, min_together: int = MIN_TOGETHER, min_disclosure: float = MIN_DISCLOSURE,
                min_bits: float = MIN_BITS) -> tuple[DataFrame, DataFrame]:
    """(found, terms): every row with its base spans and marked words, and ``key, disclosure, bits`` of revealing terms."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    spark = docs.sparkSession
    private = materialize(docs.select("text").mapInArrow(_with_entities, "digest long, entities array<string>, terms array<long>")
                          .dropDuplicates(["digest"]), "private")
    held = private.select("digest", F.explode("entities").alias("entity"))
    known = held.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= min_together)
    together = (held.join(known, "entity").join(private.select("digest", "terms"), "digest")
                .select("entity", "n_entity", F.explode("terms").alias("key"))
                .groupBy("entity", "n_entity", "key").agg(F.count("*").alias("together")).where(F.col("together") >= min_together))
    # a term's texts with entities are some of all its texts: too many of these alone rule it out (all common words)
    n_private = private.select(F.explode("terms").alias("key")).groupBy("key").agg(F.count("*").alias("n_private"))
    pairs = materialize(together.join(n_private, "key").where(F.col("together") >= F.lit(min_disclosure) * F.col("n_private"))
                        .drop("n_private"), "pairs")
    bitmap = np.zeros(BITS, dtype=bool)
    marks = pairs.select(F.col("key").bitwiseAND(BITS - 1).alias("bit")).distinct().toPandas()["bit"]     # at most BITS rows
    bitmap[marks.to_numpy(dtype=np.int64)] = True
    shared = spark.sparkContext.broadcast(np.packbits(bitmap).tobytes())
    found = materialize(docs.mapInArrow(_found(shared), _FOUND).withColumn("row", F.monotonically_increasing_id()), "found")
    total = found.agg(F.count_distinct("digest")).first()[0]
    n_term = (found.where(F.size("keys") > 0).groupBy("digest").agg(F.first("keys").alias("keys"))
              .select(F.explode(F.array_distinct("keys")).alias("key")).groupBy("key").agg(F.count("*").alias("n_term")))
    own = F.log2(F.lit(float(total)) / F.col("n_entity"))             # of the entity; no term has more
    terms = (pairs.join(n_term, "key")
             .withColumn("disclosure", F.col("together") / F.col("n_term"))
             .withColumn("bits", F.log2(F.col("together") * F.lit(float(total)) / F.col("n_term") / F.col("n_entity")))
             .where((F.col("disclosure") >= min_disclosure) & (F.col("bits") >= F.least(F.lit(float(min_bits)), own / 2)))
             .groupBy("key").agg(F.max("disclosure").alias("disclosure"), F.max("bits").alias("bits")))
    terms = materialize(terms, "terms")
    dematerialize(private)
    dematerialize(pairs)
    return found, terms


def find_spans(docs: DataFrame, **thresholds) -> DataFrame:
    """Per row: doc_id, digest, n_email, n_ip, n_card, n_phone, base_sha256, spans (``kind:start:end``, comma-joined), and the
    revealing terms as ``terms`` (array of start, end, disclosure)."""
    found, terms = disclosures(docs, **thresholds)
    places = (found.where(F.size("keys") > 0)
              .select("row", F.explode(F.arrays_zip("keys", "starts", "ends")).alias("p")).select("row", "p.*")
              .join(terms, F.col("keys") == F.col("key"))
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("starts", "ends", "disclosure"))).alias("terms")))
    extra = F.transform("terms", lambda p: F.concat_ws(":", F.lit("term"), p["starts"], p["ends"]))
    return (found.select("row", "doc_id", "digest", *(f"n_{k}" for k in KINDS), "base_sha256", "base")
            .join(places, "row", "left")
            .withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<starts:int,ends:int,disclosure:double>>")))
            .withColumn("spans", F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.concat_ws(",", extra)))
            .withColumn("spans", F.when(F.size("terms") == 0, F.col("base")).otherwise(F.col("spans")))
            .drop("row", "base"))


def _clean(remove_at: float):
    def run(batches):
        for batch in small(batches):
            out = []
            for text, terms in zip(_texts(batch), batch.column("terms").to_pylist()):
                cuts = [(a, b, f"[{k.upper()}]") for k, found in base_spans(text).items() for a, b in found]
                cuts += [(p["starts"], p["ends"], "" if p["disclosure"] >= remove_at else "[TERM]") for p in terms or ()]
                made, last = [], 0
                for a, b, put in sorted(cuts):
                    if a >= last:
                        made += [text[last:a], put]
                    last = max(last, b)
                out.append("".join([*made, text[last:]]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])
    return run


def sanitise(docs: DataFrame, remove_at: float = REMOVE_AT, **thresholds) -> DataFrame:
    """doc_id and the text with its base spans as ``[KIND]`` and revealing terms removed or as ``[TERM]``."""
    spans = find_spans(docs, **thresholds).where(F.size("terms") > 0).groupBy("doc_id", "digest").agg(F.first("terms").alias("terms"))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    keyed = docs.mapInArrow(_keyed, "doc_id long, text string, digest long")
    s = spans.alias("s")
    joined = keyed.alias("d").join(s, F.expr("d.doc_id <=> s.doc_id and d.digest = s.digest"), "left").select("d.doc_id", "d.text", "s.terms")
    return joined.mapInArrow(_clean(remove_at), "doc_id long, text string")


def _keyed(batches):
    for batch in small(batches):
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([_digest(t) for t in _texts(batch)], pa.int64())],
                                         ["doc_id", "text", "digest"])
