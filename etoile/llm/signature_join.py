"""Operator 2, n-gram Jaccard join by signature trees, and its groups of linked documents.

Each document is the set of its distinct ``k``-word shingles (A-Z lower-cased; 64-bit keys). Two documents link when |A n B| / |A u B| is at
least ``num / den``. A *signature tree* over some sets, in order of size, has for each node the OR of its sets' token bitmaps, the least and largest size and the
least number of bits. Two trees (or one with itself) are traversed together from their roots: a pair of nodes is pruned when their
size ranges, or the largest overlap their bitmaps leave possible, rule out a link below. Bits of X outside Y's bitmap are tokens of X outside Y, so a
pair of sets with sizes x, y and d such bits can link only if x - d >= t / (1 + t) (x + y).

Distributed plan.

1. Equal sets are one *representative* (a grouped key), so that copies cost one row. Sets whose key nothing else may have are their own, and are not shuffled.
2. Routing. With t = num / den, sets that link share one of the first |X| - ceil(t |X|) + 1 tokens of both, in any order of tokens that all sets share. The
   order is by how often a token occurs, in fine classes from a count-min sketch of fixed size (8 MB, a broadcast), then by key: what many documents share comes last.
   A bucket is such a token in a band of sizes. A band is ``BAND`` times as wide as sizes that link can be apart, so most representatives are in one; those near its upper
   end are also in the next, there with the first |X| - ceil(2t / (1 + t) |X|) + 1 tokens, which are enough for the smaller of two sets. Only buckets that two
   representatives are in are made: bitmaps of fixed size of those met twice, of two hashes, let most others go before anything is shuffled, and what is left is counted by
   token alone, so that buckets of one cost a shuffled token each at most, however full the bitmaps are. Buckets hold bitmaps and sizes, not sets.
3. In each bucket one tree is traversed with itself, and the surviving pairs' *coarse* components go on as at most one edge per member (never as pairs).
   A bucket of more than ``BUCKET`` members is cut; a task takes two parts of it.
4. Representatives of a coarse component meet with their whole sets: a tree again, then the exact overlap of every pair that it leaves, each pair once.
   Components of more than ``BLOCK`` representatives meet in blocks and pairs of blocks. A task keeps the number of links of each member and one edge to the smallest
   member it reaches, not the pairs. Link counts are weighted by copies, so copies are never expanded.

Rules. Null text counts as empty. With fewer than ``k`` words the whole sequence is one shingle; without words the set is empty and links with
nothing. The component's id is its smallest ``doc_id`` (nulls aside; null if it has no other). Repeated rows are equal sets, a row each. Ties do not matter: a component does not depend on
order. Other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.llm.components import components, sized
from etoile.llm.lists import pack, unpack
from etoile.llm.sieve import passes, sieve, split
from etoile.llm.text import Words, chunked, mix, release, small, utf8, window_hashes
from etoile.session import dematerialize, materialize

SKETCH_BITS = 22            # counters of the order's sketch (32 bits each)
SLICE_BITS = 16             # counters that are added up in one row
STEPS = 64                  # classes of counts per doubling
COMPARED_BYTES = 1 << 23          # bitmaps of node pairs compared at once, on each side
BUCKET = 4096               # members of a bucket that meet in one task
BLOCK = 1024                # whole sets that meet in one task
BAND = 4                    # factors of den / num in a band of sizes
FANOUT = 8
GATHERED = 1 << 21          # tokens of sets compared with one set at once (and a set more)


# ------------------------------------------------------------------ sets

def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle keys of each (lower-cased) text."""
    out = []
    for i, j in chunked(texts):
        words = Words(texts[i:j])
        hashes = words.hashes(seed=7)
        grams = mix(window_hashes(hashes, k) ^ np.uint64(k))
        for a, b in zip(words.first[:-1], words.first[1:]):
            if b - a >= k:
                out.append(np.unique(grams[a:b - k + 1]))
            elif b > a:
                out.append(mix(window_hashes(hashes[a:b], int(b - a)) ^ np.uint64(b - a)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def _texts(batch) -> list[bytes]:
    return utf8(batch.column("text"), lower=True)


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _token_counts(k: int):
    """(slice, counts): this task's counters, in slices."""
    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in small(batches):
            texts = _texts(batch)
            for i, j in chunked(texts):
                cells, n = np.unique(_cells(np.concatenate(shingle_sets(texts[i:j], k))), return_counts=True)
                total[cells] += n.astype(np.uint32)
        for i, part in enumerate(total.reshape(-1, 1 << SLICE_BITS)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pack(part)], pa.binary())], ["slice", "counts"])
    return run


def _sum_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    """Class of each counter of a slice, in ``STEPS`` to a doubling: below the mean too, low counters hold fewer of the tokens that several documents share."""
    total = np.zeros(1 << SLICE_BITS, dtype=np.uint64)
    for blob in pdf["counts"]:
        total += unpack(blob, np.uint32)[0]
    classes = (STEPS * np.log2(1.0 + total)).astype(np.uint16)
    return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "classes": [classes.tobytes()]})


def token_classes(docs: DataFrame, k: int) -> np.ndarray:
    """Class of each counter of the sketch, over all documents."""
    rows = (docs.select("text").mapInArrow(_token_counts(k), "slice int, counts binary").groupBy("slice")
            .applyInPandas(_sum_counts, "slice int, classes binary").collect())            # 64 rows, 8 MB in all
    out = np.zeros((1 << (SKETCH_BITS - SLICE_BITS), 1 << SLICE_BITS), dtype=np.uint16)
    for r in rows:
        out[r.slice] = np.frombuffer(r.classes, dtype=np.uint16)
    return out.reshape(-1)


def _prefix(tokens: np.ndarray, classes: np.ndarray, num: int, den: int) -> np.ndarray:
    n = len(tokens)
    p = n - -(-num * n // den) + 1
    order = np.lexsort((mix(tokens), classes[_cells(tokens)]))
    return tokens[order[:p]]


def width_bits(n: int) -> int:
    """log2 of a bitmap's bits: about a bit per token, 64 to 2^15."""
    return int(np.clip(int(n - 1).bit_length() if n > 1 else 0, 6, 15))


def bitmap(tokens: np.ndarray) -> bytes:
    bits = width_bits(len(tokens))
    at = np.zeros(1 << bits, dtype=bool)
    at[(tokens & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
    return np.packbits(at, bitorder="little").tobytes()


def _describe(k: int, shared, num: int, den: int, carry: tuple[str, ...] = ()):
    """Of each row: id, size of its set, 128-bit key of the set, routing tokens, bitmap and the columns of ``carry``."""
    def run(batches):
        classes = shared.value
        for batch in small(batches):
            sets = shingle_sets(_texts(batch), k)
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            halves = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                pa.array([_prefix(s, classes, num, den).view(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary()), *(batch.column(c) for c in carry)],
                ["doc_id", "size", "key1", "key2", "route", "bits", *carry])
    return run


_DESCRIBED = "doc_id long, size long, key1 long, key2 long, route array<long>, bits binary"


# ------------------------------------------------------------------ trees

class Tree:
    """Signature tree over sets in order of size: level 0 has the sets, each level above a node per FANOUT of the one below."""

    def __init__(self, bits: np.ndarray, size: np.ndarray):
        self.words, self.low, self.high = [bits], [size], [size]
        self.ones = [np.bitwise_count(bits).sum(1, dtype=np.int64)]
        while len(self.words[-1]) > 1:
            at = np.arange(0, len(self.words[-1]), FANOUT)
            self.words.append(np.bitwise_or.reduceat(self.words[-1], at, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], at))
            self.high.append(np.maximum.reduceat(self.high[-1], at))
            self.ones.append(np.minimum.reduceat(self.ones[-1], at))

    def __len__(self) -> int:
        return len(self.words[0])


def _possible(s: Tree, t: Tree, level: int, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether a link is possible below each pair of nodes (a of s, b of t) of a level."""
    share = num / (num + den)
    low_a, high_a, low_b, high_b = s.low[level][a], s.high[level][a], t.low[level][b], t.high[level][b]
    fits = (high_a * den >= num * low_b) & (high_b * den >= num * low_a)
    out = np.zeros(len(a), dtype=bool)
    at = np.flatnonzero(fits)
    step = max(256, COMPARED_BYTES // (8 * s.words[level].shape[1]))
    for i in range(0, len(at), step):
        p = at[i:i + step]
        both = np.bitwise_count(s.words[level][a[p]] & t.words[level][b[p]]).sum(1, dtype=np.int64)
        beyond_a = np.maximum(s.ones[level][a[p]] - both, 0)      # tokens of any set of a that no set of b has, at least
        beyond_b = np.maximum(t.ones[level][b[p]] - both, 0)
        out[p] = (((1 - share) * high_a[p] - share * low_b[p] >= beyond_a - 1e-6) &
                  ((1 - share) * high_b[p] - share * low_a[p] >= beyond_b - 1e-6))
    return out


def _children(pairs: tuple[np.ndarray, np.ndarray], n_a: int, n_b: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(FANOUT * FANOUT)
    a = (pairs[0][:, None] * FANOUT + step // FANOUT).reshape(-1)
    b = (pairs[1][:, None] * FANOUT + step % FANOUT).reshape(-1)
    keep = (a < n_a) & (b < n_b)
    if same:
        keep &= a <= b
    return a[keep], b[keep]


def traverse(s: Tree, t: Tree, num: int, den: int, apart):
    """Yield index pairs (a of s, b of t) that may link, some at a time; s is t: pairs a < b.

    ``apart(a, b)``: which pairs of sets are still of interest.
    """
    same = s is t
    if not len(s) or not len(t):
        return
    while len(s.words) < len(t.words):
        _lift(s)
    while len(t.words) < len(s.words):
        _lift(t)
    stack = [(len(s.words) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        level, a, b = stack.pop()
        if level == 0:
            keep = apart(a, b) & (a < b) if same else apart(a, b)
            a, b = a[keep], b[keep]
        keep = _possible(s, t, level, a, b, num, den)
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if level == 0:
            yield a, b
            continue
        for i in range(0, len(a), 1 << 12):                      # at most 2^18 pairs at once
            c = _children((a[i:i + (1 << 12)], b[i:i + (1 << 12)]), len(s.words[level - 1]), len(t.words[level - 1]), same)
            stack.append((level - 1, *c))


def _lift(tree: Tree) -> None:
    """One more level above a root, to meet a higher tree."""
    for x in (tree.words, tree.low, tree.high, tree.ones):
        x.append(x[-1])


def _fold(raw: bytes, bits: int) -> np.ndarray:
    """A bitmap at a smaller width: the OR of its parts (a bit's number modulo the width)."""
    return np.bitwise_or.reduce(np.frombuffer(raw, dtype=np.uint64).reshape(-1, 1 << (bits - 6)), axis=0)


class Groups:
    """Components of the members of one task's group; ``label`` is the smallest index of a member's component."""

    def __init__(self, label: np.ndarray):
        self.label = label

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the component of each a with that of its b."""
        label = self.label
        while (label[a] != label[b]).any():
            least = np.minimum(label[a], label[b])
            root = np.arange(len(label))
            np.minimum.at(root, label[a], least)
            np.minimum.at(root, label[b], least)
            while (root != root[root]).any():
                root = root[root]
            label = root[label]
        self.label = label


def pairs_of(size: np.ndarray, raw: list[bytes], num: int, den: int, groups: Groups | None, part: np.ndarray | None = None):
    """Yield arrays (a, b) of members that may link, each pair once. With ``groups``, only pairs of different ones; with ``part`` (0 or 1), only of one of each."""
    def apart_in(at, other):
        return lambda a, b: groups.label[at[a]] != groups.label[other[b]] if groups else np.ones(len(a), dtype=bool)

    wide = np.array([width_bits(int(n)) for n in size])
    sides = range(2) if part is not None else [None]
    by = {(g, w): np.flatnonzero((wide == w) & (part == g if g is not None else True)) for g in sides for w in np.unique(wide)}
    by = {k: v[np.argsort(size[v], kind="stable")] for k, v in by.items() if len(v)}

    def tree(at, w):
        return Tree(np.stack([_fold(raw[i], w) for i in at]), size[at].astype(np.int64))

    for (g, w), at in by.items():
        for (h, v), other in by.items():
            if part is not None and (g, h) != (0, 1) or part is None and v < w:
                continue
            least = min(w, v)
            # widths differ by a doubling of the size; a link needs sizes within num / den
            if size[at].max() * den < num * size[other].min() or size[other].max() * den < num * size[at].min():
                continue
            s = tree(at, least)
            t = s if other is at else tree(other, least)
            for a, b in traverse(s, t, num, den, apart_in(at, other)):
                yield at[a], other[b]


# ------------------------------------------------------------------ coarse components in buckets

def _grouped(batches, key: list[str]):
    """Consecutive rows of equal key, as Arrow tables; a group may run over batches."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in key]
        new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)])
        starts = np.append(np.flatnonzero(new), batch.num_rows)
        for a, b in zip(starts[:-1], starts[1:]):
            here = tuple(c[a] for c in columns)
            if here != held_key and held:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            held_key = here
    if held:
        yield held_key, pa.Table.from_batches(held)
    del held
    release()


def _bucket_edges(num: int, den: int, cross: bool):
    """Coarse edges (u, v) of buckets: each member to the smallest of its local component.

    ``cross``: a group is two parts of a bucket, and only pairs between them count.
    """
    key = ["token", "pair"] if cross else ["token"]

    def run(batches):
        edges, held = [], 0
        for _, g in _grouped(batches, key):
            rep = g.column("rep").to_numpy()
            if len(rep) < 2:
                continue
            size = g.column("size").to_numpy()
            if len(rep) == 2 and (size.min() * den < num * size.max()):
                continue
            part = g.column("part").to_numpy() if cross else None
            groups = Groups(np.arange(len(rep)))
            for a, b in pairs_of(size, g.column("bits").to_pylist(), num, den, groups, part):
                groups.join(a, b)
            # by the smallest member, whatever the order of rows
            least = np.full(len(rep), np.iinfo(np.int64).max)
            np.minimum.at(least, groups.label, rep)
            least = least[groups.label]
            out = least != rep
            edges.append(np.stack([rep[out], least[out]]))
            held += len(edges[-1][0])
            if held > 500_000:
                yield _edges(edges)
                edges, held = [], 0
        if held:
            yield _edges(edges)
    return run


def _edges(parts: list[np.ndarray]) -> pa.RecordBatch:
    e = np.unique(np.concatenate(parts, axis=1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(e[0].copy()), pa.array(e[1].copy())], ["u", "v"])


def _part_of(rep, parts):
    return F.pmod(F.xxhash64(rep), parts).cast("int")


def _two_parts(rows: DataFrame, key: str) -> DataFrame:
    """Rows with ``parts`` and ``part`` -> a row for each other part: ``pair`` names the two parts, ``part`` is 0 for the smaller one."""
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    out = rows.withColumn("other", other).where("other <> part")
    pair = F.least("part", "other").cast("long") * F.lit(1 << 31) + F.greatest("part", "other")
    return out.withColumn("pair", pair).withColumn("part", (F.col("part") > F.col("other")).cast("int")).drop("other", "parts")


def _bucket_keys(batch, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the buckets of each representative: one per routing token in its band of sizes and, if a larger set of the next band may link with it, one there
    for each of the tokens that the smaller of two needs.
    """
    route = batch.column("route")
    tokens = route.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    n = np.diff(route.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), n)
    size = batch.column("size").to_numpy()
    step = max(np.log(den / num) * (1 + 1e-9), 1e-9)             # a little more, for rounding
    at = np.log(np.maximum(size, 1))
    band, upper = (np.floor(x / (BAND * step)).astype(np.uint64) for x in (at, at + step))
    fewer = size - 2 * num * size // (num + den) + 1             # at least as many as with the quotient rounded up
    nth = np.arange(len(tokens)) - np.repeat(np.cumsum(n) - n, n)
    also = np.flatnonzero((upper > band)[row] & (nth < fewer[row]))
    keys = [mix(tokens ^ mix(band)[row]), mix(tokens[also] ^ mix(upper)[row[also]])]
    return np.concatenate([row, row[also]]), np.concatenate(keys).view(np.int64)


def _passing(keys: np.ndarray, sieves) -> np.ndarray:
    """Which keys all sieves let through; the seed of each is its place."""
    some = np.arange(len(keys))
    for seed, bitmap in enumerate(sieves):
        some = some[passes(bitmap.value, keys[some], seed)]
    return some


def _all_keys(num: int, den: int, *sieves):
    """(token): the buckets that all sieves let through."""
    def run(batches):
        for batch in batches:
            keys = _bucket_keys(batch, num, den)[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys[_passing(keys, sieves)])], ["token"])
    return run


def _routed(shared, num: int, den: int):
    """(token, rep, size): the buckets that others may be in too."""
    def run(batches):
        for batch in batches:
            row, keys = _bucket_keys(batch, num, den)
            some = _passing(keys, [shared])
            row = pa.array(row[some])
            yield pa.RecordBatch.from_arrays([pa.array(keys[some]), batch.column("rep").take(row), batch.column("size").take(row)],
                                             ["token", "rep", "size"])
    return run


def routes(reps: DataFrame, num: int, den: int) -> DataFrame:
    """(token, rep, size) of the buckets that two representatives or more are in."""
    routing = reps.select("size", "route")
    often = sieve(routing.mapInArrow(_all_keys(num, den), "token long"), twice=True)
    again = sieve(routing.mapInArrow(_all_keys(num, den, often), "token long"), twice=True, seed=1)
    left = routing.mapInArrow(_all_keys(num, den, often, again), "token long")
    shared = materialize(left.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token"), "shared")
    known = sieve(shared)
    some = reps.select("rep", "size", "route").mapInArrow(_routed(known, num, den), "token long, rep long, size long")
    out = materialize(some.join(shared, "token", "left_semi"), "routed")
    dematerialize(shared)
    for bitmap in (often, again, known):
        bitmap.destroy()
    return out


def coarse_edges(reps: DataFrame, num: int, den: int) -> DataFrame:
    routed = routes(reps, num, den)
    who = [F.count("*").alias("members"), F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.bit_xor(F.xxhash64("rep")).alias("x"),
           F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"), F.min("size").alias("least"), F.max("size").alias("most")]
    # two members of sizes too far apart are no bucket; buckets of the same members (two texts share many tokens) are one
    counts = (routed.groupBy("token").agg(*who).where(f"members > 2 or (members = 2 and {den} * least >= {num} * most)")
              .groupBy("members", "lo", "hi", "x", "y").agg(F.min("token").alias("token")).select("token", "members"))
    counts = materialize(counts, "buckets")
    rows = materialize(routed.select("token", "rep").join(counts, "token").join(reps.select("rep", "size", "bits"), "rep")
                       .select("token", "rep", "size", "bits", "members"), "members")
    dematerialize(routed)
    parts = F.ceil(F.col("members") / F.lit(BUCKET)).cast("int")
    small = rows.where(F.col("members") <= BUCKET)
    edges = (small.repartition("token").sortWithinPartitions("token")
             .select("token", "rep", "size", "bits").mapInArrow(_bucket_edges(num, den, False), "u long, v long"))
    large = rows.where(F.col("members") > BUCKET).withColumn("parts", parts).withColumn("part", _part_of(F.col("rep"), F.col("parts")))
    if not large.isEmpty():
        each = large.withColumn("token", F.xxhash64("token", "part"))
        edges = edges.union(each.repartition("token").sortWithinPartitions("token").select("token", "rep", "size", "bits")
                            .mapInArrow(_bucket_edges(num, den, False), "u long, v long"))
        two = _two_parts(large, "token")
        edges = edges.union(two.repartition("token", "pair").sortWithinPartitions("token", "pair").select("token", "pair", "part", "rep", "size", "bits")
                            .mapInArrow(_bucket_edges(num, den, True), "u long, v long"))
    out = materialize(edges.distinct(), "coarse")
    dematerialize(rows)
    dematerialize(counts)
    return out


# ------------------------------------------------------------------ exact links in coarse components

class Overlap:
    """Exact sizes of intersections of the sets of one task's group; memory is linear in the sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
        again = (np.bincount(at) > 1)[at]                         # a token of one set is in no intersection
        self.at = at[again]
        self.first = np.concatenate([[0], np.cumsum(np.add.reduceat(again.astype(np.int64), np.cumsum(self.size) - self.size))])
        self.marked = np.zeros(len(tokens), dtype=np.uint8)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """|A n B| of each pair (a, b): the tokens of an a are marked once for all its b."""
        out = np.zeros(len(a), dtype=np.int64)
        order = np.argsort(a, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(a[order]) != 0]))
        for i, j in zip(starts, np.append(starts[1:], len(a))):
            mine = self.at[self.first[a[order[i]]]:self.first[a[order[i]] + 1]]
            self.marked[mine] = 1
            ends = np.cumsum(np.diff(self.first)[b[order[i:j]]])
            cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], GATHERED)), j - i))
            for p, q in zip(np.append(0, cuts), cuts):
                out[order[i + p:i + q]] = self._hits(b[order[i + p:i + q]])
            self.marked[mine] = 0
        return out

    def _hits(self, b: np.ndarray) -> np.ndarray:
        n = self.first[b + 1] - self.first[b]
        begin = np.cumsum(n) - n
        hits = np.cumsum(self.marked[self.at[np.repeat(self.first[b] - begin, n) + np.arange(n.sum())]], dtype=np.int64)
        hits = np.append(0, hits)
        return hits[begin + n] - hits[begin]


def _exact_links(num: int, den: int, key: list[str], cross: bool):
    """(u, v, links) of the members of each group that have links there: the smallest member reached, and the rows linked with."""
    def run(batches):
        for _, g in _grouped(batches, key):
            rep = g.column("rep").to_numpy()
            if len(rep) < 2:
                continue
            copies = g.column("copies").to_numpy()
            sets = [unpack(t, np.uint64)[0] for t in g.column("tokens").to_pylist()]
            part = g.column("part").to_numpy() if cross else None
            size = np.array([len(s) for s in sets])
            bits = [bitmap(s) for s in sets]
            overlap = Overlap(sets)
            del sets
            groups, links = Groups(np.arange(len(rep))), np.zeros(len(rep), dtype=np.int64)
            for a, b in pairs_of(size, bits, num, den, None, part):
                both = overlap(a, b)
                hit = both * den >= num * (size[a] + size[b] - both)
                a, b = a[hit], b[hit]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                groups.join(a, b)
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(rep[groups.label[some]]), pa.array(links[some])], ["u", "v", "links"])
    return run


def _meet(rows: DataFrame, key: list[str], num: int, den: int, cross: bool = False) -> DataFrame:
    columns = [*key, "rep", "copies", "tokens", *(["part"] if cross else [])]
    return (rows.select(*columns).repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(_exact_links(num, den, key, cross), "u long, v long, links long"))


def exact_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """``members``: rep, copies, cluster, n (members of the cluster), tokens.

    (u, v, links): edges u - v whose components are those of all links, and how many rows of other sets u links with (to be added up by u).
    """
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    rows = (members.withColumn("parts", parts).withColumn("part", _part_of(F.col("rep"), F.col("parts")))
            .withColumn("block", F.xxhash64("cluster", "part")))
    links = _meet(rows, ["block"], num, den)
    large = rows.where("parts > 1").drop("block")
    if not large.isEmpty():
        links = links.union(_meet(_two_parts(large, "cluster"), ["cluster", "pair"], num, den, cross=True))
    return materialize(links, "links")


def _sets_of(k: int, wanted):
    """(key1, key2, tokens) of the distinct sets whose key may be wanted, once per task and batch."""
    def run(batches):
        seen: set[bytes] = set()
        for batch in small(batches):
            rows = []
            for s in shingle_sets(_texts(batch), k):
                digest = xxhash.xxh3_128_digest(s.tobytes())
                if len(s) and digest not in seen and passes(wanted.value, np.frombuffer(digest, dtype=np.int64)[:1])[0]:
                    if len(seen) > 200_000:
                        seen = set()
                    seen.add(digest)
                    rows.append((digest, pack(s)))
            halves = np.frombuffer(b"".join(d for d, _ in rows), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array([t for _, t in rows], pa.binary())],
                                             ["key1", "key2", "tokens"])
    return run


# ------------------------------------------------------------------ operator

def jaccard_components(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, n_links, class_id, and the columns of ``carry`` (longs); a table of ``materialize``.

    ``n_links``: other rows that the row links with. ``class_id`` names the row's component also where ids are null or repeated (null for an empty set); its
    values differ from run to run.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    context = docs.sparkSession.sparkContext
    classes = context.broadcast(token_classes(docs, k))
    schema = ", ".join([_DESCRIBED, *(f"{c} long" for c in carry)])
    described = materialize(docs.mapInArrow(_describe(k, classes, num, den, carry), schema), "described")
    rows = materialize(described.select("doc_id", "size", "key1", "key2", *carry), "rows")
    full = described.where("size > 0").drop(*carry)
    repeated = sieve(full.select("key1"), twice=True)
    own, maybe = split(full, "key1", repeated)                  # most sets are of one row, and stay where they are
    reps = (own.select("key1", "key2", F.col("doc_id").alias("least"), F.lit(1).cast("long").alias("copies"), "size", "route", "bits")
            .union(maybe.groupBy("key1", "key2")
                   .agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("route").alias("route"),
                        F.first("bits").alias("bits")))
            .withColumn("rep", F.monotonically_increasing_id()))
    routing = materialize(reps, "routing")
    dematerialize(described)
    classes.destroy()
    repeated.destroy()
    reps = materialize(routing.select("rep", "key1", "key2", "least", "copies"), "reps")
    coarse = coarse_edges(routing, num, den)
    dematerialize(routing)
    nodes = 2 * coarse.count()                                                                # at most
    clusters = components(coarse).select(F.col("node").alias("rep"), F.col("label").alias("cluster"))
    counted = clusters.join(clusters.groupBy("cluster").agg(F.count("*").alias("n")), "cluster")
    placed = materialize(sized(counted.join(reps.select("rep", "key1", "key2", "copies"), "rep"), nodes), "placed")
    dematerialize(coarse)
    wanted = sieve(placed.select("key1"))
    sets = docs.select("text").mapInArrow(_sets_of(k, wanted), "key1 long, key2 long, tokens binary")
    members = materialize(placed.join(sets.dropDuplicates(["key1", "key2"]), ["key1", "key2"]).drop("key1", "key2"), "sets")
    dematerialize(placed)
    wanted.destroy()
    links = exact_links(members, num, den)
    dematerialize(members)
    label = components(links.select("u", "v")).select(F.col("node").alias("rep"), "label")
    count = links.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    linked = materialize(sized(label.join(count, "rep"), nodes), "linked")
    dematerialize(links)
    labelled = (reps.select("rep", "key1", "key2", "least", "copies").join(linked, "rep", "left")
                .withColumn("class_id", F.coalesce("label", "rep"))
                .withColumn("n_links", F.col("copies") - 1 + F.coalesce("links", F.lit(0))))
    least = labelled.groupBy("class_id").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "class_id").select("key1", "key2", "component_id", "n_links", "class_id")
    full = rows.where("size > 0").join(named, ["key1", "key2"])
    empty = (rows.where("size = 0").withColumn("component_id", F.col("doc_id"))
             .withColumn("n_links", F.lit(0).cast("long")).withColumn("class_id", F.lit(None).cast("long")))
    columns = ["doc_id", F.col("size").alias("n_shingles"), "component_id", "n_links", "class_id", *carry]
    out = materialize(full.select(*columns).union(empty.select(*columns)), "classes")
    for table in (rows, reps, linked):
        dematerialize(table)
    return out
