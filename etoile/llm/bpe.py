"""Operator 7, byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

``Codec`` builds a byte-level BPE model of the library from a rank file. Each byte stands as one
printable character (the byte table); the vocabulary and the merges are written in those
characters. A merge list is derived from the ranks: a token's two parts are what merging its
bytes with the lower ranks leaves. Texts are cut by the pattern, and every distinct piece of a
batch is encoded once; a bounded cache keeps pieces between batches.

Decoding goes back through the byte table. Tokens can end inside a character: bytes are exact
for the whole sequence, and ``offsets`` gives for every token the code points that its bytes
touch, so that a character split over tokens belongs to each of them.

Rules. Null text counts as empty and has no tokens. Special tokens are not recognised: their strings are
ordinary text. Whole texts are encoded, however long; each row is on its own, so ties, repeated rows and nulls
in other columns have no effect, and other columns may have any name. An empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from etoile.llm.text import small

CACHE_PIECES = 400_000        # pieces kept between batches; then the older half goes
GROUP_CHARS = 2_000_000       # code points encoded together


def byte_table() -> dict[int, str]:
    """Byte -> the character that stands for it: printable Latin-1 bytes for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _parts(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``."""
    pieces = [token[i:i + 1] for i in range(len(token))]
    while len(pieces) > 2:
        known = [(r, i) for i in range(len(pieces) - 1) if (r := ranks.get(pieces[i] + pieces[i + 1], rank)) < rank]
        if not known:
            raise ValueError(f"rank {rank} is no merge of two lower ranks")
        _, i = min(known)
        pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]
    return pieces[0], pieces[1]


class Codec:
    """Encodes and decodes with the ranks of one vocabulary; one per Python worker."""

    _kept: dict[tuple[str, str], Codec] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._kept:
            cls._kept[path, pattern] = cls(path, pattern)
        return cls._kept[path, pattern]

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a task has one core: the library's threads would only wait for each other
        ranks = read_ranks(path)
        table = byte_table()
        as_text = lambda b: "".join(map(table.__getitem__, b))
        merges = [tuple(map(as_text, _parts(t, r, ranks)))
                  for t, r in sorted(ranks.items(), key=lambda x: x[1]) if len(t) > 1]
        self.model = Tokenizer(models.BPE(vocab={as_text(t): r for t, r in ranks.items()}, merges=merges))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cut = regex.compile(pattern).findall
        back = {c: b for b, c in table.items()}
        self.bytes_of = {r: bytes(map(back.__getitem__, t)) for t, r in self.model.get_vocab().items()}      # the byte table, reversed
        self.size_of = np.zeros(max(self.bytes_of) + 1, dtype=np.int64)
        for r, t in self.bytes_of.items():
            self.size_of[r] = len(t)
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        pieces = [self.cut(t) for t in texts]
        fresh = list({p for ps in pieces for p in ps if p not in self.cache})
        if len(self.cache) + len(fresh) > CACHE_PIECES:
            self.cache = dict(itertools.islice(self.cache.items(), len(self.cache) // 2, None))              # the older half goes
            fresh = list({p for ps in pieces for p in ps if p not in self.cache})
        for i in range(0, len(fresh), 20_000):
            part = fresh[i:i + 20_000]
            for piece, e in zip(part, self.model.encode_batch_fast(part, add_special_tokens=False)):
                self.cache[piece] = np.array(e.ids, dtype="<u4").tobytes()
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, ps)), dtype="<u4") for ps in pieces]

    def decode(self, ids: np.ndarray) -> bytes:
        """The exact bytes; decode these as UTF-8 only for a whole sequence."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in code points; both ends of a split character count it."""
        if not len(ids):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        end = np.cumsum(self.size_of[ids])
        lead = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        char = np.cumsum(lead) - 1                       # code point index of every byte
        return char[end - self.size_of[ids]].astype(np.int32), (char[end - 1] + 1).astype(np.int32)


def _groups(texts: list[str]):
    """Ranges of texts of at most GROUP_CHARS together (a longer one alone)."""
    i, n = 0, 0
    for j, t in enumerate(texts):
        if n and n + len(t) > GROUP_CHARS:
            yield i, j
            i, n = j, 0
        n += len(t)
    if i < len(texts):
        yield i, len(texts)


def _each(batches, path: str, pattern: str, make, names: list[str], schema: list):
    codec = Codec.of(path, pattern)
    for batch in small(batches):
        texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
        for i, j in _groups(texts):
            made = [make(codec, ids) for ids in codec.encode(texts[i:j])]
            columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(schema)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *columns], ["doc_id", *names])


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = True) -> DataFrame:
    """doc_id, ids (array<int>), and with ``offsets`` starts and ends (array<int>, code points), of each row's text."""
    names = ["ids", "starts", "ends"] if offsets else ["ids"]

    def make(codec, ids):
        return (ids.astype(np.int32), *(codec.offsets(ids, codec.decode(ids)) if offsets else ()))

    def run(batches):
        return _each(batches, path, pattern, make, names, [pa.list_(pa.int32())] * len(names))
    return _two(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} array<int>" for n in names))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, starts, ends as ``encode`` gives them, and ``text``: the text decoded from the ids, for each row's text."""
    def make(codec, ids):
        data = codec.decode(ids)
        return (ids.astype(np.int32), *codec.offsets(ids, data), data.decode("utf-8", "replace"))

    def run(batches):
        return _each(batches, path, pattern, make, ["ids", "starts", "ends", "text"], [pa.list_(pa.int32())] * 3 + [pa.string()])
    return _two(docs).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>, text string")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data (binary), text (string; bytes that are no whole character become U+FFFD) from ``ids``; null ids: empty."""
    def run(batches):
        codec = Codec.of(path, pattern)
        for batch in batches:
            data = [codec.decode(np.array(ids or [], dtype=np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(data, pa.binary()),
                 pa.array([d.decode("utf-8", "replace") for d in data], pa.string())], ["doc_id", "data", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary, text string")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, decode and take offsets of each whole text; return their counts and digests.

    ``offsets_sha256`` covers the starts, then the ends, as little-endian 32-bit integers.
    """
    def make(codec, ids):
        data = codec.decode(ids)
        starts, ends = codec.offsets(ids, data)
        return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(data).hexdigest(),
                hashlib.sha256(starts.tobytes() + ends.tobytes()).hexdigest())

    def run(batches):
        return _each(batches, path, pattern, make, ["n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256"],
                     [pa.int64(), pa.string(), pa.string(), pa.string()])
    return _two(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_sha256 string")


def _two(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
