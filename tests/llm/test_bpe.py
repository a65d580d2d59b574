from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken

from etoile.llm import bpe
from llm_helpers import documents

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def texts():
    rnd = random.Random(3)
    alphabet = "aaab eé ñ\n\t 0129.,!?'s😀漢字ßÀ​\x00"
    made = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    return [*made, "", None, "a" * 5000, " " * 3000, "<|endoftext|>", "don't we'll", "é" * 50, "\U0001F469‍\U0001F680" * 20]


def test_ids_equal_tiktoken_and_round_trip(spark):
    rows = list(enumerate(texts()))
    enc = reference()
    out = {r.doc_id: r for r in bpe.encode(documents(spark, rows), PATH, P.PATTERN).collect()}
    back = {r.doc_id: r for r in bpe.decode(bpe.encode(documents(spark, rows), PATH, P.PATTERN), PATH, P.PATTERN).collect()}
    for i, t in rows:
        assert list(out[i].ids) == enc.encode_ordinary(t or "")
        assert back[i].data == (t or "").encode() and back[i].text == (t or "")


def test_offsets_cover_the_characters_of_each_token(spark):
    rows = list(enumerate(texts()))
    codec = bpe.Codec.of(PATH, P.PATTERN)
    for r in bpe.encode(documents(spark, rows), PATH, P.PATTERN).collect():
        t = dict(rows)[r.doc_id] or ""
        at, bounds = 0, np.cumsum([0, *(len(c.encode()) for c in t)])
        for i, s, e in zip(r.ids, r.starts, r.ends):
            n = len(codec.bytes_of[i])
            assert bounds[s] <= at < bounds[s + 1] and bounds[e - 1] < at + n <= bounds[e]
            at += n


def test_digests_and_empty_table(spark):
    rows = list(enumerate(texts()))
    enc = reference()
    for r in bpe.digests(documents(spark, rows), PATH, P.PATTERN).collect():
        t = dict(rows)[r.doc_id] or ""
        ids = np.array(enc.encode_ordinary(t), dtype="<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.digests(documents(spark, []), PATH, P.PATTERN).collect() == []


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    codec = bpe.Codec(PATH, P.PATTERN)
    enc = reference()
    for t in (x for x in texts() if x):
        assert codec.encode([t])[0].tolist() == enc.encode_ordinary(t)
