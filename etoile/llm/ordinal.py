"""Operator 4, a quality classifier: cumulative-link (ordinal logistic) regression on graded ratings.

Grades 0 < 1 < ... < G have one shared weight vector ``w`` over hashed text features and ordered thresholds:

    P(grade > k) = sigmoid(w.x - theta_k),   theta_0 < theta_1 < ...

so one score orders all texts. It gives the expected grade, sum over k of P(grade > k), and tail probabilities for selection.

Features of a whole text: its distinct lower-cased words (letters and digits; 24-bit buckets), its word shapes (runs of upper case, lower case, digit,
symbol; so that shouting or markup is one feature whatever the words), and the shares in ``SHARES``. A bucket has a weight only
if at least ``MIN_TEXTS`` sample texts have it and its score test against the model without buckets is at least ``SCREEN`` standard errors:
of the very many words of long texts, chance finds next to none.

The fit uses a bounded sample of labelled rows, ``SAMPLE_ROWS`` = 20,000 (the smallest hashes of ``doc_id``), whatever the size
of ``labels``; its features are a few tens of MB. Every document is scored, in one scan without a shuffle; the only
broadcasts are the sample's ids and the weights, bounded by the sample.

Rules. Null text counts as empty. Labels with a null id or grade are left out; several grades of one document are all used.
Without labels the weights are zero, every grade has the same probability, and all documents are selected. Repeated rows are scored each. Ties (equal
scores) are selected alike. Other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etoile.llm.text import Words, chunked, mix, small, utf8

SAMPLE_ROWS = 20_000
MIN_TEXTS, SCREEN = 5, 4.0
BUCKET_BITS = 24
STEPS, RATE, RIDGE = 400, 0.05, 1e-4
SHARES = ("upper", "digit", "symbol", "space", "new_words", "new_lines", "log_words", "word_length")

_CLASS = np.full(256, 3, dtype=np.uint8)                      # 3: symbols
_CLASS[[*map(ord, string.ascii_lowercase), *range(128, 256)]] = 0
_CLASS[[*map(ord, string.ascii_uppercase)]] = 1
_CLASS[[*map(ord, string.digits)]] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_TERM = _CLASS <= 2
_SHAPE = bytes(b"aA9#\n"[c] for c in _CLASS)
_PLAIN = set(b" .,;:'\"!?()-\n")


@dataclass
class Model:
    buckets: np.ndarray       # sorted feature buckets that have a weight
    weights: np.ndarray
    mean: np.ndarray          # of the shares
    scale: np.ndarray
    share_weights: np.ndarray
    thresholds: np.ndarray    # increasing; empty: no labels

    @property
    def fitted(self) -> bool:
        return len(self.buckets) > 0 or bool(np.any(self.share_weights))


def features(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """(distinct buckets of each text, shares of each text)."""
    buckets, shares = [], np.zeros((len(texts), len(SHARES)))
    for i, j in chunked(texts):
        part = texts[i:j]
        lower = Words([t.lower() for t in part], _TERM)
        terms = (lower.hashes(seed=41) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        whole = Words(part)
        tokens = whole.hashes(seed=42)
        shapes = Words([_shape(t) for t in part])
        kinds = (mix(shapes.hashes(seed=43)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        for d, t in enumerate(part):
            own = terms[lower.first[d]:lower.first[d + 1]]
            form = kinds[shapes.first[d]:shapes.first[d + 1]]
            buckets.append(np.unique(np.concatenate([own, form])))
            word = tokens[whole.first[d]:whole.first[d + 1]]
            counts = np.bincount(np.frombuffer(t, dtype=np.uint8), minlength=256)
            kind = np.bincount(_CLASS, weights=counts, minlength=5)
            size, lines = max(len(t), 1), t.split(b"\n")
            symbols = kind[3] - sum(counts[c] for c in _PLAIN if _CLASS[c] == 3)
            shares[i + d] = [kind[1] / size, kind[2] / size, symbols / size, kind[4] / size, len(np.unique(word)) / max(len(word), 1),
                             len(set(lines)) / len(lines), np.log1p(len(word)), size / (len(word) + 1)]
    return buckets, shares


def _shape(text: bytes) -> bytes:
    """The text with every character as its class and runs of a class as one, words kept apart."""
    classes = np.frombuffer(text.translate(_SHAPE), dtype=np.uint8)
    if not len(classes):
        return b""
    return classes[np.concatenate([[True], classes[1:] != classes[:-1]])].tobytes()


def _sample_features(batches):
    for batch in small(batches):
        buckets, shares = features(utf8(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("grade"), pa.array([b.tobytes() for b in buckets], pa.binary()),
             pa.array([s.tobytes() for s in shares], pa.binary())], ["doc_id", "grade", "buckets", "shares"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """``labels``: doc_id and an integer grade from 0."""
    sample = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("grade").cast("int").alias("grade")).where("id is not null and grade is not null")
              .orderBy(F.xxhash64("id"), "id", "grade").limit(sample_rows))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("doc_id", "grade", "text")    # sample_rows ids
    rows = (picked.mapInArrow(_sample_features, "doc_id long, grade int, buckets binary, shares binary").toPandas()
            .sort_values(["doc_id", "grade", "buckets"]).head(4 * sample_rows))
    if not len(rows):
        return Model(np.zeros(0, np.int32), np.zeros(0), np.zeros(len(SHARES)), np.ones(len(SHARES)), np.zeros(len(SHARES)), np.zeros(2))
    return _optimise([np.frombuffer(b, dtype=np.int32) for b in rows["buckets"]], np.stack([np.frombuffer(s) for s in rows["shares"]]),
                     rows["grade"].to_numpy(dtype=np.int64))


def _slopes(score: np.ndarray, theta: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row's log likelihood: derivative by its score, and by the threshold below and above its grade."""
    rows = np.arange(len(grade))
    # P(grade = g) = s_{g-1} - s_g with s_k = P(grade > k); s_{-1} = 1, s_G = 0
    s = _sigmoid(score[:, None] - theta)
    edge = np.zeros((len(grade), 1))
    full, slope = np.concatenate([edge + 1, s, edge], 1), np.concatenate([edge, s * (1 - s), edge], 1)
    prob = np.maximum(full[rows, grade] - full[rows, grade + 1], 1e-12)
    low, high = slope[rows, grade] / prob, slope[rows, grade + 1] / prob
    return low - high, low, high


def _fit(x: np.ndarray, text: np.ndarray, column: np.ndarray, columns: int, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket weights, share weights, thresholds): penalised maximum likelihood by Adam over all rows."""
    rows, levels, wide = len(grade), max(int(grade.max()), 1), x.shape[1]
    above = (grade[:, None] > np.arange(levels)).mean(0).clip(1e-3, 1 - 1e-3)
    theta = np.log((1 - above) / above)
    p = np.concatenate([np.zeros(columns + wide), theta[:1], np.log(np.maximum(np.diff(theta), 0.1))])
    m, v, end = np.zeros_like(p), np.zeros_like(p), columns + wide
    for step in range(1, STEPS + 1):
        w, u, gaps = p[:columns], p[columns:end], np.exp(p[end + 1:])
        theta = np.cumsum(np.concatenate([p[end:end + 1], gaps]))
        by_score, low, high = _slopes(np.bincount(text, weights=w[column], minlength=rows) + x @ u, theta, grade)
        by_theta = np.zeros(levels)
        np.add.at(by_theta, grade[grade > 0] - 1, -low[grade > 0])
        np.add.at(by_theta, grade[grade < levels], high[grade < levels])
        tail = np.cumsum(by_theta[::-1])[::-1]                            # a threshold moves with every step up to it
        g = -np.concatenate([np.bincount(column, weights=by_score[text], minlength=columns), x.T @ by_score, tail[:1], tail[1:] * gaps]) / rows
        g[:end] += RIDGE * p[:end]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:columns], p[columns:end], np.cumsum(np.concatenate([p[end:end + 1], np.exp(p[end + 1:])]))


def _optimise(buckets: list[np.ndarray], shares: np.ndarray, grade: np.ndarray) -> Model:
    names, at, n = np.unique(np.concatenate(buckets), return_inverse=True, return_counts=True)
    text = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
    mean, scale = shares.mean(0), shares.std(0) + 1e-6
    x = np.clip((shares - mean) / scale, -4, 4)
    none = np.zeros(0, dtype=np.int64)
    _, u, theta = _fit(x, none, none, 0, grade)
    rest = _slopes(x @ u, theta, grade)[0]
    total = np.bincount(at, weights=rest[text], minlength=len(names))
    spread = np.sqrt(np.bincount(at, weights=rest[text] ** 2, minlength=len(names)) * 0.5 + n * (rest ** 2).mean() * 0.5) + 1e-12
    chosen = (n >= MIN_TEXTS) & (np.abs(total - n * rest.mean()) >= SCREEN * spread)
    keep = chosen[at]
    w, u, theta = _fit(x, text[keep], (np.cumsum(chosen) - 1)[at[keep]], int(chosen.sum()), grade)
    return Model(names[chosen].astype(np.int32), w, mean, scale, u, theta)


def predict(model: Model, texts: list[bytes]) -> np.ndarray:
    """P(grade > k) of each text, one column per threshold."""
    buckets, shares = features(texts)
    if not model.fitted:
        n = len(model.thresholds)
        return np.tile((n - np.arange(n)) / (n + 1), (len(texts), 1))
    score = np.clip((shares - model.mean) / model.scale, -4, 4) @ model.share_weights
    for i, b in enumerate(buckets):
        if len(model.buckets) and len(b):
            at = np.minimum(np.searchsorted(model.buckets, b), len(model.buckets) - 1)
            score[i] += model.weights[at[model.buckets[at] == b]].sum()
    return _sigmoid(score[:, None] - model.thresholds)


def _scores(shared):
    def run(batches):
        for batch in small(batches):
            above = predict(shared.value, utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(above.sum(1)), pa.array(above[:, -1])],
                                             [*batch.schema.names, "expected_grade", "tail"])
    return run


def grade(docs: DataFrame, labels: DataFrame, select_at: float = 0.5, carry: list[str] | None = None,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text and ``carry`` columns of every row, with expected_grade, tail (probability of the top grade) and selected."""
    model = fit(docs, labels, sample_rows)
    columns = ["doc_id", "text", *(carry or [])]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(carry or []))
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes) + ", expected_grade double, tail double"
    scored = docs.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model)), schema)
    chosen = F.col("tail") >= select_at if model.fitted else F.lit(True)
    return scored.select(*columns, "expected_grade", "tail", chosen.alias("selected"))


def graded(labels: DataFrame) -> DataFrame:
    """The grade of a rated document: 0 for low quality, 1 for good but toxic, 2 for good."""
    return labels.select("doc_id", F.expr("case when quality = 0 then 0 when toxic = 1 then 1 when quality = 1 and toxic = 0 then 2 end").alias("grade"))
