"""Operator 6, quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are grades 0 .. K-1. One set of weights over hashed text features gives a
document's score s; ordered thresholds t_1 < ... < t_{K-1}, shared by all documents, give

    P(grade >= k) = sigmoid(s - t_k)

so the expected grade is the sum of these probabilities, and the probability of the
grades from ``keep_from`` on is the tail that selects.

Features are runs of letters and digits (A-Z folded), the beginnings of longer ones, and runs
of other signs; runs in capitals and runs repeated at once count for two features of their own.
A feature's value is the logarithm of its occurrences. They are computed on bytes by numpy over whole texts, in bounded pieces cut at white space.

The model is fitted on a bounded sample of rated documents (``sample``: as many of each
grade, those that come first by hash; what a rare grade leaves goes to the others), on the
driver: it gets 8 bytes for each distinct feature of a sampled document, counted on the executors,
and a document has at most ``2**bits`` of them. A sampled document weighs as many ratings as it stands for, but a grade counts
for ``_LEAST_SHARE / K`` of all at least, since the ridge would otherwise drown a rare one; the
thresholds are then fitted anew to the true shares. Scoring broadcasts the weights
(4 * 2**bits bytes). All documents are scored.

Null, empty and white-space texts have no features: their score is 0 and the thresholds alone decide.
Documents and ratings that repeat an id: the sample takes one text (the smallest) and the
lowest grade. Null ids and null grades are no ratings. Without ratings there is no model: the
grade and probability are null and every document is kept. Columns of the input are carried
along; one named like an output column raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tripflow.llm.common import bound_batches, materialize, ship

_PIECE = 1 << 20  # bytes hashed at once
_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LEAST_SHARE = 0.3  # of an even share

# Kind of each byte: 0 white space, 1 letter, digit or part of a character beyond ASCII, 2 other sign.
_KIND = np.array([0 if b in (32, 9, 10, 11, 12, 13) else 1 if b >= 128 or chr(b).isalnum() else 2 for b in range(256)], dtype=np.uint8)
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint64)
_CAPITAL = np.array([65 <= b <= 90 for b in range(256)])
_SMALL = np.array([97 <= b <= 122 for b in range(256)])


def _run_features(raw: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, feature), for pieces of text that end at ``ends``, of every run of letters or of signs, of the first four bytes of longer
    runs of letters, and of runs that are in capitals (feature 0) or equal the run of letters before (feature 1)."""
    kind = _KIND[raw]
    starts = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
    own, size = kind[starts], np.diff(np.concatenate((starts, [len(raw)])))
    place = np.arange(len(raw)) - np.repeat(starts, size)
    # Multilinear in the bytes with a factor for each place; places repeat after 256.
    factor = (np.arange(1, 257, dtype=np.uint64) * _MIX | np.uint64(1)) * _PRIME
    each = (_FOLD[raw] + np.uint64(1)) * factor[place & 255]

    def index(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * _MIX
        return (h >> np.uint64(64 - bits)).astype(np.int64)

    whole = np.add.reduceat(each, starts)
    each[place >= 4] = 0
    words, signs = np.flatnonzero(own == 1), np.flatnonzero(own == 2)
    long = words[size[words] > 4]
    begin = np.add.reduceat(each, starts)[long] + _PRIME  # apart from a whole run of those four bytes
    loud = words[(np.add.reduceat(_CAPITAL[raw].astype(np.int64), starts) > 1)[words] & ~np.logical_or.reduceat(_SMALL[raw], starts)[words]]
    piece = np.searchsorted(ends, starts[words], side="right")
    again = words[1:][(whole[words[1:]] == whole[words[:-1]]) & (piece[1:] == piece[:-1])]
    at = np.concatenate([words, signs, long, loud, again])
    fixed = np.repeat(np.array([0, 1]), [len(loud), len(again)])
    return starts[at], np.concatenate([index(whole[words]), index(whole[signs]), index(begin), fixed])


def features(texts: list[bytes | None], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) of all features of a list of texts in UTF-8."""
    keys, counts = [], []
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            raw = np.frombuffer(b" ".join(p for _, p in held) + b" ", dtype=np.uint8)
            ends = np.cumsum([len(p) + 1 for _, p in held])
            at, index = _run_features(raw, ends, bits)
            doc = np.array([d for d, _ in held], dtype=np.int64)[np.searchsorted(ends, at, side="right")]
            k, n = np.unique(doc << bits | index, return_counts=True)
            keys.append(k)
            counts.append(n)
        held, size = [], 0

    for d, text in enumerate(texts):
        for piece in _pieces(text or b""):
            held.append((d, piece))
            size += len(piece) + 1
            if size >= _PIECE:
                flush()
    flush()
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate(counts))
    return key >> bits, key & ((1 << bits) - 1), np.log1p(n)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``_PIECE`` bytes, cut at spaces."""
    at = 0
    while len(text) - at > _PIECE:
        cut = text.find(b" ", at + _PIECE)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights over hashed features and ordered thresholds."""

    bits: int
    weights: np.ndarray  # float32
    thresholds: np.ndarray

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        doc, index, value = features(texts, self.bits)
        return np.bincount(doc, weights=self.weights[index] * value, minlength=len(texts)).astype(np.float64)

    def tails(self, texts: list[bytes | None]) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K-1, one row per text."""
        return _sigmoid(self.scores(texts)[:, None] - self.thresholds[None, :])


def fit(texts: list[bytes | None], grades: np.ndarray, n_grades: int, bits: int = 18, **options) -> OrdinalModel:
    """:func:`fit_features` on the features of ``texts``."""
    return fit_features(*features(texts, bits), grades, n_grades, bits, **options)


def fit_features(doc: np.ndarray, index: np.ndarray, value: np.ndarray, grades: np.ndarray, n_grades: int, bits: int = 18, ridge: float = 3e-4,
                 steps: int = 300, rate: float = 0.05, least_docs: int | None = None, weights: np.ndarray | None = None) -> OrdinalModel:
    """Fit by Adam on the weighted mean negative log-likelihood plus ``ridge`` times the squared weights.

    ``doc``, ``index`` and ``value`` are the documents' features; document k has ``grades[k]``.
    Thresholds are a first one and positive gaps (kept as logarithms), so their order holds. Features of fewer than
    ``least_docs`` documents keep the weight 0 (a twentieth of the rarest grade's documents, 2 to 20, if not given).
    ``weights`` are the ratings that each text stands for (1 if not given).
    """
    n = len(grades)
    seen = np.bincount(grades, minlength=n_grades)
    if least_docs is None:
        least_docs = int(np.clip(seen[seen > 0].min() // 20, 2, 20))
    used = np.flatnonzero(np.bincount(index, minlength=1 << bits) >= least_docs)
    number = np.full(1 << bits, -1, dtype=np.int32)
    number[used] = np.arange(len(used))
    column = number[index]
    common = column >= 0
    # Narrow types: the driver holds 12 bytes for a feature of a document.
    doc, column, value = doc[common].astype(np.int32), column[common], value[common].astype(np.float32)
    true = np.ones(n) if weights is None else weights
    true = true / true.sum()
    share = np.bincount(grades, weights=true, minlength=n_grades)
    raised = true * (np.maximum(share, _LEAST_SHARE / n_grades) / np.where(seen > 0, share, 1))[grades]
    w = np.zeros(len(used))
    free = np.concatenate([[-(n_grades - 2) / 2], np.zeros(n_grades - 2)])  # first threshold, log gaps

    def descend(weight: np.ndarray, params: list[np.ndarray]) -> None:
        """Fit ``params`` in place: the thresholds, and the features' weights if they are among them."""
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        s = np.bincount(doc, weights=w.astype(np.float32)[column] * value, minlength=n)
        for step in range(1, steps + 1):
            t = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
            edges = np.concatenate([[-np.inf], t, [np.inf]])
            upper, lower = _sigmoid(np.clip(edges[grades + 1] - s, -40, 40)), _sigmoid(np.clip(edges[grades] - s, -40, 40))
            p = np.maximum(upper - lower, 1e-12)
            d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
            d_score = weight * (d_upper - d_lower)  # of the loss
            d_t = np.bincount(grades, weights=-weight * d_upper, minlength=n_grades)[:-1] + np.bincount(grades, weights=weight * d_lower, minlength=n_grades)[1:]
            tail = np.cumsum(d_t[::-1])[::-1]
            grads = [np.concatenate([tail[:1], tail[1:] * np.exp(free[1:])])]
            if len(params) > 1:
                grads.append(np.bincount(column, weights=d_score.astype(np.float32)[doc] * value, minlength=len(used)) + 2 * ridge * w)
            for x, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
            if len(params) > 1:
                s = np.bincount(doc, weights=w.astype(np.float32)[column] * value, minlength=n)

    descend(raised / raised.sum(), [free, w])
    if (share[seen > 0] < _LEAST_SHARE / n_grades).any():
        descend(true, [free])
    learnt = np.zeros(1 << bits, dtype=np.float32)
    learnt[used] = w
    return OrdinalModel(bits, learnt, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def per_grade(counts: dict[int, int], sample: int) -> dict[int, int]:
    """How many ratings of each grade a sample takes: as many of each, and what a rare one leaves goes to the others."""
    out, left = {}, sample
    for k, (grade, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[grade] = min(n, left // (len(counts) - k))
        left -= out[grade]
    return out


def rated_sample(spark: SparkSession, docs: DataFrame, grades: DataFrame, sample: int, bits: int, doc_id: str,
                 text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features (document, feature, value), grades and weights of ``sample`` rated ids (fewer if there are fewer): of each
    grade those that come first by hash. Features are counted where the texts are; the driver gets the counts alone."""
    rated = grades.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    counts = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}
    taken = {g: n for g, n in per_grade(counts, sample).items() if n}
    none = np.zeros(0, np.int64)
    if not taken:
        return none, none, np.zeros(0), none, np.zeros(0)

    def first(grade: int, n: int) -> DataFrame:
        """The first ``n`` ids by hash; only those under a bound that leaves somewhat more than ``n`` are sorted."""
        own, h = rated.where(F.col("grade") == grade), F.xxhash64("doc_id")
        share = (n + 10 * n ** 0.5 + 100) / counts[grade]
        if share < 1:
            own = own.where(h < int((share - 0.5) * 2.0 ** 64))
        return own.orderBy(h, "doc_id").limit(n)

    chosen = materialize(spark, reduce(DataFrame.unionByName, [first(g, n) for g, n in sorted(taken.items())]), "rated-sample")
    texts = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).join(chosen, "doc_id")
             .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("grade").cast("int").alias("grade")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, index, value = features([t.as_py() for t in b.column(1)], bits)
            ends = np.searchsorted(doc, np.arange(b.num_rows + 1))
            cut = [(index[x:y].astype(np.int32).tobytes(), value[x:y].astype(np.float32).tobytes()) for x, y in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([x for x, _ in cut], pa.binary()), pa.array([y for _, y in cut], pa.binary())],
                                             names=["doc_id", "grade", "index", "value"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = texts.mapInArrow(counted, f"doc_id {kind}, grade int, index binary, value binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    size = [len(r["index"]) // 4 for r in rows]
    return (np.repeat(np.arange(len(rows), dtype=np.int32), size), np.frombuffer(b"".join(r["index"] for r in rows), np.int32),
            np.frombuffer(b"".join(r["value"] for r in rows), np.float32), np.array([r["grade"] for r in rows], dtype=np.int64),
            np.array([counts[r["grade"]] / taken[r["grade"]] for r in rows], dtype=np.float64))


def classify(spark: SparkSession, docs: DataFrame, grades: DataFrame, n_grades: int, keep_from: int, least_tail: float = 0.4,
             sample: int = 8192, bits: int = 18, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with expected_grade, tail (P(grade >= keep_from)) and kept (tail >= ``least_tail``).

    ``grades`` has doc_id and grade (0 .. n_grades - 1) of rated documents; at most ``sample`` of them train the model.
    The text is carried along (as the last of the input's columns) only if ``keep_text``.
    """
    ship(spark)
    bound_batches(spark)
    new = [StructField("expected_grade", DoubleType()), StructField("tail", DoubleType()), StructField("kept", BooleanType())]
    clash = {f.name for f in new} & set(docs.columns)
    if clash:
        raise ValueError(f"the input already has columns of the result: {sorted(clash)}")
    doc, index, value, known, weights = rated_sample(spark, docs, grades, sample, bits, doc_id, text)
    sent = docs.select(*[f"`{c}`" for c in docs.columns if c != text], f"`{text}`")
    if not len(known):
        return (sent if keep_text else sent.drop(text)).select("*", F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail"), F.lit(True).alias("kept"))
    model = spark.sparkContext.broadcast(fit_features(doc, index, value, known, n_grades, bits, weights=weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tails = model.value.tails([t.as_py() for t in b.column(b.num_columns - 1).cast(pa.binary())])
            tail = tails[:, keep_from - 1]
            own = b.num_columns if keep_text else b.num_columns - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:own], pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= least_tail)],
                                             names=[*b.schema.names[:own], *[f.name for f in new]])

    return sent.mapInArrow(run, StructType([*(sent.schema if keep_text else sent.schema[:-1]), *new]))
