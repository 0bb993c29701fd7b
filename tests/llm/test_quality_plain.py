"""Operator 6 against a plain form: features by regular expressions and whole numbers, the likelihood over a dense matrix."""

import math
import re
from collections import Counter

import duckdb
import numpy as np

from tests.conftest import SF_SMALL
from tripflow.llm import quality_model as qm
from tripflow.llm.queries import GOOD, N_GRADES, QUERIES

BITS, WORD64 = 18, (1 << 64) - 1
MIX, PRIME = 0x9E3779B97F4A7C15, 0x100000001B3


def hashed(run: bytes) -> int:
    """The sum of (byte + 1) times the odd factor of its place."""
    return sum((b + 1) * (((k % 256 + 1) * MIX | 1) * PRIME) for k, b in enumerate(run.lower())) & WORD64


def slot(h: int) -> int:
    return ((h ^ h >> 31) * MIX & WORD64) >> 64 - BITS


def plain_features(text: str | None) -> dict[int, float]:
    runs = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t\n\x0b\x0c\r]+", (text or "").encode())
    found, before = Counter(), None
    for run in runs:
        found[slot(hashed(run))] += 1
        if not re.match(rb"[0-9A-Za-z\x80-\xff]", run):
            continue
        if len(run) > 4:
            found[slot(hashed(run[:4]) + PRIME & WORD64)] += 1
        if len(re.findall(rb"[A-Z]", run)) > 1 and not re.search(rb"[a-z]", run):
            found[0] += 1
        if run.lower() == before:
            found[1] += 1
        before = run.lower()
    return {k: math.log1p(n) for k, n in found.items()}


def test_features_equal_the_plain_form():
    texts = ["Some words, SOME words!! some some", "", None, " \n\t ", "été LOUD LOUD -- a,b,,c A AB aB x1 " + "z" * 700, "!?!? ... a\x0bb\x0cc\rd"]
    doc, index, value = qm.features([t and t.encode() for t in texts], BITS)
    for d, text in enumerate(texts):
        got = dict(zip(index[doc == d].tolist(), value[doc == d].tolist()))
        want = plain_features(text)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want), text


def loss_and_gradient(x, grades, w, t, ridge):
    """Mean negative log-likelihood plus the ridge, and its derivatives by the weights and thresholds, from the tails."""
    n = len(grades)
    tails = np.column_stack([np.ones(n), 1 / (1 + np.exp(t[None, :] - (x @ w)[:, None])), np.zeros(n)])
    slope = tails * (1 - tails)
    rows = np.arange(n)
    p = np.maximum(tails[rows, grades] - tails[rows, grades + 1], 1e-12)
    by_score = -(slope[rows, grades] - slope[rows, grades + 1]) / p / n
    by_t = np.array([sum((slope[i, k] / p[i] / n) * (int(grades[i] == k) - int(grades[i] + 1 == k)) for i in range(n)) for k in range(1, len(t) + 1)])
    return -np.log(p).mean() + ridge * (w @ w), x.T @ by_score + 2 * ridge * w, by_t


def test_plain_gradient_is_that_of_the_likelihood():
    rnd = np.random.default_rng(5)
    x, grades, w, t = rnd.normal(size=(20, 4)), rnd.integers(0, 3, 20), rnd.normal(size=4), np.array([-0.4, 0.7])
    _, by_w, by_t = loss_and_gradient(x, grades, w, t, 0.01)
    for k in range(6):
        step = np.eye(6)[k] * 1e-6
        up, down = (loss_and_gradient(x, grades, w + s * step[:4], t + s * step[4:], 0.01)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - np.concatenate([by_w, by_t])[k]) < 1e-6


def plain_fit(x, grades, n_grades, ridge=3e-4, steps=300, rate=0.05):
    """Adam over the weights, the first threshold and the logarithms of the gaps."""
    w, free = np.zeros(x.shape[1]), np.concatenate([[-(n_grades - 2) / 2], np.zeros(n_grades - 2)])
    theta = np.concatenate([free, w])
    m, v, cut = np.zeros_like(theta), np.zeros_like(theta), len(free)
    for step in range(1, steps + 1):
        gaps = np.exp(theta[1:cut])
        t = theta[0] + np.concatenate([[0], np.cumsum(gaps)])
        _, by_w, by_t = loss_and_gradient(x, grades, theta[cut:], t, ridge)
        grad = np.concatenate([[by_t.sum()], [by_t[k:].sum() * gaps[k - 1] for k in range(1, cut)], by_w])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[cut:], theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:cut]))])


def test_query_equals_the_plain_form(spark):
    """All documents of the small tables. Every rating is in the sample there, and no grade is rare, so none is weighted."""
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SF_SMALL}/labels.parquet' ORDER BY doc_id").fetchall()
    grade = {i: 0 if toxic == 1 else 1 if quality == 0 else 2 for i, quality, toxic in labels}
    found = {i: plain_features(text) for i, text in docs}
    rated = [i for i, _ in docs if i in grade]
    grades = np.array([grade[i] for i in rated])
    counts = np.bincount(grades, minlength=N_GRADES)
    assert counts.min() / counts.sum() >= 0.1
    in_docs = Counter(k for i in rated for k in found[i])
    least = min(20, max(2, counts.min() // 20))
    used = sorted(k for k, n in in_docs.items() if n >= least)
    w, t = plain_fit(np.array([[found[i].get(k, 0.0) for k in used] for i in rated]), grades, N_GRADES)
    weight = dict(zip(used, w))
    got = {r.doc_id: r for r in QUERIES["op6_quality_classifier"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for i, _ in docs:
        tails = 1 / (1 + np.exp(t - sum(weight.get(k, 0.0) * x for k, x in found[i].items())))
        assert abs(got[i].expected_grade - tails.sum()) < 5e-3 and abs(got[i].tail - tails[GOOD - 1]) < 5e-3, i
        if abs(tails[GOOD - 1] - 0.4) > 5e-3:
            assert got[i].kept == (tails[GOOD - 1] >= 0.4)
