"""Passages that repeat across documents, against every window of every document."""

import random

import numpy as np
import pytest

from tripflow.llm import blocks, substring_dedup
from tripflow.llm.common import WORD

import re


def plain(rows, window):
    """(id, words, removed, kept text) of rows (id, text) by the definition."""
    words = [re.findall(WORD, t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if i is not None:
                least[g] = min(i, least.get(g, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {k + d for k in range(len(w) - window + 1) if i is not None and least[tuple(w[k:k + window])] < i for d in range(window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def found(spark, rows, window=13):
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, n_words string, n_removed int").repartition(3)
    got = substring_dedup.remove_repeats(spark, docs, window)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()), key=str)


def cases():
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(300)] + ["é́", "日本語のことば", "x" * 700, "a.b,c"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = text(60)
    docs = [text(40) + " " + shared + "\t\n " + text(rnd.randrange(30)) for _ in range(12)]
    docs += [docs[0], docs[0], " ".join(docs[1].split()), docs[2].replace("w1 ", "w2 "), text(12), shared[:80], "", "   \n", None]
    docs += [" ".join(["the"] * 90), " ".join(["the"] * 30), text(3000), "one two " * 200]
    rows = [(rnd.choice([-5, 3, 10]) * 100 + k, t) for k, t in enumerate(docs)]
    return rows + [(rows[3][0], docs[4]), (None, shared), (None, docs[5]), (2 ** 62, shared), (-2 ** 63, shared)]


@pytest.mark.parametrize("window", [1, 5, 13, 30])
def test_equals_the_definition(spark, window):
    rows = cases()
    assert found(spark, rows, window) == sorted(plain(rows, window), key=str)


def test_chunks_and_buckets_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", 200)
    monkeypatch.setattr(substring_dedup, "BUCKET_WORDS", 500)
    rows = cases()
    assert found(spark, rows) == sorted(plain(rows, 13), key=str)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_ladder_doubles():
    assert substring_dedup.ladder(13) == [7, 13]
    for window in range(1, 200):
        steps = substring_dedup.ladder(window)
        assert steps[-1] == window and all(a < b <= 2 * a for a, b in zip(steps, steps[1:]))


def test_a_window_must_have_words(spark):
    with pytest.raises(ValueError):
        found(spark, [(1, "a")], 0)


def test_packed_arrays_come_back():
    arrays = [np.arange(5, dtype=np.uint8), np.zeros(0, np.int64), np.array([-1, 2 ** 62]), np.array([70000], np.uint32)]
    back = blocks.unpack(blocks.pack(*arrays))
    assert [(a.dtype, a.tolist()) for a in back] == [(a.dtype, a.tolist()) for a in arrays]
