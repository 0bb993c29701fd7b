"""Collocations against counts of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tripflow.llm import phrases


def plain(rows, top, longest, least, absorb=100):
    by, out = {}, []
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        by.setdefault(lang or "und", []).extend(re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low))
    for lang, pieces in by.items():
        f = Counter(tuple(w[i:i + k]) for w in pieces for k in range(1, longest + 1) for i in range(len(w) - k + 1))
        n = sum(map(len, pieces))
        held = {p: x for p, x in f.items() if x >= least and len(p) > 1}
        within = {q[i:j] for q, x in held.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and 100 * x >= absorb * held[q[i:j]]}
        scored = []
        for p, a in held.items():
            if p not in within:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        scored.sort()
        out += [(lang, r, p.decode(), -a, l, rr, n, -s) for r, (s, a, p, l, rr) in enumerate(scored[:top], 1)]
    return sorted(out)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, gid int, phrase string").repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(spark, docs, **options).collect())


def cases():
    rnd = random.Random(2)
    vocabulary = [f"v{k}" for k in range(40)] + ["É", "日本", "x\x00y", "New", "york"]
    texts = []
    for _ in range(150):
        words = []
        for _ in range(rnd.randrange(0, 60)):
            words.append(rnd.choice(vocabulary) if rnd.random() < 0.6 else rnd.choice(["New York City", "of the\tkind", "a b c d e f g", "is, that"]))
        texts.append(rnd.choice([" ", "  "]).join(words) + rnd.choice([".", "!\n", "\x0b", ""]))
    return [(rnd.choice(["en", "de", None, "a\nb"]), t) for t in texts] + [("en", None), ("fr", ""), ("xx", ".,;"), ("en", "the " * 500), ("en", texts[0])] * 2


@pytest.mark.parametrize("longest, absorb", [(5, 100), (3, 100), (6, 60), (2, 100)])
def test_equals_all_counts(spark, longest, absorb):
    rows = cases()
    want = plain(rows, 40, longest, 6, absorb)
    assert len(want) > 20
    assert found(spark, rows, top=40, longest=longest, least=6, absorb=absorb) == want


def test_shards_and_buckets_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_WORDS", 100)
    monkeypatch.setattr(phrases, "BUCKET_WORDS", 700)
    rows = cases()
    assert found(spark, rows, top=None, longest=5, least=6) == plain(rows, None, 5, 6)


def test_nothing_frequent(spark):
    assert found(spark, []) == [] and found(spark, [("en", None), ("en", "a b c")]) == []


def test_products_beyond_64_bits(spark):
    # The score of counts near 2**50 needs products of over 100 bits.
    a, n, l, r = 2 ** 50 - 3, 2 ** 51 + 7, 2 ** 50 + 1, 2 ** 50 + 5
    got = spark.sql(f"SELECT (CAST({a}L AS decimal(18,0)) * CAST({n}L AS decimal(18,0)) * 1000BD) div (CAST({l}L AS decimal(18,0)) * CAST({r}L AS decimal(18,0))) AS s").first().s
    assert got == 1000 * a * n // (l * r)


def test_intervals_of_the_index_count_phrases():
    ids = np.array([0, *[random.Random(1).randrange(1, 4) for _ in range(300)], 0])
    before = phrases.index(ids, 5)
    label = np.sort(before)
    label = np.where(label > 0, label, -1)
    prefix, suffix, n, _ = phrases.extend(before, label)
    assert dict(zip(zip(prefix.tolist(), suffix.tolist()), n.tolist())) == Counter(zip(ids[1:-2].tolist(), ids[2:-1].tolist()))
