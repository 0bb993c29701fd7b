"""Exact top-k search against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tripflow.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score string, rank string"


def brute(rows, k):
    import math
    quant = [(i, n, None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(256 * x) for x in v])
             for n, (i, v) in enumerate(rows)]
    out = []
    for i, n, q in quant:
        if i is None or i % 50 or q is None:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, w)), j is None, j or 0, m) for j, m, w in quant if m != n and w is not None and len(w) == len(q))
        out += [(i, r, None if none else j, -s) for r, (s, none, j, _) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, k=5, **kw):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    vectors = df.select(F.col("vec_id").alias("id"), topk.quantized(F.col("embedding")).alias("vec"), "score", "rank")
    found = topk.search(spark, vectors, F.col("id") % 50 == 0, k=k, **kw)
    return sorted((tuple(r) for r in found.select("query_id", "rank", "id", "score").collect()), key=repr)


@pytest.mark.parametrize("lists,block", [(2, 64), (3, 7), (1, 2048)])
def test_random_vectors_with_copies_and_bad_rows(spark, lists, block):
    rnd = random.Random(lists)
    base = [[round(rnd.uniform(-1, 1), 3) for _ in range(6)] for _ in range(60)]
    rows = [(i, base[rnd.randrange(60)] if i % 3 else base[0]) for i in range(0, 400, 2)]  # a hot vector, many ties
    rows += [(50, None), (100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (150, [float("nan")] * 6), (200, [float("inf")] + [0.0] * 5),
             (250, []), (300, []), (None, base[1]), (350, [0.5, 0.5]), (100, base[2]), (100, base[2])]
    assert run(spark, rows, lists=lists, block=block) == brute(rows, 5)


def test_fewer_candidates_than_k_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (50, [-1.0, 0.5])]
    assert run(spark, rows) == brute(rows, 5)
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
