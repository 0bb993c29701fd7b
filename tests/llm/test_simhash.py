"""SimHash near-dedup against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from tripflow.llm import components, simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    parts = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, most):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(ids))]


def flipped(fp, bits):
    for b in bits:
        fp ^= 1 << b
    return fp


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4])
def test_anchors_cover_every_pair_within_the_distance(most):
    rnd = random.Random(most)
    left = [rnd.getrandbits(64) for _ in range(2000)]
    right = [flipped(x, rnd.sample(range(64), most)) for x in left]
    (at, a), (bt, b) = simhash.anchors(np.array(left, dtype=np.uint64)), simhash.anchors(np.array(right, dtype=np.uint64))
    met = set(zip(at.tolist(), a.tolist())) & set(zip(bt.tolist(), b.tolist()))
    assert {i for i, _ in met} == set(range(2000))


def test_code_is_perfect():
    near = simhash.GolayAnchors(beyond=0)
    at, _ = near.near(np.arange(1 << 23))
    assert len(at) == 1 << 23  # every value has exactly one word within the radius


def rows():
    rnd = random.Random(7)
    words = [f"w{k}" for k in range(200)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    out = [(k, base[k % 40]) for k in range(80)]
    out += [(200 + k, base[0] + f" tail{k}") for k in range(30)]
    return out + [(300, None), (301, ""), (302, " \n\t"), (303, "One"), (304, "ONE"), (305, "É one"), (5, base[5]), (None, base[6]),
                  (None, "only here without an id"), (306, "long " * 50_000)]


@pytest.mark.parametrize("most", [4, 2])
def test_components_equal_all_pairs(spark, most):
    data = rows()
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in data], "doc_id long, text string, fp string, root string")
    got = simhash.near_duplicates(spark, df, ["doc_id"], max_bits=most)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got.collect()), key=repr)
    fps = [plain_fingerprint(t) for _, t in data]
    comp = plain_components([i for i, _ in data], fps, most)
    assert got == sorted(((i, f, c) for (i, _), f, c in zip(data, fps, comp)), key=repr)


def test_hot_anchors_are_split_without_losing_links(spark):
    rnd = random.Random(11)
    base = rnd.getrandbits(64)
    fps = sorted({flipped(base, rnd.sample(range(64), rnd.randint(0, 5))) for _ in range(300)} | {rnd.getrandbits(64) for _ in range(50)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    want = plain_components(fps, fps, 4)
    for group in (8, 4096):
        roots = components.connected_components(spark, simhash.linked_pairs(spark, df, 4, group=group))
        root = {r.node % (1 << 64): r.root for r in roots.collect()}
        own = {f: root.get(f, f - (1 << 64) if f >> 63 else f) for f in fps}
        assert len(set(zip(want, (own[f] for f in fps)))) == len(set(want)) == len(set(own.values()))


def test_empty_table_and_refused_distance(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(spark, df, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        simhash.linked_pairs(spark, df, 5)


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000), (500, 600)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.connected_components(spark, df).collect()}
    assert got == {**{k: 0 for k in range(1, 201)}, 600: 500}
