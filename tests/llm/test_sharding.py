"""Sharding: a permutation, both ways, and even shards."""

import numpy as np
import pytest

from tripflow.llm import sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 100, 1023, 1025, 50_000])
def test_permutation_and_its_inverse(n):
    rows = np.arange(n)
    shard, slot = sharding.place(rows, n, 8, seed=9)
    assert len(set(zip(shard.tolist(), slot.tolist()))) == n
    counts = np.bincount(shard, minlength=8)
    assert counts.max() - counts.min() <= 1
    assert all(sorted(slot[shard == s]) == list(range(counts[s])) for s in range(8))
    assert (sharding.row_at(shard, slot, n, 8, seed=9) == rows).all()
    if n > 100:
        assert abs(np.corrcoef(rows, slot * 8 + shard)[0, 1]) < 0.1
        assert (sharding.place(rows, n, 8, seed=10)[1] != slot).any()


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, size long, shard_name string").repartition(parts)


def test_rows_are_numbered_in_order_and_runs_agree(spark):
    rows = [(k * 7 % 501, k % 5, f"x{k}") for k in range(501)] + [(None, 1, "null"), (None, 2, "null"), (3, 3, "again"), (3, 3, "again")]
    runs = [sharding.shard_rows(spark, frame(spark, rows, p), ["doc_id", "size"], 8).collect() for p in (1, 5)]
    one, two = (sorted((r.row_no, r.doc_id, r.size, r.shard, r.slot) for r in x if r.doc_id is not None) for x in runs)
    assert one == two
    ordered = sorted(runs[0], key=lambda r: r.row_no)
    assert [r.row_no for r in ordered] == list(range(len(rows)))
    assert [(r.doc_id, r.size) for r in ordered] == sorted(((i, n) for i, n, _ in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    shard, slot = sharding.place(np.arange(len(rows)), len(rows), 8, 9)
    assert [(r.shard, r.slot) for r in ordered] == list(zip(shard.tolist(), slot.tolist()))


def test_empty_table_and_equal_rows(spark):
    assert sharding.shard_rows(spark, frame(spark, []), ["doc_id"], 8).count() == 0
    got = sharding.shard_rows(spark, frame(spark, [(1, 1, "x")] * 100), ["doc_id", "size"], 8).collect()
    assert sorted(r.row_no for r in got) == list(range(100))


def test_written_shards_are_in_slot_order(spark, tmp_dir):
    sharded = sharding.shard_rows(spark, frame(spark, [(k, k, "t") for k in range(100)]), ["doc_id"], 4)
    sharding.write_shards(sharded, f"{tmp_dir}/s", rows_per_file=10)
    back = spark.read.parquet(f"{tmp_dir}/s")
    assert sorted((r.shard, r.slot, r.doc_id) for r in back.collect()) == sorted((r.shard, r.slot, r.doc_id) for r in sharded.collect())


def plain_place(row, n, seed):
    """The network on Python integers, one row at a time."""
    if n <= 1:
        return row
    bits = ((n - 1).bit_length() + 1) // 2
    while True:
        left, right = row >> bits, row % (1 << bits)
        for r in range(4):
            x = (right + (seed * 1_000_003 + r * 0x632BE59BD9B4E019 + 1)) * 0x9E3779B97F4A7C15 % 2**64
            x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 % 2**64
            left, right = right, left ^ (x ^ x >> 32) % (1 << bits)
        row = (left << bits) + right
        if row < n:
            return row


@pytest.mark.parametrize("n", [1, 2, 5, 64, 65, 1000, 4097])
def test_the_network_equals_a_plain_form(n):
    shard, slot = sharding.place(np.arange(n), n, 8, seed=9)
    assert (slot * 8 + shard).tolist() == [plain_place(k, n, 9) for k in range(n)]


@pytest.mark.parametrize("name", ["slot", "Shard", "row_no", "_uid"])
def test_clashing_names_raise(spark, name):
    with pytest.raises(ValueError, match=name):
        sharding.shard_rows(spark, frame(spark, [(1, 1, "x")]).withColumnRenamed("shard_name", name), ["doc_id"], 8)
