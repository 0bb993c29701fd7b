"""Token store: coding round trips and whole stores against the library."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tripflow.llm import token_store as ts
from tripflow.llm.queries import vocabulary


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_pack_and_unpack(n):
    rnd = np.random.default_rng(n)
    values = (rnd.integers(0, 1 << 32, n) >> rnd.integers(0, 32, n)).astype(np.uint32)
    control, data = ts.pack(values)
    assert len(control) == -(-n // 4) and (ts.unpack(control, data, n) == values).all()
    edge = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], dtype=np.uint32)
    control, data = ts.pack(edge)
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4 and (ts.unpack(control, data, 8) == edge).all()


def test_blocks_with_newlines_inside():
    ranks = [np.array([10, 10, 2570], dtype=np.uint32), np.array([13], dtype=np.uint32)]
    content = b"".join(ts.write_block(ids, ranks) + b"\n" for ids in ([10, None], [None, -1]))
    got = [(ids, lengths.tolist(), values.tolist()) for ids, lengths, values in ts.read_blocks(content)]
    assert got == [([10, None], [3, 1], [10, 10, 2570, 13]), ([None, -1], [3, 1], [10, 10, 2570, 13])]
    with pytest.raises(ValueError):
        list(ts.read_blocks(b"nothing"))


def store(spark, tmp_dir, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, n string, ids string").repartition(3)
    ts.write_store(spark, ts.tokenized(spark, df, vocabulary()), f"{tmp_dir}/t")
    return sorted(ts.read_store(spark, f"{tmp_dir}/t").collect(), key=lambda r: r.start)


def test_store_equals_the_library(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ts, "BLOCK_IDS", 64)
    monkeypatch.setattr(ts, "BLOCKS_PER_FILE", 2)
    tk = Tokenizer.from_file(vocabulary())
    rows = [(k * 37 % 101, f"Text {k} of the store, " * (k % 9)) for k in range(101)]
    rows += [(500, None), (501, ""), (502, "long " * 30_000), (None, "no id"), (7, "again"), (7, "again"), (503, "a<|endoftext|>b 中文 😀")]
    coded = [(i, tk.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows]
    coded = [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes()), x) for i, x in coded]
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    start, want = 0, []
    for i, n, crc, ids in coded:
        want.append((i, start, n, crc, ids))
        start += n
    got = store(spark, tmp_dir, rows)
    assert [(r.doc_id, r.start, r.n, r.crc, list(r.ids)) for r in got] == want
    ranks = spark.read.parquet(f"{tmp_dir}/t/ranks").orderBy("rank").collect()
    assert sum(r["count"] for r in ranks) == start and [r["count"] for r in ranks] == sorted((r["count"] for r in ranks), reverse=True)
    assert spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{tmp_dir}/t/blocks").count() > 3


def test_empty_table(spark, tmp_dir):
    assert store(spark, tmp_dir, []) == []


def test_known_words_of_a_chunk_are_not_learnt_again(monkeypatch):
    """When an encoder must forget, it keeps what the chunk at hand has looked up already."""
    monkeypatch.setattr(ts.bpe, "KNOWN_WORDS", 9)
    enc = ts.LibraryEncoder(ts.bpe.read_vocabulary(vocabulary()))
    tk, texts = Tokenizer.from_file(vocabulary()), ["one two three four five six", "one two three four five six seven eight nine ten", "x " * 99 + "y" * 2000, "one y" + "y" * 1999]
    list(enc.encode(texts[:1]))
    learnt, model = [], enc._model

    class Spy:
        def tokenize(self, word):
            learnt.append(word)
            return model.tokenize(word)

    enc._model = Spy()
    got = [ids.tolist() for text in texts for ids in enc.encode([text])]
    assert got == [tk.encode(text, add_special_tokens=False).ids for text in texts]
    assert len(learnt[:4]) == 4 and {w[1:] for w in learnt[:4]} == {"seven", "eight", "nine", "ten"}
