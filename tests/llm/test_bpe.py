"""BPE over the trie against the library."""

import os
import random

import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from tripflow.llm import bpe  # noqa: E402
from tripflow.llm.queries import vocabulary  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary(vocabulary()))


def odd_texts():
    rnd = random.Random(2)
    parts = ["a", "the", "ing", "'s", "'ll", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "!", "<|endoftext|>", "中文", "😀", "՘",
             "\x85", "\xa0", "aaaa", "=====", "\x00", "͸", "ก็"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50))) for _ in range(800)] + [
        "", None, " ", "a" * 5000, "ab" * 3000 + " x", " " * 700, "<|endoftext|>" * 3, "word " * 400_000]


def test_ids_and_texts_equal_the_library(library, encoder):
    texts = odd_texts()
    got = [x.tolist() for x in encoder.encode(texts)]
    assert got == [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [encoder.decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in got]


def test_forgetting_words_changes_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 64)
    texts = odd_texts()[:200]
    assert [x.tolist() for x in encoder.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_frames_keep_columns_nulls_and_repeated_rows(spark, library):
    rows = [(1, "Hello, world", "x"), (1, "Hello, world", "x"), (None, None, None), (2, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    back = bpe.decode(spark, bpe.encode(spark, df, vocabulary()), vocabulary())
    assert back.columns == ["doc_id", "lang", "ids", "decoded"]
    hello = library.encode("Hello, world").ids
    assert sorted(map(repr, back.collect())) == sorted(
        f"Row(doc_id={i}, lang={lang!r}, ids={ids}, decoded={text!r})"
        for i, lang, ids, text in [(1, "x", hello, "Hello, world")] * 2 + [(None, None, [], ""), (2, "y", [], "")])
    assert bpe.encode(spark, df.limit(0), vocabulary()).count() == 0
    assert bpe.decode(spark, spark.createDataFrame([(None,)], "ids array<int>"), vocabulary()).first()["decoded"] == ""
    with pytest.raises(ValueError):
        bpe.encode(spark, df.withColumnRenamed("lang", "ids"), vocabulary())


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(bpe.read_vocabulary(vocabulary().replace("byte_bpe_50k", "word_bpe_49k")))
