"""Registered queries against their SQL, or against a brute-force form, over whole small tables."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.test_entry import TABLES, _key
from tests.llm.test_mixing import brute as mixed_by_hand
from tests.llm.test_quality_rules import plain as plain_measures, plain_bits
from tripflow.llm import quality_rules
from tripflow.llm.common import WORD
from tripflow.llm.queries import ORACLES, QUERIES, vocabulary


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) == {"op1_topk_search", "op3_mix_sources", "op5_warc", "op7_url_filter", "op8_quality_rules",
                            "op11_conversation_trie", "op12_collocations", "op13_substring_dedup"}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, key):
    got = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in got.collect()]
    want = duck.execute(ORACLES[key])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert _key(got.columns, rows) == _key(cols, want.fetchall())


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def coded(documents):
    tk = Tokenizer.from_file(vocabulary())
    return {i: tk.encode(t, add_special_tokens=False).ids for i, t, _ in documents}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_codec(spark, documents, coded):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op2_bpe_codec"](spark, SF_SMALL).collect()}
    assert got == {i: (len(coded[i]), sha(",".join(map(str, coded[i]))), sha(t)) for i, t, _ in documents}


def test_simhash_dedup(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_dedup"](spark, SF_SMALL).collect()}
    fps = [plain_fingerprint(t) for _, t, _ in documents]
    comp = plain_components([i for i, _, _ in documents], fps, 4)
    assert got == {i: (f"{f:016x}", c) for (i, _, _), f, c in zip(documents, fps, comp)}


def test_quality_classifier_keeps_good_documents(spark, duck):
    got = {r.doc_id: r.kept for r in QUERIES["op6_quality_classifier"](spark, SF_SMALL).collect()}
    good = [i for i, in duck.execute("SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0").fetchall()]
    assert len(got) == 200 and sum(got[i] for i in good) >= 0.95 * len(good)


def test_sharding(spark, documents):
    rows = QUERIES["op9_shard"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == [(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t, _ in documents]
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(25))


def test_token_store(spark, documents, coded):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op10_token_store"](spark, SF_SMALL).collect()}
    start, want = 0, {}
    for i, _, _ in documents:
        ids = np.array(coded[i] + [0], dtype="<u4")
        want[i] = start, len(ids), zlib.crc32(ids.tobytes())
        start += len(ids)
    assert got == want


def plain_mix(rows):
    """(doc_id, source, text) of the rows that the mix of rows (doc_id, text, source) should give, cut texts as their words."""
    of = {(i, s, len(re.findall(WORD, t or ""))): t for i, t, s in rows}
    out = []
    for i, s, n, _, _, taken in mixed_by_hand(rows):
        own = re.findall(WORD, of[i, s, n] or "")
        out += [(i, s, own)] * (taken // n if n else 0) + ([(i, s, own[:taken % n])] if n and taken % n else [])
    return out


def mixed_words(rows):
    return [(r.doc_id, r.source, re.findall(WORD, r.text)) for r in rows]


def test_a_cut_document_keeps_its_white_space(spark):
    docs = spark.createDataFrame([(1, " a \t b\n\nc d ", "x"), (2, "e", "y")], "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.mixing_sources(spark, docs, SF_SMALL).collect())
    # 5 words, a goal of 7.5: x may give 5.625 -> 6 of 8 words, y 1.875 -> 2 of 2.
    assert got == [(1, " a \t b"), (1, " a \t b\n\nc d "), (2, "e"), (2, "e")]
    with pytest.raises(ValueError):
        corpus_pipeline.mixing_sources(spark, docs.withColumn("_words", docs["source"]), SF_SMALL)


def test_a_source_of_one_long_document_loses_no_words(spark):
    docs = spark.createDataFrame([(1, "w " * 3000, "a"), *[(k, "x y z", "b") for k in range(2, 40)], (50, "q " * 9000, "c")], "doc_id long, text string, source string")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = mixed_words(corpus_pipeline.mixing_sources(spark, docs, SF_SMALL).collect())
    assert sorted(got) == sorted(plain_mix(rows))
    taken = {s: sum(x[5] for x in mixed_by_hand(rows) if x[1] == s) for s in "abc"}
    assert {s: sum(len(w) for _, x, w in got if x == s) for s in "abc"} == taken


def test_whole_pipeline_against_plain_forms(spark, documents, coded):
    """Classifier's verdicts as they are; rules, groups, mix and tokens by their definitions."""
    kept = {r.doc_id for r in QUERIES["op6_quality_classifier"](spark, SF_SMALL).where("kept").collect()}
    rows = [(i, t, s) for i, t, s in documents if i in kept]
    rows = [r for r in rows if not plain_bits(plain_measures(r[1])) & ~(1 << 2)]  # length alone rejects nothing
    comp = plain_components([i for i, _, _ in rows], [plain_fingerprint(t) for _, t, _ in rows], 4)
    rows = [r for r, c in zip(rows, comp) if r[0] == c]
    want = []
    tk = Tokenizer.from_file(vocabulary())
    for i, s, words in plain_mix(rows):
        text = next(t for j, t, _ in rows if j == i)
        n = len(words)
        cut = text if n == len(re.findall(WORD, text)) else re.match(r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){%d}" % n, text).group()
        want.append((i, s, tk.encode(cut, add_special_tokens=False).ids))
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in got)
    assert sorted((r.doc_id, r.source, list(r.ids)) for r in got) == sorted(want) and len(want) > 100


def test_pipeline_stage_by_stage(spark, documents, coded):
    """Each stage on its own input, and the whole run."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", None, 0), (9002, "", "en", "src0", 0), (None, "w " * 60, "en", "src1", 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("kept", docs["n_chars"]).withColumn("n_words", docs["lang"])  # names the operators use themselves
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "quality rules", "simhash near-dedup", "mixing sources", "bpe encoding"]

    judged = stages["quality classifier"](spark, docs, SF_SMALL)
    assert judged.columns == columns and 0 < judged.count() < docs.count()
    ruled = stages["quality rules"](spark, docs, SF_SMALL)
    bits = quality_rules.ledger(docs.select("doc_id", "text")).where("fail_bits = 0").select("doc_id").collect()
    assert ruled.columns == columns and sorted(map(repr, ruled.select("doc_id").collect())) == sorted(map(repr, bits))

    twice = docs.unionByName(docs)
    single = stages["simhash near-dedup"](spark, twice, SF_SMALL)
    rows = documents + [(9001, None, "src0"), (9002, "", "src0"), (None, "w " * 60, "src1")]
    comp = plain_components([i for i, _, _ in rows], [plain_fingerprint(t) for _, t, _ in rows], 4)
    kept = [r.doc_id for r in single.collect()]
    assert single.columns == columns and len(kept) == len(set(comp)) and set(kept) == set(comp)

    mixed = stages["mixing sources"](spark, docs, SF_SMALL)
    assert mixed.columns == columns
    assert sorted(mixed_words(mixed.collect()), key=repr) == sorted(plain_mix(rows), key=repr)

    tokens = stages["bpe encoding"](spark, docs, SF_SMALL).collect()
    assert all(r.decodes for r in tokens) and {r.doc_id: list(r.ids) for r in tokens if r.doc_id in coded} == coded

    for stage in stages.values():
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
