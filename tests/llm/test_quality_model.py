"""Ordinal classifier: features, order of the thresholds, held-out accuracy and edge cases."""

import random

import duckdb
import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tripflow.llm import quality_model as qm
from tripflow.llm.queries import GOOD, N_GRADES, QUERIES


def test_features_do_not_depend_on_pieces_or_neighbours(monkeypatch):
    texts = [b"Some words, SOME words!! some", b"", None, b" \n ", "é LOUD LOUD été".encode(), b"tail " * 500, b"x"]
    alone = [sorted(zip(*(x.tolist() for x in qm.features([t], 16)[1:]))) for t in texts]
    for piece in (1 << 21, 64, 7):
        monkeypatch.setattr(qm, "_PIECE", piece)
        doc, index, value = qm.features(texts, 16)
        got = [[(int(i), round(float(v), 9)) for i, v in sorted(zip(index[doc == d], value[doc == d]))] for d in range(len(texts))]
        want = [[(i, round(v, 9)) for i, v in own] for own in alone]
        if piece < 1 << 21:  # a repetition across the cut of a long text does not count
            got, want = ([[f for f in own if f[0] != 1] for own in x] for x in (got, want))
        assert got == want
    assert not len(qm.features([], 16)[0])


def made(n, seed):
    rnd = random.Random(seed)
    words = [f"word{k}" for k in range(300)]
    texts, grades = [], []
    for _ in range(n):
        g = rnd.randrange(3)
        body = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        if g == 0:
            body += ["awful"] * 2
        if g == 1:
            body += ["meh", "###"]
        rnd.shuffle(body)
        texts.append(" ".join(body).encode())
        grades.append(g)
    return texts, np.array(grades)


def test_held_out_grades_and_ordered_tails():
    texts, grades = made(1500, 1)
    model = qm.fit(texts, grades, 3)
    assert (np.diff(model.thresholds) > 0).all()
    held, known = made(500, 2)
    tails = model.tails(held)
    assert (tails[:, 0] >= tails[:, 1]).all()
    expected = tails.sum(axis=1)
    assert expected[known == 0].mean() < expected[known == 1].mean() < expected[known == 2].mean()
    assert ((tails[:, 1] >= 0.5) == (known == 2)).mean() > 0.95


def test_shared_tables_held_out():
    rows = duckdb.sql(f"""SELECT d.text, l.quality, l.toxic FROM '/root/testdata/sf0.1/documents.parquet' d
                          JOIN '/root/testdata/sf0.1/labels.parquet' l USING (doc_id) ORDER BY d.doc_id""").fetchall()
    texts = [t.encode() for t, _, _ in rows]
    grades = np.array([0 if x == 1 else 1 if q == 0 else 2 for _, q, x in rows])
    train = np.arange(len(rows)) % 3 > 0
    model = qm.fit([t for t, k in zip(texts, train) if k], grades[train], N_GRADES)
    tail = model.tails([t for t, k in zip(texts, train) if not k])[:, GOOD - 1]
    good = grades[~train] == GOOD
    assert (tail[good] >= 0.4).mean() > 0.99
    assert (tail[~good] >= 0.4).mean() < 0.35


def frames(spark):
    texts, grades = made(400, 3)
    docs = [(k, t.decode(), "x") for k, t in enumerate(texts)] + [(1000, None, "y"), (1001, "", "y"), (None, "no id", "y"), (5, texts[5].decode(), "x")]
    rated = [(k, int(g)) for k, g in enumerate(grades)] + [(5, 2), (None, 1), (7, None), (99_999, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, grade string"), spark.createDataFrame(rated, "doc_id long, grade int")


def test_all_rows_are_scored(spark):
    docs, rated = frames(spark)
    got = qm.classify(spark, docs, rated, 3, 2, least_tail=0.5, sample=300).collect()
    assert len(got) == 404 and got[0].__fields__ == ["doc_id", "grade", "expected_grade", "tail", "kept"]
    assert len({r.tail for r in got if r.doc_id in (1000, 1001)}) == 1
    assert len({(r.tail, r.kept) for r in got if r.doc_id == 5}) == 1
    assert all(r.kept == (r.tail >= 0.5) for r in got)
    again = qm.classify(spark, docs.repartition(5), rated.repartition(3), 3, 2, least_tail=0.5, sample=300).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_no_ratings_no_documents_and_clashing_names(spark):
    docs, rated = frames(spark)
    assert {(r.tail, r.kept) for r in qm.classify(spark, docs, rated.limit(0), 3, 2).collect()} == {(None, True)}
    assert qm.classify(spark, docs.limit(0), rated, 3, 2).count() == 0
    with pytest.raises(ValueError):
        qm.classify(spark, docs.withColumnRenamed("grade", "tail"), rated, 3, 2)


def test_a_rare_grade_is_learnt(spark):
    texts, grades = made(1500, 4)
    toxic = np.flatnonzero(grades == 0)
    keep = np.sort(np.concatenate([np.flatnonzero(grades > 0), toxic[:12]]))  # 12 of about 1,000
    rows = [(int(k), texts[k].decode(), int(grades[k])) for k in keep] + [(int(k), texts[k].decode(), None) for k in toxic[12:]]
    both = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    assert qm.per_grade({0: 12, 1: 500, 2: 500}, 300) == {0: 12, 1: 144, 2: 144}
    got = {r.doc_id: r.kept for r in qm.classify(spark, both.drop("grade"), both.select("doc_id", "grade"), 3, 2, sample=300).collect()}
    assert not any(got[int(k)] for k in toxic[:12])
    assert np.mean([got[int(k)] for k in toxic[12:]]) < 0.02
    assert np.mean([got[int(k)] for k in np.flatnonzero(grades == 2)]) > 0.9

    # The same 12, when the other grades stand for 300 times as many ratings (0.004 %).
    model = qm.fit([texts[k] for k in keep], grades[keep], 3, weights=np.where(grades[keep] == 0, 1.0, 300.0))
    tail = model.tails(texts)[:, 1]
    assert (tail[grades == 0] < 0.4).all() and (tail[grades == 2] >= 0.4).mean() > 0.95


def test_fewer_than_twenty_ratings(spark):
    rows = [(k, f"{'awful stuff' if k % 3 == 0 else 'fine words here'} number {k}", 0 if k % 3 == 0 else 2) for k in range(12)]
    both = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    got = {r.doc_id: r.kept for r in qm.classify(spark, both.drop("grade"), both.select("doc_id", "grade"), 3, 2).collect()}
    assert got == {k: g == 2 for k, _, g in rows}


def test_labelled_toxic_documents_of_the_small_tables_are_rejected(spark):
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SF_SMALL}/labels.parquet'").fetchall()
    got = {r.doc_id: r.kept for r in QUERIES["op6_quality_classifier"](spark, SF_SMALL).collect()}
    assert not any(got[i] for i, _, toxic in labels if toxic == 1)
    assert all(got[i] for i, quality, toxic in labels if quality == 1 and toxic == 0)
