import random

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, awkward, empty, written
from pyspark.sql import functions as F

from tripartite.llm import toxicity as tx
from tripartite.llm.bytewords import slices

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=600, seed=1):
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(k))
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = say(rng.randint(5, 60)) + (f" {rng.choice(['vilest', 'Scumbag', 'rotten'])}, " if toxic else " ") + say(10)
        rows.append((i, text, "en", "s", None, None, None, None))
        labels.append((i, None, int(toxic)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)


def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    vectors = rng.random((300, 40)) * (rng.random((300, 40)) < 0.15)
    vectors[7] = vectors[200] = vectors[3]
    norm = np.linalg.norm(vectors, axis=1)
    vectors[norm > 0] /= norm[norm > 0, None]
    example, term = np.nonzero(vectors)
    index = tx.BlockMaxIndex(example, term, vectors[example, term], 300, 40)
    for q in [*range(0, 300, 7), 3]:
        terms = np.flatnonzero(vectors[q])
        if not len(terms):
            continue
        cosine = vectors @ vectors[q]
        order = np.lexsort((np.arange(300), -np.round(cosine, 12)))
        wanted = [k for k in order if cosine[k] > 1e-15][:9]
        ids, found = index.nearest(terms, vectors[q][terms], 9)
        np.testing.assert_allclose(found, np.minimum(cosine[wanted], 1), atol=1e-9)
        assert set(np.round(cosine[ids], 9)) == set(np.round(cosine[wanted], 9))


def test_isotonic():
    at, p = tx.isotonic(np.array([0.1, 0.2, 0.3, 0.3, 0.9]), np.array([0.0, 1, 0, 1, 1]), np.ones(5))
    assert (np.diff(p) >= 0).all() and p[0] == 0 and p[-1] == 1


def test_held_out_texts(spark):
    docs, labels = corpus(spark)
    model = tx.fit(docs.where("doc_id % 4 <> 2"), labels)
    rows = tx.score(docs.where("doc_id % 4 = 2"), model).select("row.doc_id", "score", "predicted", "examples").collect()
    wrong = [r.doc_id for r in rows if r.predicted != int(r.doc_id % 5 == 0)]
    assert len(rows) == 150 and len(wrong) <= 2
    assert all(e % 4 != 2 for r in rows for e in r.examples) and all(0 <= r.score <= 1 for r in rows)


def test_every_term_tied_to_the_label_is_kept(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choice(letters) for _ in range(9)) for _ in range(800)]
    rows = [(i, " ".join(rng.sample(words, 800)), "en", "s", None, None, None, None) for i in range(20)]
    plain = lambda: " ".join("".join(rng.choice(letters) for _ in range(3)) for _ in range(30))
    rows += [(i, plain(), "en", "s", None, None, None, None) for i in range(20, 80)]
    labels = spark.createDataFrame([(i, None, int(i < 20)) for i in range(80)], LABELS)
    model = tx.fit(spark.createDataFrame(rows, SCHEMA), labels)
    data, starts, ends, _ = tx._text_words(pa.array([" ".join(words)]))
    _, found = tx.terms(data, starts, ends)
    assert (model.vocabulary.find(found[: len(words)]) >= 0).all()
    assert len(model.vocabulary.key) > 3 * len(words)


def test_awkward_rows(spark):
    docs, labels = corpus(spark, 200)
    model = tx.fit(docs, labels)
    df = awkward(spark)
    scored = tx.score(df, model).select("row.text", "score", "predicted").collect()
    assert len(scored) == df.count()
    assert len({r.score for r in scored if not (r.text or "").strip()}) == 1
    kept = tx.drop_toxic(df, model)
    assert kept.columns == df.columns and kept.count() == df.count()


@pytest.mark.parametrize("value", [None, 0, 1])
def test_no_or_one_kind_of_label(spark, value):
    docs, _ = corpus(spark, 20)
    labels = spark.createDataFrame([(1, 0, value), (None, 1, 1), (999, 1, 1)], LABELS)
    rows = tx.score(docs, tx.fit(docs, labels)).collect()
    assert {r.predicted for r in rows} == {1 if value == 1 else 0}
    assert tx.score(empty(spark), tx.fit(empty(spark), labels)).collect() == []


def test_terms_do_not_reach_into_the_next_word():
    text = pa.array(["Ab abcd"])
    data, starts, ends, _ = tx._text_words(text)
    which, _ = tx.terms(data, starts, ends)
    # " ab" is shorter than every sequence; " abcd" has two of four bytes and one of five.
    assert sorted(which.tolist()) == [0, 1, 1, 1, 1]


def test_ids_of_any_type(spark):
    docs, labels = corpus(spark, 200)
    docs, labels = (df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")) for df in (docs, labels))
    scored = tx.score(docs, tx.fit(docs, labels))
    assert dict(scored.dtypes)["examples"] == "array<string>"
    assert {e[0] for r in scored.select("examples").collect() for e in r.examples} == {"d"}


def test_pairs_of_text_and_term_do_not_depend_on_slices(monkeypatch):
    rng = random.Random(3)
    texts = pa.array([" ".join(rng.choice(["ab", "Abc", "hello", "x" * 40, "é"]) for _ in range(rng.randint(0, 30))) for _ in range(40)])
    found = {}
    for most in (1, 50, 1 << 20):
        monkeypatch.setattr(tx, "slices", lambda t, most=most: slices(t, most))
        of, h = tx._text_terms(texts)
        found[most] = sorted(zip(of.tolist(), h.tolist()))
        assert len(set(found[most])) == len(found[most])
    assert found[1] == found[50] == found[1 << 20]


def test_query(spark, tmp_path):
    docs, labels = corpus(spark, 300)
    written(awkward(spark, *[tuple(r) for r in docs.where("doc_id > 20").collect()]), tmp_path / "documents.parquet")
    written(labels, tmp_path / "labels.parquet")
    rows = tx.op3_toxicity(spark, str(tmp_path)).collect()
    toxic = {r.doc_id for r in labels.where("toxic = 1 and doc_id > 20").collect()}
    assert len(rows) == 279 + 14
    wrong = [r.doc_id for r in rows if (r.predicted == 1) != (r.doc_id in toxic)]
    assert len(wrong) <= 8 and all(0 <= r.score <= 1 for r in rows)
