import re
from collections import defaultdict

from cases import awkward, empty, written

from tripartite.llm import token_counts as tc
from tripartite.llm.bpe import byte_bpe


def rows(df):
    return {tuple(r[:3]): tuple(r[3:]) for r in df.collect()}


def test_counts_against_the_tokenizer(spark, tmp_path):
    df = awkward(spark)
    tc.commit_batch(str(tmp_path), "load", tc.changes(tc.counted(df), 1))
    want = defaultdict(lambda: [0, 0])
    for r in df.collect():
        text = r.text or ""
        for name, n in (("byte_bpe_50k", len(byte_bpe().encode_ordinary(text))), ("space_words", len(text.encode().split()))):
            want[r.source, r.lang, name][0] += 1
            want[r.source, r.lang, name][1] += n
    assert rows(tc.totals(spark, str(tmp_path))) == {k: tuple(v) for k, v in want.items()}


def signed(spark, *changes):
    return spark.createDataFrame(changes, "source string, lang string, tokenizer string, documents int, tokens long")


def test_batches_repeat_without_effect_and_compact(spark, tmp_path):
    store = str(tmp_path)
    tc.commit_batch(store, "b1", signed(spark, ("s", "en", "t", 1, 10), ("s", "en", "t", 1, 5), ("q", None, "t", 1, 0)))
    tc.commit_batch(store, "b1", signed(spark, ("s", "en", "t", 1, 10), ("s", "en", "t", 1, 5), ("q", None, "t", 1, 0)))
    tc.commit_batch(store, "b2", signed(spark, ("s", "en", "t", -1, -5), ("s", "en", "t", 1, 7)))
    want = {("s", "en", "t"): (2, 17), ("q", None, "t"): (1, 0)}
    assert rows(tc.totals(spark, store)) == want
    tc.compact(spark, store)
    assert rows(tc.totals(spark, store)) == want
    tc.commit_batch(store, "b3", signed(spark, ("q", None, "t", -1, 0), ("s", "en", "t", 0, 3)))
    assert rows(tc.totals(spark, store)) == {("s", "en", "t"): (2, 20)}
    tc.compact(spark, store)
    assert rows(tc.totals(spark, store)) == {("s", "en", "t"): (2, 20)}


def test_nothing_committed_or_counted(spark, tmp_path):
    assert rows(tc.totals(spark, str(tmp_path / "none"))) == {}
    tc.commit_batch(str(tmp_path / "some"), "b", tc.changes(tc.counted(empty(spark)), 1))
    assert rows(tc.totals(spark, str(tmp_path / "some"))) == {}


def test_names_of_batches_are_text(spark, tmp_path):
    one = signed(spark, ("s", "en", "t", 1, 10))
    store = str(tmp_path / "a")
    tc.commit_batch(store, "01", one)
    tc.compact(spark, store)
    tc.commit_batch(store, "load", one)
    assert rows(tc.totals(spark, store)) == {("s", "en", "t"): (2, 20)}
    store = str(tmp_path / "b")
    tc.commit_batch(store, "01", one)
    tc.compact(spark, store)
    for name in ("1", "2001-01-01", "a/b=c %"):
        for _ in range(2):
            tc.commit_batch(store, name, one)
    assert rows(tc.totals(spark, store)) == {("s", "en", "t"): (4, 40)}
    tc.compact(spark, store)
    assert rows(tc.totals(spark, store)) == {("s", "en", "t"): (4, 40)}


def test_query_against_a_plain_count(spark, tmp_path):
    """Ids that are shared or missing, with and without an address, with and without a label."""
    more = [
        (1, "write to a.b@example.com now", "en", "a", None, None, None, None),
        (1, "write to nobody at all today", "en", "a", None, None, None, None),
        (None, "or to c@example.org and d@example.org", "en", "a", None, None, None, None),
        (50, "e@example.org", None, None, None, None, None, None), (51, "poor text", "en", "a", None, None, None, None),
    ]
    docs = awkward(spark, *more)
    written(docs, tmp_path / "documents.parquet")
    labels = [(1, 0, 0), (50, 0, 1), (51, 0, 0), (51, 0, 0), (4, 1, 0), (None, 0, 0), (999, 0, 0)]
    written(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path / "labels.parquet")
    want = defaultdict(lambda: [0, 0])
    for r in docs.collect():
        text = re.sub(tc.MAIL, "[mail]", r.text or "")
        if r.doc_id in (1, 50, 51):
            continue
        for name, n in (("byte_bpe_50k", len(byte_bpe().encode_ordinary(text))), ("space_words", len(text.encode().split()))):
            want[r.source, r.lang, name][0] += 1
            want[r.source, r.lang, name][1] += n
    assert rows(tc.op2_token_counts(spark, str(tmp_path))) == {k: tuple(v) for k, v in want.items()}
