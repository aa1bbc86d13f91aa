import hashlib
from collections import defaultdict

from cases import awkward, empty

from tripartite.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, first = max(known, default=None), True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != keep
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in exact_dedup.mark_copies(df, carry=False).collect()), key=repr)


def test_awkward_rows(spark):
    df = awkward(spark)
    assert found(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_hot_text_is_split_and_shared_beginnings_are_told_apart(spark):
    rows = [(i, "the same text everywhere") for i in range(3000)]
    rows += [(i, f"{'p' * 40} {i % 700}") for i in range(3000, 6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(df) == brute(rows)
    hot = exact_dedup.hot_texts(df.select("text"))
    assert hot.count() == 1


def test_kept_rows_keep_their_columns(spark):
    df = awkward(spark)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert kept.count() == df.select("text").na.fill("").distinct().count()


def test_empty_table(spark):
    assert found(empty(spark)) == []


def test_plan_is_native_with_one_exchange_of_texts(spark):
    df = awkward(spark)
    plan = exact_dedup.mark_copies(df, carry=False)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
