import random
import re

import duckdb
from cases import awkward, empty

from tripartite.llm import decontaminate as dc


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        m = min(window, len(v))
        for i in range(len(v) - m + 1 if m else 0):
            for k in range(len(w) - m + 1):
                if w[k : k + m] == v[i : i + m]:
                    hit.update(range(k, k + m))
                    found.add(str(item) if item is not None else "")
    return len(w), len(hit), sorted(found)


def got(docs, items):
    df = dc.mark(docs, items).select("row.doc_id", "row.text", "n_words", dc.n_hit().alias("n"), "items")
    return [(r.text, (r.n_words, r.n, r["items"])) for r in df.collect()]


def test_random_texts_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice(["a", "b", "C", "dé"]) for _ in range(n))
    items = [(i, say(rng.randint(0, 20))) for i in range(30)] + [(3, say(14)), (None, say(5)), (99, None)]
    docs = [(i, say(rng.randint(0, 80)) + (items[i][1] if i < 30 else "")) for i in range(60)] + [(77, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 40):  # in one block, and in many
        monkeypatch.setattr(dc, "BLOCK_WORDS", block)
        monkeypatch.setattr(dc.item_blocks, "__defaults__", (block,))
        for text, found in got(d, b):
            assert found == brute(text, items, dc.WINDOW), text


def test_contamination_rule(spark):
    item = " ".join(f"w{i}" for i in range(13))
    filler = " ".join(f"x{i}" for i in range(247))
    docs = [(1, f"{item} {filler}"), (2, f"{item} {filler} more"), (3, filler), (4, item.upper())]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in dc.drop_contaminated(d, b).collect()) == [2, 3]


def test_awkward_rows_and_empty_tables(spark):
    df = awkward(spark)
    items = spark.createDataFrame([(5, "two three"), (6, None), (7, "--")], "item_id long, text string")
    for text, found in got(df, items):
        assert found == brute(text, [(5, "two three")], dc.WINDOW)
    kept = dc.drop_contaminated(df, items)
    assert kept.columns == df.columns
    assert got(empty(spark), items) == []
    none = items.where("item_id = 6")
    assert all(n == 0 for _, (_, n, _) in got(df, none))


def test_oracle_sql(spark, tmp_path):
    rows = [(1, "One two, three"), (2, "two three one two three"), (3, None), (4, "é two THREE é")]
    items = [(10, "two three"), (9, "é"), (11, "")]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into benchmark values (?, ?)", items)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark_rows = sorted(tuple(r) for r in dc.op7_decontamination(spark, str(tmp_path)).collect())
    assert spark_rows == sorted(con.execute(dc.ORACLE).fetchall())
