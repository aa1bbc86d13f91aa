import hashlib
import random
import re

import duckdb
import pytest

from tripartite.llm import fill_middle as fm
from pyspark.sql import functions as F
from cases import awkward, empty, written

UNITS = re.compile(r"[^\n]*\n|[^\n]+")


def brute(doc_id, text, seed=7, rate=100, suffix_first=50):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    i, j = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(u) for u in (units[:i], units[i:j], units[j:]))
    if h[3] % 100 < suffix_first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1, 2, 3, 5, 8, 4096])
def test_tree_finds_every_line_end(block):
    rng = random.Random(block)
    for _ in range(200):
        text = "".join(rng.choice("ab\n\n\r\U0001f600é") for _ in range(rng.randint(0, 40)))
        units = UNITS.findall(text)
        tree = fm.LineTree(text, block)
        assert tree.total == len(units)
        assert [tree.end(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_rows_as_by_brute_force(spark):
    more = [
        (100 + k, t, "en", "a", None, None, None, None)
        for k, t in enumerate(["\n", "\n\n\n", "a\r\nb\x0bc d\n\ne", "x <P> y", "x <S>\n", "<M>", "<P", "é\U0001f600\nz" * 3000])
    ]
    docs = awkward(spark, *more)
    made = fm.transform(docs)
    assert set(made.columns) == {"row", "n", "form", "prefix_chars", "middle_chars", "output"}
    made = made.select("*", fm.restored(F.col("output"), F.col("form")).alias("again")).collect()
    assert len(made) == docs.count()
    for r in made:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.row.doc_id, r.row.text)
        assert r.again == (r.row.text or "")
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert fm.transform(empty(spark)).isEmpty()


def test_rates_are_parameters(spark):
    docs = awkward(spark)
    for rate, first in ((0, 50), (30, 0), (100, 100)):
        for r in fm.transform(docs, seed=3, rate=rate, suffix_first=first).collect():
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(
                r.row.doc_id, r.row.text, 3, rate, first
            )


def test_query_equals_sql(spark, tmp_path):
    written(awkward(spark).where("doc_id is not null"), tmp_path / "documents.parquet")
    for root in (str(tmp_path), "/root/testdata/sf0.001"):
        found = fm.op12_fill_middle(spark, root)
        con = duckdb.connect()
        source = f"{root}/documents.parquet" + ("/*.parquet" if root == str(tmp_path) else "")
        con.execute(f"create view documents as select * from '{source}'")
        answer = con.execute(fm.ORACLE)
        columns = [c[0] for c in answer.description]
        assert sorted(columns) == sorted(found.columns)
        assert sorted(map(tuple, found.select(*columns).collect())) == sorted(answer.fetchall())
