import corpus_pipeline as cp
from cases import awkward, written
from test_toxicity import corpus


def test_stages_on_small_tables(spark, tmp_path):
    docs, labels = corpus(spark, 400)
    item = " ".join(f"item{k}" for k in range(20))
    more = [(1000, f"a text that quotes {item}", "en", None, None, None, None, None)]
    rows = [tuple(r) for r in docs.collect()] + more
    written(awkward(spark, *rows), tmp_path / "documents.parquet")
    written(labels, tmp_path / "labels.parquet")
    written(spark.createDataFrame([(1, item)], "item_id long, text string"), tmp_path / "benchmark.parquet")
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in cp.STAGES:
        before, docs = docs, cp.write_through(stage(spark, docs, str(tmp_path)), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in seen.items()}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    assert len(ids["toxicity"] & toxic) <= 4 and len(ids["toxicity"] - toxic) >= 315
    assert seen["exact_dedup"].count() == seen["exact_dedup"].select("text").na.fill("").distinct().count()
    assert 1000 in ids["jaccard_join"] and 1000 not in ids["decontamination"]
    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == ids["decontamination"]
    assert cp.run(spark, str(tmp_path)).count() == len(packed)


def test_registered_queries():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
