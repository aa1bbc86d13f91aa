import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripartite.llm import vector_search as vs
from cases import written

SCHEMA = "vec_id long, embedding array<float>, label int, `row` string, `id` long, score double, `query` int"


def vectors(spark, n, seed=1, width=8, more=()):
    """Clusters, a third of them one vector, of every size from 0 up."""
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for k in range(n):
        if k % 3 == 0:
            v = centers[0]
        else:
            v = [x + rng.gauss(0, 0.2) for x in rng.choice(centers)]
            v = [x * rng.choice([0.1, 1, 3]) for x in v]
        rows.append((k, [float(np.float32(x)) for x in v], 0, "r", 1, 0.5, 7))
    return spark.createDataFrame([*rows, *more], SCHEMA).repartition(3)


def floors(v):
    return [math.floor(64 * x) for x in v]


def valid(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def brute(rows, top=20):
    held = [(r.vec_id, floors(r.embedding)) for r in rows if valid(r.embedding)]
    found = []
    for at, (q, u) in enumerate(held):
        if q is None or q % 20:
            continue
        scored = sorted(
            ((-sum(a * b for a, b in zip(u, v)), c is None, c or 0) for k, (c, v) in enumerate(held) if k != at)
        )
        found += [(q, k, None if none else c, -s) for k, (s, none, c) in enumerate(scored[:top], 1)]
    return sorted(found, key=repr)


def run(df, top=20, **sizes):
    held = vs.write_through(vs.quantized(df, "vec_id", "embedding"), "vectors")
    return vs.search(held, held.where(F.col("id") % 20 == 0), top, **sizes)


def collected(found):
    return sorted((tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


@pytest.mark.parametrize(("n", "sizes"), [(15, {}), (900, {"group": 100}), (900, {"group": 50, "pivots": 3}), (400, {"pivots": 1})])
def test_as_by_brute_force(spark, n, sizes):
    df = vectors(spark, n)
    assert collected(run(df, **sizes)) == brute(df.collect())


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    more = [
        (2000, None, None, None, None, None, None), (2020, [1.0, None], 1, "r", 1, 0.5, 7), (2040, [nan, 1.0], 1, "r", 1, 0.5, 7),
        (2060, [inf, 1.0], 1, "r", 1, 0.5, 7), (2080, [], 1, "r", 1, 0.5, 7), (2100, [1.0, -2.0], 1, "r", 1, 0.5, 7),
        (40, [1.0, -2.0] * 4, 1, "r", 1, 0.5, 7), (None, [3.0] * 8, 1, "r", 1, 0.5, 7), (None, [3.0] * 8, 1, "r", 1, 0.5, 7),
        (7, [5.0] * 12, 1, "r", 1, 0.5, 7), (-20, [-1.0] * 8, 1, "r", 1, 0.5, 7),
    ]
    df = vectors(spark, 120, more=more)
    assert collected(run(df, group=40)) == brute(df.collect())
    assert run(df.where("false")).isEmpty()
    assert run(df.where("vec_id = 20")).isEmpty()
    assert collected(run(df, top=3)) == brute(df.collect(), 3)


def test_large_components_are_refused_where_they_cannot_be_exact(spark):
    df = spark.createDataFrame([(0, [1e9]), (1, [1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        run(df).collect()


def test_tree_is_searched_in_part_and_covers_its_entries():
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 400, (40, 16))
    held = np.floor(centers[rng.integers(0, 40, 8000)] + rng.normal(0, 8, (8000, 16)))
    tree = vs.MTree(held, page=64)

    def check(page, above):
        assert np.allclose(page.away, np.sqrt(((page.objects - above) ** 2).sum(1)))
        if page.below is None:
            return [page.places]
        inside = []
        for c, r, p in zip(page.objects, page.radii, page.below):
            places = np.concatenate(check(p, c))
            assert np.sqrt(((held[places] - c) ** 2).sum(1)).max() <= r + 1e-6
            inside.append(places)
        return inside

    assert sorted(np.concatenate(check(tree.root, tree.center))) == list(range(8000))
    seen = []

    class Counting(vs.TopK):
        def offer(self, scores, places):
            seen.append(len(places))
            super().offer(scores, places)

    ids = np.arange(8000)
    for at in range(0, 8000, 400):
        heap = Counting(20, ids, ids, at)
        tree.search(held[at], heap)
        scores = held @ held[at]
        scores[at] = -np.inf
        best = np.lexsort((ids, -scores))[:20]
        order = np.lexsort((heap.places, -heap.scores))
        assert list(heap.places[order]) == list(best)
    # Of 8,000 vectors a query computes a small part.
    assert sum(seen) / 20 < 1600


def test_query_equals_sql(spark, tmp_path):
    written(vectors(spark, 300).select("vec_id", "embedding", "label"), tmp_path / "embeddings.parquet")
    for root, source in ((str(tmp_path), "/*.parquet"), ("/root/testdata/sf0.001", "")):
        found = vs.op13_vector_search(spark, root)
        con = duckdb.connect()
        con.execute(f"create view embeddings as select * from '{root}/embeddings.parquet{source}'")
        answer = con.execute(vs.ORACLE)
        columns = [c[0] for c in answer.description]
        assert sorted(columns) == sorted(found.columns)
        assert sorted(map(tuple, found.select(*columns).collect())) == sorted(answer.fetchall())
        assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
