"""Exact top-k by inner product with M-trees, searched best first.

Vectors are dealt into groups around a bounded number of pivots; a group that holds more
than its share is dealt on in parts. Each group becomes an M-tree in one task: pages of
routing objects with covering radii and of vectors, each entry with its distance to the
routing object above. A query goes to the group that promises most first, which gives it a
k-th score; then to those other groups alone whose cells can still beat that score.

Bounds. For a routing object c with radius r and any vector x below it, the inner product
q.x is at most q.c + |q| r. Before q.c is computed, the stored distance d to the routing
object p above gives q.c <= q.p + |q| d, so the entry may be out already; the same holds for
the vectors of a leaf. Scores are integers; bounds are widened by more than rounding can
take from them, and what they cannot rule out is computed in full.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripartite.llm.common import batches, read
from tripartite.sources.scratch import write_through

TOP = 20
SCALE = 64
QUERY_EVERY = 20

PAGE = 1_024  # entries of a page
FANOUT = 16  # routing objects that a set of vectors is split by
MOST_PIVOTS = 1024  # routing objects of the whole table; fitted on as many rows
GROUP = 65_536  # vectors of a group, at most some
GROUPS_AT_LEAST, SMALL_GROUP = 24, 2_048  # small tables are dealt wider, in groups not below this

_COPIES = 8_192  # queries in a batch on their way to groups

# Sums of products of floats of 64 and 32 bits are exact up to here.
_EXACT = float(1 << 53)
_EXACT_SINGLE = float(1 << 24)
# What rounding can take from a bound, relative to the sizes that go into it.
_SLACK = 1e-9


def quantized(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(``row``, ``id``, ``components``): floor(scale * x) of every vector that is there and
    has no null or non-finite component. ``row`` tells rows apart whose ids are equal."""
    components = F.col(f"`{vector}`").cast("array<double>")
    valid = F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(components.isNotNull() & valid).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").cast("long").alias("id"),
        F.transform(components, lambda x: F.floor(x * F.lit(float(scale)))).alias("components"),
    )


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Components as floats, a row each; a shorter vector is filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pc.list_value_length(column).fill_null(0), dtype=np.int64)
    values = np.asarray(column.flatten(), dtype=np.float64)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    made = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    made[rows, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return made


def _nearest(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot next to each vector, the first of equally near ones."""
    found = np.empty(len(vectors), np.int64)
    squares = (pivots * pivots).sum(1)
    for start in range(0, len(vectors), 4096):
        part = vectors[start : start + 4096]
        found[start : start + 4096] = (squares - 2 * (part @ pivots.T)).argmin(1)
    return found


def _distances(vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - to) ** 2).sum(1))


# ---- the tree ------------------------------------------------------------------------


@dataclass
class Page:
    """Entries under a routing object: in a leaf the places of vectors, elsewhere pages with
    the radii that cover them; ``away`` has each entry's distance to the object above."""

    objects: np.ndarray
    away: np.ndarray
    radii: np.ndarray
    below: list[Page] | None
    places: np.ndarray | None


class MTree:
    """A tree over the rows of a matrix, built top down."""

    def __init__(self, vectors: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        # Half the bytes where single precision still holds every inner product exactly.
        largest = (vectors * vectors).sum(1).max() if len(vectors) else 0.0
        self.kind = np.float32 if largest * 4 < _EXACT_SINGLE else np.float64
        self.largest = float(np.sqrt(largest))
        self.vectors, self.page, self.fanout = vectors, page, fanout
        self.center = vectors[len(vectors) // 2]
        self.root = self._grown(np.arange(len(vectors)), self.center)

    def _grown(self, places: np.ndarray, above: np.ndarray) -> Page:
        vectors = self.vectors[places]
        away = _distances(vectors, above)
        if len(places) <= self.page:
            return Page(vectors.astype(self.kind), away, np.zeros(len(places)), None, places)
        # Routing objects spread over the distances to the one above: a fixed choice.
        order = np.argsort(away, kind="stable")
        wanted = min(self.fanout, -(-len(places) // self.page))
        chosen = np.unique(vectors[order[np.linspace(0, len(order) - 1, wanted).astype(int)]], axis=0)
        near = _nearest(vectors, chosen)
        sets = [places[near == k] for k in range(len(chosen))]
        sets = [s for s in sets if len(s)]
        if len(sets) == 1:  # vectors too alike to be told apart: halves under one object
            half = len(places) // 2
            sets = [places[:half], places[half:]]
        routing = np.stack([self.vectors[s[len(s) // 2]] for s in sets])
        below = [self._grown(s, c) for s, c in zip(sets, routing, strict=True)]
        radii = np.array([p.away.max() if p.below is None else (p.away + p.radii).max() for p in below])
        return Page(routing.astype(self.kind), _distances(routing, above), radii, below, None)

    def search(self, query: np.ndarray, heap: TopK) -> None:
        """Offer the tree's vectors to ``heap``, best page first, until no page left can
        hold one that the heap would take."""
        size = float(np.sqrt(query @ query))
        exact = self.kind == np.float64 or size * self.largest < _EXACT_SINGLE
        asked = query.astype(self.kind) if exact else query
        waiting: list[tuple[float, int, Page, float]] = [(-np.inf, 0, self.root, float(query @ self.center))]
        count = 0
        while waiting:
            bound, _, page, score_above = heapq.heappop(waiting)
            least = heap.least
            if -bound < least:
                return
            # By what is stored: the score of the object above and the distances to it.
            promised = score_above + size * (page.away + page.radii)
            open_ = np.flatnonzero(promised + _SLACK * (abs(score_above) + np.abs(promised)) >= least)
            if not len(open_):
                continue
            if 2 * len(open_) > len(page.away):  # rows are not worth picking out
                scores = (page.objects @ asked)[open_].astype(np.float64)
            else:
                scores = (page.objects[open_] @ asked).astype(np.float64)
            if page.below is None:
                heap.offer(scores, page.places[open_])
                continue
            bounds = scores + size * page.radii[open_]
            bounds += _SLACK * (np.abs(scores) + np.abs(bounds))
            for k in np.flatnonzero(bounds >= least):
                count += 1
                heapq.heappush(waiting, (-bounds[k], count, page.below[open_[k]], float(scores[k])))


class TopK:
    """The k best (score, id) that have been offered, of equal scores the smaller ids (null
    last), but for the row ``own``; at least of score ``least`` as given."""

    def __init__(self, k: int, ids: np.ndarray, rows: np.ndarray, own: int, least: float = -np.inf):
        self.k, self.ids, self.rows, self.own, self.least = k, ids, rows, own, least
        self.scores, self.places = np.empty(0), np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, places: np.ndarray) -> None:
        take = (scores >= self.least) & (self.rows[places] != self.own)
        if not take.any():
            return
        scores = np.concatenate([self.scores, scores[take]])
        places = np.concatenate([self.places, places[take]])
        if len(scores) > self.k:
            order = np.lexsort((self.rows[places], self.ids[places], -scores))[: self.k]
            scores, places = scores[order], places[order]
        self.scores, self.places = scores, places
        if len(scores) == self.k:
            self.least = max(self.least, scores.min())


# ---- over the whole table ---------------------------------------------------------------

_NO_ID = np.iinfo(np.int64).max  # sorts behind every id

_DEALT = "cell long, part long, row long, id long, components array<bigint>, query boolean, least double"
_FOUND = "query_row long, query_id long, row long, id long, score long"


def _ids(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.fill_null(int(_NO_ID)), dtype=np.int64)


def _exact(vectors: np.ndarray) -> None:
    if len(vectors) and (vectors * vectors).sum(1).max() >= _EXACT:
        raise ValueError("components are too large for exact inner products")


class _Group:
    """The vectors of one group, then the queries sent to it; the tree grows at the first."""

    def __init__(self, top: int, width: int):
        self.top, self.width, self.held = top, width, []
        self.tree: MTree | None = None

    def take(self, vectors: pa.RecordBatch) -> None:
        self.held.append(vectors.select(["row", "id", "components"]))

    def answer(self, queries: pa.RecordBatch) -> pa.RecordBatch | None:
        if self.tree is None:
            if not self.held:
                return None
            table = pa.Table.from_batches(self.held)
            held = _matrix(table["components"], self.width)
            _exact(held)
            self.ids, self.rows = _ids(table["id"]), np.asarray(table["row"], dtype=np.int64)
            self.tree, self.held = MTree(held), []
        wanted = _matrix(queries["components"], self.width)
        _exact(wanted)
        columns: list[list[np.ndarray]] = [[], [], [], [], []]
        of_query = zip(
            wanted, np.asarray(queries["row"], dtype=np.int64), _ids(queries["id"]),
            np.asarray(queries["least"], dtype=np.float64), strict=True,
        )
        for query, row, query_id, least in of_query:
            heap = TopK(self.top, self.ids, self.rows, row, least)
            self.tree.search(query, heap)
            n = len(heap.places)
            made = (np.full(n, row), np.full(n, query_id), self.rows[heap.places], self.ids[heap.places], heap.scores)
            for column, values in zip(columns, made, strict=True):
                column.append(values)
        row, query_id, found, found_id, score = (np.concatenate(c).astype(np.int64) for c in columns)
        return pa.RecordBatch.from_pydict({
            "query_row": row, "query_id": _nullable(query_id), "row": found, "id": _nullable(found_id), "score": score
        })


def _search_groups(top: int, width: int):
    """For rows sorted by group, vectors before queries: a task holds the vectors of one
    group and a batch of the queries, however many those are."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, _Group(top, width)
        for batch in parts:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch[c], dtype=np.int64) for c in ("cell", "part", "asked")], 1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(starts, starts[1:], strict=False):
                cell, part, is_query = keys[start].tolist()
                if (cell, part) != at:
                    at, group = (cell, part), _Group(top, width)
                rows = batch.slice(start, stop - start)
                if not is_query:
                    group.take(rows)
                elif (found := group.answer(rows)) is not None:
                    yield found

    return run


def _nullable(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == _NO_ID)


def _best(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each query and their ranks."""
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    vectors: DataFrame, queries: DataFrame, top: int = TOP, *, group: int = GROUP, pivots: int = MOST_PIVOTS
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): of each query, a row of ``queries``,
    the ``top`` rows of ``vectors`` with the largest inner products (all, if they are
    fewer), equal ones by the smaller id, nulls last, then by ``row``. Both tables as from
    :func:`quantized`, ``queries`` a part of ``vectors``; a query's own row is no candidate,
    another row with its id is. Vectors of different lengths meet as if filled up with zeros.

    Nothing is dropped: a group is left out for a query only where its bound is below a
    score that ``top`` other rows reach.
    """
    spark = vectors.sparkSession
    batches(spark)
    stats = vectors.agg(F.count(F.lit(1)), F.max(F.size("components"))).first()
    count, width = stats[0], stats[1] or 0
    size = min(group, max(SMALL_GROUP, -(-count // GROUPS_AT_LEAST)))
    wanted = max(1, min(pivots, -(-count // size)))
    # Bounded by ``pivots``, in an order that has nothing to do with the vectors.
    sample = vectors.orderBy(F.xxhash64("row"), "row").limit(wanted).select("components").toArrow()
    centers = _matrix(sample["components"], width)
    if not len(centers):
        centers = np.zeros((1, width))

    dealt = write_through(vectors.mapInArrow(_to_cells(centers, width), f"{_DEALT}, away double"), "dealt")
    # A row for each pivot: how many vectors it has and how far the last one is.
    cells = {r["cell"]: (r["n"], r["away"]) for r in dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away")).collect()}
    parts = {cell: -(-n // size) for cell, (n, _) in cells.items()}
    rule = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]) if parts else None
    if rule is not None:
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row"), rule[F.col("cell")]))
    members = dealt.drop("away")

    def run(queries: DataFrame) -> DataFrame:
        sent = members.unionByName(queries).withColumn("asked", F.col("query").cast("long"))
        order = ["cell", "part", "asked"]
        return sent.repartition("cell", "part").sortWithinPartitions(*order).mapInArrow(_search_groups(top, width), _FOUND)

    visits = _to_groups(centers, width, cells, parts)
    first = write_through(run(queries.mapInArrow(visits(None), _DEALT)), "first")
    ranked = _best(first, top)
    reached = ranked.where(F.col("rank") == top).select(F.col("query_row").alias("row"), F.col("score").alias("reached"))
    again = queries.join(reached, "row", "left")
    others = run(again.mapInArrow(visits("reached"), _DEALT))
    best = _best(ranked.drop("rank").unionByName(others), top)
    return best.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _to_cells(centers: np.ndarray, width: int):
    """Each vector with its pivot and the distance to it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            held = _matrix(batch["components"], width)
            near = _nearest(held, centers)
            n = len(near)
            yield pa.RecordBatch.from_pydict({
                "cell": near, "part": np.zeros(n, np.int64), "row": batch["row"], "id": batch["id"],
                "components": batch["components"], "query": pa.array([False] * n, pa.bool_()),
                "least": np.zeros(n), "away": np.sqrt(((held - centers[near]) ** 2).sum(1)),
            })

    return run


def _to_groups(centers: np.ndarray, width: int, cells: dict[int, tuple[int, float]], parts: dict[int, int]):
    """Sends queries to groups: to the most promising cell's first part, or, with the score
    that it has ``reached`` there, to all other groups of cells that can reach it too."""
    known = np.array(sorted(cells), dtype=np.int64)
    radii = np.array([cells[c][1] for c in known.tolist()])
    groups = np.array([parts[c] for c in known.tolist()], dtype=np.int64)
    # All groups in a row: the place of their cell, their part, and each cell's first group.
    of_group = np.repeat(np.arange(len(known)), groups)
    first = np.cumsum(groups) - groups
    part_of = np.arange(len(of_group)) - first[of_group]

    def sent(batch: pa.RecordBatch, reached: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which query goes to which group, and the least score that counts for each query."""
        wanted = _matrix(batch["components"], width)
        scores = wanted @ centers[known].T
        bounds = scores + np.sqrt((wanted * wanted).sum(1))[:, None] * radii
        bounds += _SLACK * (np.abs(scores) + np.abs(bounds))
        home = bounds.argmax(1)
        if reached is None:
            return np.arange(len(wanted)), first[home], np.full(len(wanted), -np.inf)
        least = np.asarray(batch[reached].cast(pa.float64()).fill_null(-np.inf))
        open_ = (bounds >= least[:, None])[:, of_group]
        open_[np.arange(len(wanted)), first[home]] = False  # been there
        query, group = np.nonzero(open_)
        return query, group, least

    def visits(reached: str | None):
        def run(batch_parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batch_parts:
                if not len(known) or not batch.num_rows:
                    continue
                query, group, least = sent(batch, reached)
                for start in range(0, len(query), _COPIES):
                    at, to = query[start : start + _COPIES], group[start : start + _COPIES]
                    taken = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_pydict({
                        "cell": known[of_group[to]], "part": part_of[to], "row": taken["row"], "id": taken["id"],
                        "components": taken["components"], "query": pa.array([True] * len(at), pa.bool_()),
                        "least": least[at],
                    })

        return run

    return visits


def op13_vector_search(spark: SparkSession, root: str) -> DataFrame:
    table = read(spark, root, "embeddings").select("vec_id", "embedding")
    vectors = write_through(quantized(table, "vec_id", "embedding"), "vectors")
    return search(vectors, vectors.where(F.col("id") % QUERY_EVERY == 0))


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q, whole c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
