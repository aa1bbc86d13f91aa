"""Documents with Jaccard similarity of at least 85 per cent of their 4-word shingles.

Shingles are put in one order, rare ones first. Two sets that link share at least l of the
first ``n - ceil(0.85 n) + l`` shingles of each, for every l, and fewer places count once
both sizes are known. A document's l, the number of
matches asked of its prefix, grows with the estimated cost of its candidates: a longer
prefix costs one more entry a step, and asks for one more match before a pair is looked at.

For classes of links no group of near copies is expanded into all its
pairs at first: in every prefix entry the members are paired with three hubs. The verified
links join documents into components. What remains are entries that hold several
components; there all pairs across components are counted, and those with enough matches
verified. No class is lost, as a pair left out lies within one component already. Where the
links themselves are wanted, :func:`linked` then counts all pairs within components as well.

A pair is verified in steps. Parity bitmaps, folded to 256 bits where entries meet and then whole, give a lower bound on how much two sets
differ and turn most unlinked pairs away; the texts of the others are compared in full.
Copies with one set are one node from the beginning. Everything that is broadcast has a
fixed size: the list of frequent shingles and two bitmaps that save shuffles but decide
nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tripartite.llm.bitmaps import bitmap, has, slot
from tripartite.llm.common import batches, most_frequent, packed, read, text_of, unpacked
from tripartite.llm.components import components
from tripartite.llm.shingles import common, fingerprint, least_difference, parity, shingle_sets, sketch
from tripartite.sources.scratch import write_through

PERCENT = 85
MOST_MATCHES = 4
FREQUENT = 200_000  # shingles whose frequency is known to the order
FREQUENT_IN_BATCH = 3
MEMBERS = 256  # of an entry and component that one salt pairs with all others
SKETCH = ("s0", "s1", "s2", "s3")  # columns of a node's folded bitmap
FIRST = 12  # entries of a node that each of its entries knows
PAIR_COST = 20  # of looking at one candidate, in prefix entries


def least_common(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles that a set of n must share with any set it links to: ceil(0.85 n)."""
    return (PERCENT * n + 99) // 100


def may_link(a: str, b: str) -> Column:
    """Sizes that allow a link."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def within(pos: str, n: str, other: str, matches: Column | str) -> Column:
    """Whether a place lies in the prefix that the sizes of both sets leave: a link shares
    at least ``85 / 185`` of the sum, and all but that many shingles may come first."""
    shared = F.expr(f"({PERCENT} * ({n} + {other}) + {99 + PERCENT}) div {100 + PERCENT}")
    return F.col(pos) < F.col(n) - shared + matches


# ---- nodes ---------------------------------------------------------------------------------


def _sets(docs: DataFrame) -> DataFrame:
    """(key, fp, n) of every document; the first row of a batch lists its frequent shingles."""
    batches(docs.sparkSession)

    def run(parts):
        for batch in parts:
            sets = shingle_sets(batch.column(1))
            every = np.concatenate([*sets, np.empty(0, np.uint64)])
            every.sort()
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else every[:0].astype(int)
            size = np.diff(np.append(first, len(every)))
            often = size >= FREQUENT_IN_BATCH
            listed = [
                {"shingle": s, "n": n}
                for s, n in zip(every[first[often]].view(np.int64).tolist(), size[often].tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [listed] + [None] * (len(sets) - 1) if len(sets) else [],
                        pa.list_(pa.struct([("shingle", pa.int64()), ("n", pa.int64())])),
                    ),
                ],
                names=["key", "fp", "n", "frequent"],
            )

    kind = dict(docs.dtypes)["key"]
    schema = f"key {kind}, fp binary, n long, frequent array<struct<shingle:long,n:long>>"
    return docs.mapInArrow(run, schema)


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, ascending, and estimates of their frequency."""
    counts = sets.select(F.inline("frequent")).groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = most_frequent(counts, "n", FREQUENT).toArrow()
    key = rows["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], rows["n"].to_numpy()[order]


def prefix(shingles: np.ndarray, known: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The prefix of a set in the order (estimated frequency, hash), and its matches l.

    Of l = 1 .. :data:`MOST_MATCHES` the cheapest is taken: entries to read, and candidates,
    of which an l-th part at most can match l times.
    """
    n = len(shingles)
    free = n - least_common(n)
    freq = np.zeros(n, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        there = known[at] == shingles
        freq[there] = counts[at[there]]
        order = np.lexsort((shingles, freq))[: free + MOST_MATCHES]
        shingles, freq = shingles[order], freq[order]
    most = min(MOST_MATCHES, n - free)
    read = np.cumsum(freq)[free : free + most]
    steps = np.arange(1, most + 1)
    matches = int(np.argmin(read + steps + PAIR_COST * read / steps)) + 1
    return shingles[: free + matches], matches


def _nodes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """One row for each distinct set: id, fp, n, matches, prefix, bitmap, sketch, least key."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(parts):
        known, counts = shared.value
        for batch in parts:
            sets = shingle_sets(batch.column(1))
            kept: dict[bytes, int] = {}
            keys = batch.column(0).to_pylist()
            least: list = []
            rows: list[int] = []
            for k, own in enumerate(sets):
                if not len(own):
                    continue
                fp = fingerprint(own)
                if fp in kept:
                    j = kept[fp]
                    if keys[k] is not None and (least[j] is None or keys[k] < least[j]):
                        least[j] = keys[k]
                    continue
                kept[fp] = len(rows)
                rows.append(k)
                least.append(keys[k])
            found = [prefix(sets[k], known, counts) for k in rows]
            bitmaps = [parity(sets[k]) for k in rows]
            sketches = np.array([sketch(b, len(SKETCH)) for b in bitmaps], np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(kept), pa.binary()),
                    pa.array(least, batch.column(0).type),
                    pa.array([len(sets[k]) for k in rows], pa.int64()),
                    pa.array([m for _, m in found], pa.int64()),
                    pa.array([p.tobytes() for p, _ in found], pa.binary()),
                    pa.array(bitmaps, pa.binary()),
                    *[pa.array(np.ascontiguousarray(part)) for part in sketches.T],
                ],
                names=["fp", "key", "n", "matches", "prefix", "bitmap", *SKETCH],
            )

    kind = dict(docs.dtypes)["key"]
    schema = f"fp binary, key {kind}, n long, matches long, prefix binary, bitmap binary"
    each = docs.mapInArrow(run, schema + "".join(f", {c} long" for c in SKETCH))
    once = each.groupBy("fp").agg(
        F.min("key").alias("key"),
        *[F.first(c).alias(c) for c in ("n", "matches", "prefix", "bitmap", *SKETCH)],
    )
    # The ids are fixed by being written.
    return write_through(once.withColumn("id", F.monotonically_increasing_id()), "sets")


# ---- candidates ---------------------------------------------------------------------------------


def _exploded(nodes: DataFrame) -> DataFrame:
    """(token, id, n, matches, pos) for every prefix entry."""

    def run(parts):
        for batch in parts:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            bodies = [np.frombuffer(b, np.int64) for b in column["prefix"].to_pylist()]
            size = np.array([len(b) for b in bodies], np.int64)
            of = np.repeat(np.arange(len(bodies)), size)
            token = np.concatenate([*bodies, np.empty(0, np.int64)])
            pos = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), *[column[c].take(pa.array(of)) for c in ("id", "n", "matches")], pa.array(pos)],
                names=["token", "id", "n", "matches", "pos"],
            )

    rows = nodes.select("id", "n", "matches", "prefix")
    return rows.mapInArrow(run, "token long, id long, n long, matches long, pos long")


def _shared_entries(nodes: DataFrame) -> DataFrame:
    """Prefix entries that more than one node has, give or take a few by the bitmap."""
    entries = _exploded(nodes)
    often = entries.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = nodes.sparkSession.sparkContext.broadcast(bitmap(often, "token"))

    def run(parts):
        for batch in parts:
            slots = batch.column(batch.num_columns - 1).to_numpy()
            kept = batch.filter(pa.array(has(shared.value, slots)))
            yield kept.select(batch.schema.names[:-1])

    schema = ", ".join(f"{c} {t}" for c, t in entries.dtypes)
    return write_through(entries.withColumn("slot", slot("token")).mapInArrow(run, schema), "entries")


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """Each member of an entry with three of its members: the first by one order of all
    nodes, which gives near copies the same hub again and again, the first by an order
    of the entry's own, which gives them many, and the one that has the fewest rarer shingles
    before the entry. Rare shingles are what edits bring in, so that member lies in the middle of a
    family and links with most of it, where members at the rim link with few."""
    member = F.struct("id", "n", "pos")
    hubs = entries.groupBy("token").agg(
        F.count(F.lit(1)).alias("size"),
        F.min_by(member, F.xxhash64("id")).alias("always"),
        F.min_by(member, F.xxhash64("id", "token")).alias("own"),
        F.min_by(member, F.struct("pos", F.xxhash64("id"))).alias("middle"),
    )
    hubs = hubs.where("size > 1").select("token", F.explode(F.array("always", "own", "middle")).alias("hub"))
    near = within("pos", "n", "hub.n", F.lit(1)) & within("hub.pos", "hub.n", "n", F.lit(1))
    paired = entries.join(hubs, "token").where("hub.id <> id").where(may_link("n", "hub.n") & near)
    return paired.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()


def _remaining_pairs(entries: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs across components with as many matches as the lesser l of the two asks for.

    Most of the others share their place in a family of near copies, and with it matches of
    any number; sketches that travel with the entries turn pairs away where they meet. Long
    texts of a family meet in hundreds of entries. So an entry also knows the first few of its
    node: a pair that needs l matches and has them in these lists is kept only where the l-th is.
    """
    labelled = entries.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = write_through(labelled, "labelled_entries")
    mixed = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = labelled.join(mixed.where("low < high").select("token"), "token", "left_semi")
    mixed = write_through(mixed, "mixed_entries")
    in_order = F.array_sort(F.collect_list(F.struct("pos", "token")))
    first = mixed.groupBy("id").agg(F.slice(in_order, 1, FIRST)["token"].alias("first"))
    side = mixed.join(nodes.select("id", *SKETCH).join(first, "id"), "id")
    side = side.select("token", "component", "id", "n", "matches", "pos", "first", *SKETCH)
    a = side.select("token", *[F.col(c).alias(f"{c}_a") for c in side.columns[1:]])
    b = side.select("token", *[F.col(c).alias(f"{c}_b") for c in side.columns[1:]])
    met = a.join(b, "token").where("id_a < id_b and component_a <> component_b")
    differ = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in SKETCH), F.lit(0))
    met = met.where(differ * (100 + PERCENT) <= (F.col("n_a") + F.col("n_b")) * (100 - PERCENT))
    # Entries of all nodes are in one order, so these are the first that both have. Where the
    # l-th lies outside their prefixes, fewer than l lie within.
    asked = F.least("matches_a", "matches_b").cast("int")
    last = F.get(F.array_intersect("first_a", "first_b"), asked - 1)
    return _enough(met.where(F.col("token") == F.coalesce(last, "token")), last.isNotNull())


def _pairs_within(entries: DataFrame, found: DataFrame) -> DataFrame:
    """All pairs within components with as many matches as the lesser l of the two asks for.

    An entry's members of one component are dealt to salts by their number, so that no
    task has all pairs of a hot entry.
    """
    labelled = write_through(entries.join(found, "id"), "entries_within")
    sizes = labelled.groupBy("token", "component").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("salts"), F.count(F.lit(1)).alias("size"))
    side = labelled.join(sizes.where("size > 1").drop("size"), ["token", "component"])
    by = ["token", "component", "salt"]
    a = side.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    b = side.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    a = a.select(*by, *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "matches", "pos")])
    b = b.select(*by, *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "matches", "pos")])
    return _enough(a.join(b, by).where("id_a < id_b"))


def _enough(met: DataFrame, once: Column | bool = False) -> DataFrame:
    """Of pairs that met in entries those with sizes and matches that allow a link. Pairs that
    are there ``once`` have as many matches as they need."""
    matches = F.least("matches_a", "matches_b")
    met = met.where(may_link("n_a", "n_b"))
    # Only entries within both prefixes of that l count.
    met = met.where(within("pos_a", "n_a", "n_b", matches) & within("pos_b", "n_b", "n_a", matches))
    counted = met.groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b")).agg(
        F.count(F.lit(1)).alias("met"), F.first(F.when(F.lit(once), 1).otherwise(matches)).alias("asked")
    )
    return counted.where("met >= asked").select("a", "b")


# ---- verification ---------------------------------------------------------------------------------


def _not_too_different(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that the bitmaps allow: 185 * difference <= 15 * (n_a + n_b) is a link."""
    side = nodes.select("id", "n", "bitmap")
    joined = pairs.join(side.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("bitmap").alias("x")), "a")
    joined = joined.join(side.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("bitmap").alias("y")), "b")

    def run(parts):
        for batch in parts:
            a, b, n_a, n_b, x, y = (c.to_pylist() for c in batch.columns)
            kept = [
                (100 + PERCENT) * least_difference(p, q) <= (100 - PERCENT) * (m + n)
                for m, n, p, q in zip(n_a, n_b, x, y, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return joined.select("a", "b", "n_a", "n_b", "x", "y").mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, text) of the nodes in ``pairs``. A bitmap of their documents' keys keeps most
    other texts out of the shuffle."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = write_through(nodes.join(ids, "id", "left_semi").select("id", "fp", "key"), "needed")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(needed, "key"))

    def run(parts):
        for batch in parts:
            kept = batch.filter(pa.array(has(shared.value, batch.column(1).to_numpy())))
            if kept.num_rows:
                fps = [fingerprint(s) if len(s) else None for s in shingle_sets(kept.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), kept.column(0)], names=["fp", "text"])

    found = docs.select("text", slot("key").alias("slot")).mapInArrow(run, "fp binary, text string")
    joined = found.where("fp is not null").join(needed.select("id", "fp"), "fp")
    return write_through(joined.groupBy("id").agg(F.first("text").alias("text")), "texts")


def _links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose whole texts link."""
    passing = write_through(_not_too_different(pairs, nodes), "passing_pairs")
    texts = _texts(docs, nodes, passing)
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))

    def run(parts):
        for batch in parts:
            left, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            right, second = np.unique(batch.column(1).to_numpy(), return_index=True)
            x = dict(zip(left.tolist(), shingle_sets(batch.column(2).take(pa.array(first))), strict=True))
            y = dict(zip(right.tolist(), shingle_sets(batch.column(3).take(pa.array(second))), strict=True))
            kept = []
            for p, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                both = common(x[p], y[q])
                kept.append(100 * both >= PERCENT * (len(x[p]) + len(y[q]) - both))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = passing.join(b, "b").join(a, "a").select("a", "b", "x", "y")
    return write_through(joined.mapInArrow(run, "a long, b long"), "links")


# ---- the join -----------------------------------------------------------------------------------------


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, n_shingles, component_id), a row for each document.

    ``component_id`` is the smallest key that links reach, its own included; ``fp`` stands
    for the set of shingles. A null or empty text has no shingles and links with nothing;
    so it is its own component. Null keys are never the smallest while there is another.
    Documents that share a key but not their text are different nodes. An empty table
    gives an empty one; other columns are not read.
    """
    return _rows(_Joined(docs, key, text))


class _Joined:
    """The sets, nodes, entries and components that :func:`classes` and :func:`linked` share."""

    def __init__(self, docs: DataFrame, key: str, text: str):
        batches(docs.sparkSession)
        self.source = docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("text"))
        self.sets = write_through(_sets(self.source), "document_sets")
        self.nodes = _nodes(self.source, _frequent(self.sets))
        self.entries = _shared_entries(self.nodes)
        first = _links(self.source, self.nodes, write_through(_hub_pairs(self.entries), "hub_pairs"))
        self.found = write_through(components(first), "first_components")
        pairs = write_through(_remaining_pairs(self.entries, self.nodes, self.found), "remaining_pairs")
        if not pairs.isEmpty():
            self.found = components(first.unionByName(_links(self.source, self.nodes, pairs)))


def _rows(joined: _Joined, counts: DataFrame | None = None) -> DataFrame:
    """A row for each document; with ``counts`` (fp, n_links) also its number of links."""
    nodes, found = joined.nodes, joined.found
    named = found.join(nodes.select("id", "key"), "id")
    smallest = named.groupBy("component").agg(F.min("key").alias("component_id"))
    linked = found.join(smallest, "component").select("id", "component_id")
    by_set = nodes.join(linked, "id", "left").select("fp", F.coalesce("component_id", "key").alias("component_id"))
    rows = joined.sets.select("key", "fp", F.col("n").alias("n_shingles")).join(
        by_set if counts is None else by_set.join(counts, "fp"), "fp", "left"
    )
    rows = rows.withColumn("component_id", F.when(F.col("fp").isNull(), F.col("key")).otherwise(F.col("component_id")))
    return rows if counts is None else rows.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`classes` with ``n_links``, and all links between different sets.

    ``n_links`` is how many other rows a document links with; rows with the same set of
    shingles are among them, each for itself. The second table, (fp_a, fp_b), has every
    pair of linked sets once; copies of one set are no pair there. A family of n different
    near copies has up to n(n - 1)/2 links, and all of them are looked at, so this costs
    more than the classes alone.
    """
    joined = _Joined(docs, key, text)
    nodes = joined.nodes.select("id", "fp")
    pairs = write_through(_pairs_within(joined.entries, joined.found), "pairs_within")
    links = _links(joined.source, joined.nodes, pairs)
    copies = nodes.join(joined.sets.groupBy("fp").agg(F.count(F.lit(1)).alias("copies")), "fp")
    copies = write_through(copies, "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies.select(F.col("id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    counts = copies.join(others.withColumnRenamed("a", "id"), "id", "left").select(
        "fp", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    named = links.join(nodes.select(F.col("id").alias("a"), F.col("fp").alias("fp_a")), "a")
    named = named.join(nodes.select(F.col("id").alias("b"), F.col("fp").alias("fp_b")), "b").select("fp_a", "fp_b")
    return _rows(joined, counts), named


def drop_linked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, the one with the smallest key, with all its columns.

    Of several rows with that key the first by shingle set and text stays. Rows without
    shingles link with nothing and stay, and so do the rows of a class without any key.

    Most rows are told apart from those that go by a bitmap of keys and never shuffled.
    """
    marked = write_through(classes(docs, key, text).where("fp is not null and component_id is not null"), "classes")
    stays = marked.where("key = component_id").groupBy("component_id").agg(
        F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n")
    )
    stays = write_through(stays, "stays")
    goes = marked.select("key", "fp", "component_id").distinct().join(
        stays.select("component_id", F.col("fp").alias("first")), "component_id"
    )
    goes = goes.where(~(F.col("key").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("first"))))
    goes = write_through(goes.select("key", "fp"), "goes")
    several = stays.where("n > 1").select(F.col("component_id").alias("key"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(goes.select("key").unionByName(several), "key"))
    source = packed(docs, F.col(f"`{key}`").alias("key"), text_of(text).alias("text")).withColumn("slot", slot("key"))
    row = source.schema["row"]

    def clear(parts):
        for batch in parts:
            kept = batch.filter(pa.array(~has(shared.value, batch.column(1).to_numpy())))
            yield kept.select(["row"])

    def unclear(parts):
        for batch in parts:
            kept = batch.filter(pa.array(has(shared.value, batch.column(3).to_numpy())))
            fps = [fingerprint(s) if len(s) else None for s in shingle_sets(kept.column(2))]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns[:3], pa.array(fps, pa.binary())], names=["row", "key", "text", "fp"]
            )

    batches(docs.sparkSession)
    sure = source.select("row", "slot").mapInArrow(clear, StructType([row]))
    fields = [row, source.schema["key"], source.schema["text"], StructField("fp", BinaryType())]
    asked = source.select("row", "key", "text", "slot").mapInArrow(unclear, StructType(fields))
    gone = goes.select(F.col("key").alias("gone_key"), F.col("fp").alias("gone_fp"))
    asked = asked.join(
        gone, F.col("key").eqNullSafe(F.col("gone_key")) & (F.col("fp") == F.col("gone_fp")), "left_anti"
    )
    place = F.row_number().over(Window.partitionBy("key", "fp").orderBy("text"))
    asked = asked.withColumn("place", place).where("place = 1 or fp is null or key is null").select("row")
    return unpacked(sure.unionByName(asked), docs)


def op10_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    docs = read(spark, root, "documents").select("doc_id", "text")
    return classes(docs).select(F.col("key").alias("doc_id"), "n_shingles", "component_id")


ORACLE = r"""
with recursive docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as (
  select r, case when len(w) < 4 then w else w[i : i + 3] end as shingle
  from (select *, unnest(range(1, greatest(len(w) - 2, 2))) as i from docs where len(w) > 0)
  group by all
),
sizes as (select r, count(*) as n from sets group by r),
shared as (
  select x.r as a, y.r as b, count(*) as met from sets x join sets y using (shingle)
  where x.r < y.r group by all
),
links as (
  select a, b from shared join sizes x on x.r = a join sizes y on y.r = b
  where 100 * met >= 85 * (x.n + y.n - met)
),
both_ways as (select a, b from links union select b, a from links),
reached as (
  select r as a, r as b from docs
  union
  select reached.a, both_ways.b from reached join both_ways on reached.b = both_ways.a
)
select d.doc_id, coalesce(n, 0) as n_shingles, c.component_id
from docs d left join sizes using (r)
join (select reached.a as r, min(e.doc_id) as component_id from reached join docs e on e.r = reached.b group by all) c
using (r)
"""
