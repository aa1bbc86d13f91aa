"""Conversations put in order: system, then user and assistant in turns.

A conversation's rows, by turn, are kept, re-roled or deleted and empty turns inserted at the
least cost (:mod:`turn_lattice`). Conversations of ordinary length are sorted into a task and
repaired one after the other, one in memory at a time. A conversation with more rows or text
than that may take is worked on in pieces of a bounded number of rows: what a piece does to
the prices behind it and the states before it is a small table, the tables of a conversation
are chained, and every piece then traces its own rows.

Nulls count as one space, in ids of turns for the order as the smallest. Rows of equal turn
are taken by role, then text; repeated rows are duplicates. A conversation without rows has
nothing to repair, and an empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tripartite.llm import turn_lattice as lattice
from tripartite.llm.common import batches, read
from tripartite.operators.numbering import number_rows
from tripartite.sources.scratch import write_through

# What one conversation may hold to be repaired in memory, and the rows of a piece else.
MOST_ROWS, MOST_CHARS = 4_096, 8 << 20
PIECE = 1_024
# Long conversations up to here are told apart by a broadcast of their ids.
_FEW = 10_000

SPACE = " \t\n\x0b\f\r"
STOPS = ".!?"

_REPAIRED = "array<struct<role: string, text: string>>"
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_COUNTED = ", ".join(f"{c} long" for c in _COUNTS)


def turns(conversations: DataFrame) -> DataFrame:
    """(``conv``, ``turn``, ``role``, ``text``, ``copy``, ``there``) of a table of conversations."""
    given = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), *given,
        F.lit(0).alias("copy"), F.lit(True).alias("there"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """:func:`turns` with a fifth of the rows damaged, by a checksum of conversation and turn:
    dropped (kept as rows that are not ``there``), emptied, without its stops, repeated, or
    said by the user."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")])
    drawn = turns(conversations).withColumn("drawn", F.crc32(name) % 20)
    text = (
        F.when(F.col("drawn") == 1, "")
        .when(F.col("drawn") == 2, F.regexp_replace("text", f"[{STOPS}]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("drawn") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return drawn.select(
        "conv", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy"), (F.col("drawn") != 0).alias("there"),
    )


def fault(text: str) -> str | None:
    """``blank`` or ``truncated``, by the text alone."""
    end = text.rstrip(SPACE)
    return "blank" if not end else None if end[-1] in STOPS else "truncated"


def _jumps(initials: str) -> int:
    """Neighbours that may not follow each other."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def repair_rows(rows: list[tuple[int | None, str, str]]) -> tuple[dict[str, int], str, list[tuple[str, str]]]:
    """Counts, audit and repaired (role, text) of one conversation's (turn, role, text)."""
    seen: set[tuple[str, str]] = set()
    kinds, counts = [], dict.fromkeys(_COUNTS, 0)
    for _, role, text in rows:
        found = fault(text)
        if found != "blank":
            if (role, text) in seen:
                found = "duplicate"
            seen.add((role, text))
        if found:
            counts[found] += 1
        kinds.append(lattice.kind_of(role[:1], found in ("blank", "duplicate"), found == "truncated"))
    counts["gaps"] = _gaps([turn for turn, _, _ in rows])
    counts["illegal"] = _jumps("".join(role[:1] or "?" for _, role, _ in rows))
    base, prices, layers = lattice.solve(kinds)
    counts["cost"] = base + prices[lattice.NONE]
    audit, repaired, state = [], [], lattice.NONE
    for made, row in zip(layers, [*rows, None], strict=True):
        for put in made.inserts[state]:
            audit.append(lattice.INSERT)
            repaired.append((lattice.WRITTEN[put], ""))
        letter, state = made.letter[state], made.to[state]
        audit.append(letter)
        if letter in (lattice.KEEP, lattice.REROLE):
            repaired.append((row[1] if letter == lattice.KEEP else lattice.WRITTEN[state], row[2]))
    return counts, "".join(audit), repaired


def _pieces(conv: DataType) -> str:
    return f"conv {conv.simpleString()}, piece long, {_COUNTED}, audit string, repaired {_REPAIRED}"


def _repaired_batch(done: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    repaired = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    made = {
        "conv": pa.array([conv for conv, _ in done], conv_type),
        "piece": pa.array([0] * len(done), pa.int64()),
        **{c: pa.array([result[0][c] for _, result in done], pa.int64()) for c in _COUNTS},
        "audit": pa.array([result[1] for _, result in done], pa.string()),
        "repaired": pa.array(
            [[{"role": r, "text": t} for r, t in result[2]] for _, result in done], repaired
        ),
    }
    return pa.RecordBatch.from_pydict(made)


def _repair_sorted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations whose rows come one after the other, in order."""
    nothing = object()
    at, rows = nothing, []
    for batch in parts:
        done = []
        columns = [batch[c].to_pylist() for c in ("conv", "turn", "role", "text", "there")]
        for conv, turn, role, text, there in zip(*columns, strict=True):
            if at is nothing or conv != at:
                if at is not nothing:
                    done.append((at, repair_rows(rows)))
                at, rows = conv, []
            if there:
                rows.append((turn, role, text))
        kind = batch.schema.field("conv").type
        if done:
            yield _repaired_batch(done, kind)
    if at is not nothing:
        yield _repaired_batch([(at, repair_rows(rows))], kind)


def repair(rows: DataFrame, most_rows: int = MOST_ROWS, most_chars: int = MOST_CHARS, piece: int = PIECE) -> DataFrame:
    """Repaired conversations: (``conv``, ``piece``, counts, ``audit``, ``repaired``), from
    rows as :func:`turns` or :func:`damaged` give them. One piece for each conversation, but
    for very long ones; the counts of a conversation are the sums over its pieces, audit
    and repaired rows those of its pieces in their order."""
    spark = rows.sparkSession
    batches(spark)
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text")).alias("chars"))
    long = write_through(sizes.where((F.col("rows") > most_rows) | (F.col("chars") > most_chars)).select("conv"), "long")
    several = long.count()
    schema = _pieces(rows.schema["conv"].dataType)
    ordinary = rows
    if several:
        named = long.select(F.col("conv").alias("long"))
        same = F.col("conv").eqNullSafe(F.col("long"))
        named = F.broadcast(named) if several <= _FEW else named
        ordinary = rows.join(named, same, "left_anti")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    whole = ordinary.repartition("conv").sortWithinPartitions(*order).mapInArrow(_repair_sorted, schema)
    if not several:
        return whole
    return whole.unionByName(_repair_long(rows.join(named, same, "left_semi"), piece))


# ---- long conversations ---------------------------------------------------------------------


def _repair_long(rows: DataFrame, piece: int) -> DataFrame:
    """Numbered over all of them at once, so that no task sees a conversation whole."""
    conv = rows.schema["conv"].dataType
    key = F.concat(F.when(F.col("conv").isNull(), "-").otherwise("+"), F.coalesce(F.col("conv").cast("string"), F.lit("")))
    # A conversation of which nothing is there is not among the numbered, but comes out.
    kept = rows.where("there")
    nothing = [f"cast(0 as long) as {c}" for c in ["piece", *_COUNTS]]
    empty = (
        rows.groupBy("conv").agg(F.max("there").alias("any")).where("not any")
        .selectExpr("conv", *nothing, "'' as audit", f"cast(array() as {_REPAIRED}) as repaired")
    )
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    numbered = write_through(
        number_rows(kept.drop("there"), order, "n").select("*", key.alias("key"), F.expr(f"(n - 1) div {piece} as piece")),
        "numbered",
    )
    # The first of equal rows, by its number: no group of them has to meet in a task.
    firsts = numbered.groupBy("key", "role", F.sha2(F.col("text").cast("binary"), 256)).agg(F.min("n").alias("first"))
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    found = (
        F.when(end == "", "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.substring(end, -1, 1).isin(*STOPS), "truncated")
        .otherwise("")
    )
    told = write_through(
        numbered.join(firsts.select("first"), F.col("n") == F.col("first"), "left")
        .select("key", "piece", "n", "turn", F.substring("role", 1, 1).alias("initial"), found.alias("fault")),
        "told",
    )
    summary = told.groupBy("key", "piece").applyInPandas(
        _summary, f"key string, piece long, {_COUNTED}, first_initial string, last_initial string,"
        " first_turn long, last_turn long, before array<long>, added array<long>, leaves array<long>",
    )
    # A row for each piece: a conversation's are few enough for one task.
    chained = summary.groupBy("key").applyInPandas(_chain, f"key string, piece long, {_COUNTED}, behind long, state long, last boolean")
    traced = (
        told.join(chained.select("key", "piece", "behind", "state", "last"), ["key", "piece"])
        .groupBy("key", "piece")
        .applyInPandas(_trace, "n long, letters string, put array<string>, role_after string, closing array<string>")
    )
    rows_after = numbered.join(traced, "n").selectExpr(
        "key", "conv", "piece",
        "struct(n, letters, concat("
        "  transform(put, r -> struct(r as role, '' as text)),"
        "  if(role_after is null, array(), array(struct(if(role_after = '', role, role_after) as role, text as text))),"
        "  transform(closing, r -> struct(r as role, '' as text))) as made) as part",
    )
    pieces = rows_after.groupBy("key", "piece").agg(
        F.first("conv").alias("conv"), F.sort_array(F.collect_list("part")).alias("parts")
    )
    whole = pieces.join(chained.drop("behind", "state", "last"), ["key", "piece"]).selectExpr(
        "conv", "piece", *_COUNTS, "array_join(transform(parts, p -> p.letters), '') as audit",
        f"cast(flatten(transform(parts, p -> p.made)) as {_REPAIRED}) as repaired",
    )
    return whole.unionByName(empty).select("conv", "piece", *_COUNTS, "audit", "repaired")


def _kinds(rows: pd.DataFrame) -> list[int]:
    return [
        lattice.kind_of(initial, fault in ("blank", "duplicate"), fault == "truncated")
        for initial, fault in zip(rows["initial"], rows["fault"], strict=True)
    ]


def _summary(rows: pd.DataFrame) -> pd.DataFrame:
    """What a piece does to prices and states, and what its ends have to tell its neighbours."""
    rows = rows.sort_values("n")
    before, added, leaves = lattice.piece(_kinds(rows))
    turns = [None if pd.isna(t) else int(t) for t in rows["turn"]]
    known = [t for t in turns if t is not None]
    faults = rows["fault"].value_counts()
    initials = [i or "?" for i in rows["initial"]]
    return pd.DataFrame([{
        "key": rows["key"].iloc[0], "piece": int(rows["piece"].iloc[0]), "gaps": len(set(known)),
        **{f: int(faults.get(f, 0)) for f in ("blank", "duplicate", "truncated")},
        "illegal": _jumps("".join(initials)), "cost": 0, "first_initial": initials[0], "last_initial": initials[-1],
        "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
        "before": before.tolist(), "added": added.tolist(), "leaves": leaves.ravel().tolist(),
    }]).astype({"first_turn": "Int64", "last_turn": "Int64"})


def _chain(pieces: pd.DataFrame) -> pd.DataFrame:
    """The vector behind and the state before each piece, and the counts of its conversation:
    what spans pieces is counted with the first."""
    pieces = pieces.sort_values("piece").reset_index(drop=True)
    count = len(pieces)
    behind = [0] * count  # the vector of the end
    for at in range(count - 1, 0, -1):
        behind[at - 1] = pieces["before"][at][behind[at]]
    end = lattice.layer(lattice.END, lattice.AFTER_END)
    first = pieces["before"][0][behind[0]]
    cost = end.base + lattice.tables().vectors[first][lattice.NONE]
    cost += sum(int(pieces["added"][at][behind[at]]) for at in range(count))
    states, state = [], lattice.NONE
    width = len(lattice.STATES)
    for at in range(count):
        states.append(state)
        state = int(pieces["leaves"][at][behind[at] * width + state])
    made = pieces[["key", "piece", *_COUNTS]].copy()
    made["behind"], made["state"], made["last"] = behind, states, [at == count - 1 for at in range(count)]
    # Turns are in order, so a turn in two pieces is the last known of one and the next's first.
    spans = [(f, t) for f, t in zip(pieces["first_turn"], pieces["last_turn"], strict=True) if not pd.isna(f)]
    distinct = int(pieces["gaps"].sum()) - sum(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    made["gaps"], made["cost"] = 0, 0
    made.loc[0, "gaps"] = int(spans[-1][1] - spans[0][0] + 1 - distinct) if spans else 0
    made.loc[0, "cost"] = cost
    ends = zip(pieces["last_initial"], pieces["first_initial"][1:], strict=False)
    made.loc[0, "illegal"] += sum(_jumps(a + b) for a, b in ends)
    return made


def _trace(rows: pd.DataFrame) -> pd.DataFrame:
    """A piece's edits, row by row: the letters, roles put in before, the role after (empty:
    as it was; null: deleted), and roles put in at the end of the conversation."""
    rows = rows.sort_values("n")
    _, _, layers = lattice.solve(_kinds(rows), lattice.tables().vectors[int(rows["behind"].iloc[0])])
    state, made = int(rows["state"].iloc[0]), []
    for n, step in zip(rows["n"], layers, strict=True):
        put = [lattice.WRITTEN[s] for s in step.inserts[state]]
        letter, state = step.letter[state], step.to[state]
        after = {lattice.KEEP: "", lattice.REROLE: lattice.WRITTEN.get(state)}.get(letter)
        made.append([n, lattice.INSERT * len(put) + letter, put, after, []])
    if rows["last"].iloc[0]:
        closing = lattice.layer(lattice.END, lattice.AFTER_END).inserts[state]
        made[-1][1] += lattice.INSERT * len(closing)
        made[-1][4] = [lattice.WRITTEN[s] for s in closing]
    return pd.DataFrame(made, columns=["n", "letters", "put", "role_after", "closing"])


# ---- digests ------------------------------------------------------------------------------


def _hash_sorted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations, in order, to a row each; the text goes by and is not kept."""
    at, digest, audit, counts, started = None, None, [], [0] * len(_COUNTS), False

    def done() -> pa.RecordBatch:
        made = {"key": [at], **{c: [n] for c, n in zip(_COUNTS, counts, strict=True)}}
        made |= {"audit": ["".join(audit)], "repaired_sha256": [digest.hexdigest()]}
        return pa.RecordBatch.from_pydict(made)

    for batch in parts:
        for row in batch.to_pylist():
            if row["key"] != at:
                if at is not None:
                    yield done()
                at, digest, audit, counts, started = row["key"], hashlib.sha256(), [], [0] * len(_COUNTS), False
            if row["lines"] is not None:
                digest.update((("\n" if started else "") + row["lines"]).encode())
                started = True
            audit.append(row["audit"])
            counts = [n + row[c] for n, c in zip(counts, _COUNTS, strict=True)]
    if at is not None:
        yield done()


def digests(repaired: DataFrame) -> DataFrame:
    """A row for each conversation: counts, audit, and the hash of its ``role:text`` lines.
    The pieces of a long one pass through one task, in order, as its hash demands."""
    stored = write_through(
        repaired.selectExpr(
            "conv", "piece", *_COUNTS, "audit",
            "if(size(repaired) = 0, null, array_join(transform(repaired, r -> concat(r.role, ':', r.text)), '\\n')) as lines",
        ),
        "repaired",
    )
    whole = F.sha2(F.coalesce(F.col("lines"), F.lit("")).cast("binary"), 256).alias("repaired_sha256")
    many = write_through(
        stored.groupBy("conv").agg(F.count(F.lit(1)).alias("pieces")).where("pieces > 1").select(F.col("conv").alias("long")),
        "in_pieces",
    )
    same = F.col("conv").eqNullSafe(F.col("long"))
    columns = ["conv", *_COUNTS, "audit", "repaired_sha256"]
    several = many.count()
    if not several:
        return stored.select("conv", *_COUNTS, "audit", whole)
    named = F.broadcast(many) if several <= _FEW else many
    key = F.concat(F.when(F.col("conv").isNull(), "-").otherwise("+"), F.coalesce(F.col("conv").cast("string"), F.lit("")))
    keyed = stored.join(named, same, "left_semi").withColumn("key", key)
    hashed = (
        keyed.drop("conv").repartition("key").sortWithinPartitions("key", "piece")
        .mapInArrow(_hash_sorted, f"key string, {_COUNTED}, audit string, repaired_sha256 string")
    )
    kind = stored.schema["conv"].dataType.simpleString()
    named_again = hashed.withColumn("conv", F.expr(f"if(left(key, 1) = '-', null, cast(substr(key, 2) as {kind}))"))
    alone = stored.join(named, same, "left_anti").select("conv", *_COUNTS, "audit", whole)
    return alone.unionByName(named_again.select(*columns))


def op11_conversation_repair(spark: SparkSession, root: str) -> DataFrame:
    table = read(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    return digests(repair(damaged(table))).withColumnRenamed("conv", "conv_id")
