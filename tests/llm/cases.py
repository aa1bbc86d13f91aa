"""Awkward documents that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, row string, kept string, score double, words array<string>"


def awkward(spark, *more):
    """Nulls in every column, empty and very long texts, repeated rows, shared ids, and
    columns whose names an operator might use itself."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "Gamma,", "dé.\n"]) + str(rng.randint(0, 9)) for _ in range(20_000))
    rows = [
        (1, "one two three four five six", "en", "a", "r", "k", 0.5, ["x"]),
        (1, "one two three four five six", "en", "a", "r", "k", 0.5, ["x"]),
        (2, "one two three four five six", None, "b", None, None, None, None),
        (3, None, "en", None, "r", "k", 0.5, []),
        (4, "", "de", "a", "r", "k", 0.5, []),
        (5, " \t\n", "de", "a", "r", "k", 0.5, []),
        (6, "?! 12 --", None, "a", "r", "k", 0.5, []),
        (None, "a text without an id", "en", "a", "r", "k", 0.5, []),
        (None, "a text without an id", "en", "a", "r", "k", 0.5, []),
        (7, "One TWO three", "en", "a", "r", "k", 0.5, []),
        (8, long, "fr", "a", "r", "k", 0.5, []),
        (9, "x" * 70_000, "fr", "a", "r", "k", 0.5, []),
        (10, "tab\tand  two spaces \n end ", "fr", "a", "r", "k", 0.5, []),
        (11, "日本語の文 ünïcödé \U0001f600 <|endoftext|>", "ja", "a", "r", "k", 0.5, []),
        *more,
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def written(df, folder):
    """The rows as a table, as queries read them."""
    df.write.mode("overwrite").parquet(str(folder))
    return df.sparkSession.read.parquet(str(folder))
