"""File sources and sinks with declared schemas (no inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripartite.schemas import RAW_SCHEMAS, TRUTH_SCHEMA


# Quotes inside quoted fields are doubled (RFC 4180), and white space is data.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_raw_csv(
    spark: SparkSession, path: str, table: str, line_breaks: bool = False
) -> DataFrame:
    """One raw feed, every column as text. Empty fields read as null.

    ``line_breaks`` allows them inside quoted fields; a file is then read by one task.
    """
    return (
        spark.read.schema(RAW_SCHEMAS[table])
        .options(**_CSV, enforceSchema=False, mode="FAILFAST", multiLine=line_breaks)
        .csv(path)
    )


def read_raw_sources(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All six feeds below ``root``: a file or a folder ``<table>.csv`` each."""
    return {table: read_raw_csv(spark, f"{root}/{table}.csv", table) for table in RAW_SCHEMAS}


def read_truth(
    spark: SparkSession, path: str, array: bool = False, schema: str = TRUTH_SCHEMA
) -> DataFrame:
    """Log of planted breaks. Keys a record lacks become null columns.

    One object per line, which can be split; ``array=True`` reads files that hold one
    JSON array each, in one task a file. A broken record raises an error when it is read.
    """
    return spark.read.schema(schema).options(multiLine=array, mode="FAILFAST").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Expose frames to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
