"""Catalog inspection: table list, per-table profile (rows, columns), preview."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def frame_profile(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per frame: name, row count, column count, column names, and names with types."""
    parts = []
    for name, df in frames.items():
        cols = ",".join(df.columns)
        types = ",".join(f"{c}:{t}" for c, t in df.dtypes)
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            F.lit(cols).alias("columns"), F.lit(types).alias("column_types")))
    return reduce(DataFrame.unionByName, parts)


def table_profile(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """:func:`frame_profile` of catalog tables (all of them if none is named)."""
    return frame_profile({name: spark.table(name) for name in names or list_tables(spark)})


def preview(spark: SparkSession, name: str, limit: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first rows of a catalog table: by these columns, or any rows where none is named."""
    table = spark.table(name)
    return (table.orderBy(*order_by) if order_by else table).limit(limit)


def table_list(spark: SparkSession, names: list[str] | None = None, limit: int = 10) -> DataFrame:
    """One row per catalog table (all, or those of ``names`` that exist): name, columns, and the rows that its
    preview shows."""
    listed = [n for n in list_tables(spark) if names is None or n in names]
    parts = [preview(spark, n, limit).agg(F.count(F.lit(1)).alias("preview_rows")).select(
        F.lit(n).alias("table_name"), F.lit(len(spark.table(n).columns)).alias("column_count"), "preview_rows") for n in listed]
    empty = spark.createDataFrame([], "table_name string, column_count int, preview_rows long")
    return reduce(DataFrame.unionByName, parts, empty)
