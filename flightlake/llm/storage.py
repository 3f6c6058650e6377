"""Cutting lineage through the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scratches: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only a local master may fall back to a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="text-ops-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the written table.

    Later reads start from the files, so a lost executor costs no recomputation and values that depend on task
    order (such as running numbers) stay as written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _scratches[-1:]:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that operators write inside the block are deleted when it ends, also when it fails.

    What an operator returns reads them, so use it up or write it inside the block. Blocks may stand in one another;
    a table belongs to the innermost one that was open when it was written. Gives the list of their paths.
    """
    paths: list[str] = []
    _scratches.append(paths)
    try:
        yield paths
    finally:
        _scratches[:] = [p for p in _scratches if p is not paths]
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
