"""Window files (Parquet): scan, newest-file selection, single-file load; CSV dimensions."""

from __future__ import annotations

import datetime as dt
import fnmatch
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions.scalar import epoch_to_timestamp_ntz
from flightlake.schemas import AIRCRAFT_TYPE, AIRFRAME

WINDOW_FILE_GLOB = "window_raw_*.parquet"


def _path(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path): works on object stores too."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def _list(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of ``path``."""
    fs, p = _path(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def write_window(rows: DataFrame, root: str, window_end: int) -> str:
    """Write one window's rows under ``date=YYYY/MM/DD/window_raw_YYYYMMDDTHHMMSS.parquet`` (named for its
    end; a folder of part files, so that a large window is written by many tasks). Replaces the window."""
    end = dt.datetime.fromtimestamp(int(window_end), dt.timezone.utc)
    path = f"{root.rstrip('/')}/date={end:%Y/%m/%d}/window_raw_{end:%Y%m%dT%H%M%S}.parquet"
    rows.write.mode("overwrite").parquet(path)
    return path


def write_windows(rows: DataFrame, root: str) -> int:
    """Write rows of any number of windows (column ``window_end``, epoch seconds) as window files, in one job.

    One partitioned write lands all windows in a staging folder beside the layout; then each window's folder is
    moved to its place, which moves no data, and replaces the window that stood there. Rows are dealt by window,
    and Spark splits a window that is much larger than others and joins small ones (a rebalance), so a window has
    few files and no task a whole large window. Rows without a window end have no file: they are an error.
    Returns the number of windows written.
    """
    spark, root = rows.sparkSession, root.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    stamp = F.when(F.col("window_end").isNull(), F.raise_error(F.lit("a row without window_end"))).otherwise(epoch_to_timestamp_ntz("window_end"))
    keyed = rows.withColumn("__day", F.date_format(stamp, "yyyy-MM-dd")).withColumn("__file", F.date_format(stamp, "yyyyMMdd'T'HHmmss"))
    keyed.hint("rebalance", "__file").write.partitionBy("__day", "__file").parquet(staging)

    fs, base = _path(spark, staging)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def place(day: str, name: str) -> None:
        to = path(f"{root}/date={day.replace('-', '/')}/window_raw_{name}.parquet")
        fs.mkdirs(to.getParent())
        if fs.exists(to):
            fs.delete(to, True)
        if not fs.rename(path(f"{staging}/__day={day}/__file={name}"), to):
            raise OSError(f"could not move window {name} to {to}")

    found = [(d.split("=", 1)[1], f.split("=", 1)[1]) for d in _list(spark, staging) if d.startswith("__day=")
             for f in _list(spark, f"{staging}/{d}") if f.startswith("__file=")]
    for day, name in sorted(found):
        place(day, name)
    fs.delete(base, True)
    return len(found)


def scan_window_files(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All window files under ``root`` (``date=YYYY/MM/DD/window_raw_*.parquet`` layout; single files and
    folders of part files alike).

    Spark's partition discovery turns ``date=YYYY`` into an integer ``date`` column (the year).
    """
    r = spark.read.option("basePath", root)
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{root.rstrip('/')}/date=*/*/*/{WINDOW_FILE_GLOB}")


def latest_window_path(spark: SparkSession, root: str) -> str | None:
    """Greatest window-file path under ``root`` without touching every file.

    The layout has fixed-width components (``date=YYYY/MM/DD/window_raw_YYYYMMDDTHHMMSS.parquet``),
    so the lexicographically greatest full path is found by descending into the greatest directory
    at each level (backing off to the next one when a branch holds no window file): a few listings
    of the newest day instead of reading the metadata of the whole history.
    """
    pattern = ("date=*", "*", "*", WINDOW_FILE_GLOB)

    def walk(path: str, depth: int) -> str | None:
        for name in sorted((n for n in _list(spark, path) if fnmatch.fnmatch(n, pattern[depth])), reverse=True):
            here = f"{path}/{name}"
            found = here if depth == len(pattern) - 1 else walk(here, depth + 1)
            if found:
                return found
        return None

    return walk(root.rstrip("/"), 0)


def load_window_file(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Load one window file, keeping the ``date`` partition column (basePath set to the root)."""
    return spark.read.option("basePath", root).parquet(path)


def observations_from_window_files(df: DataFrame) -> DataFrame:
    """Window-file rows (as written by a pandas writer: ISO text times, naive window bounds) in the
    shape of the ``states`` view: typed times, NaN -> null, window bounds as epoch seconds, a stable
    ``obs_id`` when the files carry none."""
    from flightlake.functions.scalar import epoch_seconds_ntz, nan_to_null, text_to_timestamp_ntz
    from flightlake.schemas import OBSERVATION
    out = df
    dtypes = dict(out.dtypes)
    # conform to the observation schema: absent fields become typed nulls, all-null ("void") or
    # differently typed columns are cast; time fields may arrive as ISO text or as timestamps
    for f in OBSERVATION.fields:
        if f.name == "obs_id":
            continue
        if f.name in ("time_position", "last_contact"):
            if f.name not in dtypes or dtypes[f.name] == "void":
                out = out.withColumn(f.name, F.lit(None).cast("timestamp_ntz"))
            elif dtypes[f.name] == "string":
                out = out.withColumn(f.name, text_to_timestamp_ntz(f.name))
            else:
                out = out.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
        elif f.name not in dtypes:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
        elif dtypes[f.name] != f.dataType.simpleString():
            out = out.withColumn(f.name, F.col(f.name).try_cast(f.dataType))
    dtypes = dict(out.dtypes)
    for c, t in dtypes.items():
        if t in ("double", "float"):
            out = out.withColumn(c, nan_to_null(c))
    for c in ("window_start", "window_end"):
        if c in dtypes and dtypes[c].startswith("timestamp"):
            out = out.withColumn(c, epoch_seconds_ntz(F.col(c).cast("timestamp_ntz")))
    if "obs_id" not in dtypes:
        out = out.withColumn("obs_id", F.xxhash64(*[F.col(c) for c in ("icao24", "snapshot_ts", "time_position",
                                                                          "last_contact", "longitude", "latitude")
                                                     if c in dtypes]))
    return out


def read_csv_columns(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """The columns of ``schema`` from CSV files with a header, found by name: their order and further
    columns do not matter, a missing one is an error. Read as text and cast; quoted fields may hold
    separators and doubled quotes. An empty field is null. ``multiline``: quoted fields may hold line ends too;
    then a file cannot be split and is read by one task."""
    raw = (spark.read.option("header", True).option("inferSchema", False).option("quote", '"').option("escape", '"')
           .option("multiLine", multiline).option("ignoreLeadingWhiteSpace", False).csv(path))
    found = {c.strip().lstrip("\ufeff").lower(): c for c in raw.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in found]
    if missing:
        raise ValueError(f"{path}: no column {missing}; the header has {raw.columns}")
    return raw.select(*[F.col(f"`{found[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_airframes_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_csv_columns(spark, path, AIRFRAME, multiline)


def read_models_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_csv_columns(spark, path, AIRCRAFT_TYPE, multiline)


def write_table(df: DataFrame, path: str, partition_cols=None, spread: bool = False) -> None:
    """Replace-table sink: overwrite a Parquet table (optionally partitioned).

    ``spread``: let Spark even out the written files by size (a rebalance at run time).
    """
    if spread:
        df = df.hint("rebalance")
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
