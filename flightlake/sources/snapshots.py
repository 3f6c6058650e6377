"""Observation records as JSON: encode for landing/publishing, decode with an explicit schema.

The producer side (one JSON object per aircraft per poll, stamped with the poll time) becomes
``encode_records`` + a file or Kafka sink; the consumer side becomes ``decode_records`` /
``read_snapshots`` (batch or streaming file source) or ``read_kafka`` (streaming, connector jar
required on the cluster).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions.scalar import iso_text, nan_to_null, text_to_timestamp_ntz
from flightlake.schemas import API_RENAMES, OBSERVATION

TEXT_TIME_FIELDS = ["time_position", "last_contact"]
CORRUPT = "_corrupt_record"
TOPIC = "aircraft_states_raw"


def from_api_frame(api: DataFrame, snapshot_ts=None) -> DataFrame:
    """Raw API rows -> observation columns (7 fields renamed), NaN -> null, poll stamp added.

    ``snapshot_ts``: epoch seconds of the poll; default is the current time of the query.
    """
    dtypes = dict(api.dtypes)
    cols = []
    for src, dst in API_RENAMES.items():
        if src not in dtypes:
            cols.append(F.lit(None).cast(OBSERVATION[dst].dataType).alias(dst))
        elif dtypes[src] in ("double", "float"):
            cols.append(nan_to_null(src).alias(dst))
        else:
            cols.append(F.col(src).alias(dst))
    stamp = F.unix_timestamp() if snapshot_ts is None else F.lit(int(snapshot_ts))
    return api.select(*cols, stamp.cast("long").alias("snapshot_ts"))


def encode_records(obs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON text value per observation: timestamps as ISO text, NaN as null, no key. ``keep`` names further
    columns to carry beside it."""
    fields = []
    dtypes = dict(obs.dtypes)
    for f in OBSERVATION.fields:
        if f.name not in dtypes:
            continue
        c = F.col(f.name)
        if dtypes[f.name].startswith("timestamp"):
            c = iso_text(c)
        elif dtypes[f.name] in ("double", "float"):
            c = nan_to_null(c)
        fields.append(c.alias(f.name))
    return obs.select(F.to_json(F.struct(*fields)).alias("value"), *keep)


def normalise(records: DataFrame) -> DataFrame:
    """Typed observations from decoded records: ISO text -> TIMESTAMP_NTZ (bad text -> null)."""
    out = records
    for c in TEXT_TIME_FIELDS:
        out = out.withColumn(c, text_to_timestamp_ntz(c))
    for f in OBSERVATION.fields:
        if f.dataType.typeName() == "double":
            out = out.withColumn(f.name, nan_to_null(f.name))
    return out


def decode_records(values: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text -> observation columns, plus ``_corrupt_record``: the text of a record that is no JSON
    object of this shape (its other fields null). ``keep`` names further columns to carry, such as the
    broker's time of a message."""
    schema = T.StructType(list(OBSERVATION.fields) + [T.StructField(CORRUPT, T.StringType())])
    text = F.col(value_col).cast("string")
    read = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # As the one element of a list a record is read once; a later filter would else read it again for each of its terms.
    parsed = values.select(*keep, text.alias("__text"), F.explode(F.array(read)).alias("r"))
    # text that is no object at all parses to null
    bad = F.when(F.col("r").isNull(), F.col("__text")).otherwise(F.col(f"r.{CORRUPT}"))
    return normalise(parsed.select(*keep, *[F.col(f"r.{f.name}") for f in OBSERVATION.fields], bad.alias(CORRUPT)))


def accepted(records: DataFrame) -> DataFrame:
    """Records that can be windowed: well-formed and stamped. Without this a bad line's stand-in time
    would move the watermark past good records."""
    return records.filter(F.col(CORRUPT).isNull() & F.col("snapshot_ts").isNotNull()).drop(CORRUPT)


def rejected(records: DataFrame) -> DataFrame:
    """The others, with the reason: for a rejects output."""
    return records.filter(F.col(CORRUPT).isNotNull() | F.col("snapshot_ts").isNull()).withColumn(
        "reason", F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).otherwise(F.lit("no stamp")))


def file_stamp() -> Column:
    """Epoch seconds of a poll from its file's name, ``..._<epoch>.json``; null if the name has none."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{9,11})\.[^/]*$", 1).try_cast("long")


def read_snapshots(spark: SparkSession, path: str, stream: bool = False, max_files_per_trigger: int | None = None,
                   recursive: bool = False) -> DataFrame:
    """Landed JSON-lines snapshots (batch or streaming file source) with the explicit schema.

    A record without ``snapshot_ts`` takes the poll time that its file is named for, if it is
    (``..._<epoch>.json``). Malformed lines do not fail the job: their text is kept in
    ``_corrupt_record``, all other fields null, the stamp included. :func:`accepted` and
    :func:`rejected` part the two kinds. ``recursive``: files in folders below ``path`` are read too.
    """
    reader = spark.readStream if stream else spark.read
    schema = T.StructType(list(OBSERVATION.fields) + [T.StructField(CORRUPT, T.StringType())])
    reader = reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    df = reader.option("recursiveFileLookup", recursive).json(path)
    stamp = F.when(F.col(CORRUPT).isNull(), F.coalesce(F.col("snapshot_ts"), file_stamp()))
    return normalise(df.withColumn("snapshot_ts", stamp))


def write_snapshots(obs: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Land observations as JSON lines (the file form of the record sink): times as ISO text."""
    enc = obs
    for c in TEXT_TIME_FIELDS:
        if c in enc.columns:
            enc = enc.withColumn(c, iso_text(c))
    w = enc.write.mode("append")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.json(path)


def decode_messages(messages: DataFrame) -> DataFrame:
    """Broker messages (``value``, ``timestamp``) -> observation columns, ``_corrupt_record`` and
    ``broker_time``."""
    return decode_records(messages.select("value", F.col("timestamp").alias("broker_time")), keep=("broker_time",))


def read_kafka(spark: SparkSession, bootstrap_servers: str, topic: str = TOPIC,
               starting_offsets: str = "earliest") -> DataFrame:
    """Streaming Kafka source of observation records (needs the spark-sql-kafka connector)."""
    return decode_messages(spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
                           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())


def kafka_sink(encoded: DataFrame, bootstrap_servers: str, checkpoint: str, topic: str = TOPIC):
    """Streaming Kafka sink of encoded records (value only, no key)."""
    return (encoded.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())
