"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the whole driver tables through the role views (``flightlake.plans.roles``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flightlake.functions import scalar as fx
from flightlake.operators import anomalies as an
from flightlake.operators import density as dn
from flightlake.operators import enrich as en
from flightlake.operators import iforest as isf
from flightlake.operators import profiles as pf
from flightlake.operators import selection as sel
from flightlake.plans import incremental as inc
from flightlake.plans import refresh as rf
from flightlake.plans import roles
from flightlake.schemas import API_RENAMES
from flightlake.session import shared_path
from flightlake.sources import catalog as cat
from flightlake.sources import snapshots as snap
from flightlake.sources import versions as vs
from flightlake.sources import windows as wf
from flightlake.streaming import sealed as sl
from flightlake.streaming import windows as sw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _dims(spark, sf_dir):
    return roles.states(spark, sf_dir), roles.airframes(spark, sf_dir), roles.models(spark, sf_dir)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return en.enrich(*_dims(spark, sf_dir))


@register("enrich")
def q_enrich(spark, sf_dir):
    return enriched(spark, sf_dir)


@register("typed_enrichment")
def q_typed_enrichment(spark, sf_dir):
    """Enrichment from a written dimension that holds every airframe with its types: one join of the events."""
    st, af, md = _dims(spark, sf_dir)
    path = shared_path(spark, "typed-airframes")
    wf.write_table(en.typed_airframes(af, md), path)
    return en.enrich_typed(st, spark.read.parquet(path))


@register("enrich_coverage")
def q_enrich_coverage(spark, sf_dir):
    return en.coverage_parity(*_dims(spark, sf_dir))


@register("enrich_coverage_distinct")
def q_enrich_coverage_distinct(spark, sf_dir):
    return en.coverage_distinct(*_dims(spark, sf_dir))


@register("latest_window")
def q_latest_window(spark, sf_dir):
    return en.latest_window_frame(roles.recent_states(spark, sf_dir), roles.airframes(spark, sf_dir), roles.models(spark, sf_dir))


# ------------------------------------------------------------------ profiles


def prepared(spark, sf_dir):
    return pf.prepare(enriched(spark, sf_dir))


@register("altitude_band_counts")
def q_altitude_band_counts(spark, sf_dir):
    return pf.altitude_band_counts(enriched(spark, sf_dir))


@register("altitude_band_b_counts")
def q_altitude_band_b_counts(spark, sf_dir):
    return pf.altitude_band_b_counts(enriched(spark, sf_dir))


@register("altitude_bands")
def q_altitude_bands(spark, sf_dir):
    return pf.altitude_bands(enriched(spark, sf_dir))


@register("vertical_status")
def q_vertical_status(spark, sf_dir):
    return pf.vertical_status_counts(prepared(spark, sf_dir))


@register("speed_histogram")
def q_speed_histogram(spark, sf_dir):
    return pf.speed_histogram(enriched(spark, sf_dir))


@register("envelope_top4")
def q_envelope_top4(spark, sf_dir):
    return pf.envelope_top(prepared(spark, sf_dir), 4)


@register("category_codes")
def q_category_codes(spark, sf_dir):
    return pf.category_codes(enriched(spark, sf_dir))


@register("category_profile")
def q_category_profile(spark, sf_dir):
    return pf.category_profile(enriched(spark, sf_dir))


@register("category_radar")
def q_category_radar(spark, sf_dir):
    return pf.category_radar(enriched(spark, sf_dir), 4)


@register("position_sample")
def q_position_sample(spark, sf_dir):
    return pf.position_sample(enriched(spark, sf_dir), 0.3, 42)


@register("prepared_frame")
def q_prepared_frame(spark, sf_dir):
    return prepared(spark, sf_dir).select(
        "obs_id", "icao24", "latitude", "longitude", "geo_altitude", "velocity", "vertical_rate",
        "Description", "WTC", "snapshot_time", "altitude_km", "alt_band")


# ------------------------------------------------------------------ anomalies, windows, ingest, catalog


@register("flagged_anomalies")
def q_flagged_anomalies(spark, sf_dir):
    return an.flagged_only(an.flag_anomalies(roles.states(spark, sf_dir)))


@register("peer_anomalies")
def q_peer_anomalies(spark, sf_dir):
    return an.peer_anomalies(enriched(spark, sf_dir))


@register("window_summary")
def q_window_summary(spark, sf_dir):
    st = roles.states(spark, sf_dir)
    return st.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.countDistinct(F.when(fx.is_present_key("icao24"), F.col("icao24"))).alias("unique_aircraft"))


@register("window_raw")
def q_window_raw(spark, sf_dir):
    st = roles.states(spark, sf_dir)
    return st.withColumn("window_file", fx.window_key(fx.epoch_to_timestamp_ntz("window_end")))


@register("recent_only")
def q_recent_only(spark, sf_dir):
    st = roles.recent_states(spark, sf_dir, 9 * 60)
    age = fx.age_minutes("snapshot_ts", st.agg(F.max("snapshot_ts")).scalar())
    return st.filter(age < F.lit(9.0)).select("obs_id", "icao24", "snapshot_ts",
                                              F.round(age, 6).alias("age_minutes"))


@register("normalised_states")
def q_normalised_states(spark, sf_dir):
    st = roles.states(spark, sf_dir)
    dec = snap.decode_records(snap.encode_records(st))
    return snap.accepted(dec).drop("sensors")


@register("table_profile")
def q_table_profile(spark, sf_dir):
    st, af, md = _dims(spark, sf_dir)
    return cat.frame_profile({"states": st, "airframes": af, "models": md, "enriched_aircraft_states": en.enrich(st, af, md)})


def _catalog(spark, sf_dir) -> list[str]:
    """The role tables under their names in the session's catalog."""
    tables = dict(zip(("states", "airframes", "models"), _dims(spark, sf_dir)))
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return list(tables)


@register("table_list")
def q_table_list(spark, sf_dir):
    return cat.table_list(spark, _catalog(spark, sf_dir))


@register("table_preview")
def q_table_preview(spark, sf_dir):
    """The first rows of the observations, a limit that is the feature."""
    _catalog(spark, sf_dir)
    return cat.preview(spark, "states", 10, ["obs_id"]).select("obs_id", "icao24", "origin_country", "velocity", "snapshot_ts")


@register("vertical_status_titled")
def q_vertical_status_titled(spark, sf_dir):
    """Vertical movement with the chart's time label, the earliest poll."""
    frame = prepared(spark, sf_dir)
    return pf.vertical_status_counts(frame).withColumn("time_label", F.lit(pf.snapshot_time_label(frame)))


@register("window_bounds")
def q_window_bounds(spark, sf_dir):
    """Window bounds as the stream engine sends them, in epoch milliseconds, read as times."""
    sent = roles.states(spark, sf_dir).select((F.col("window_start") * 1000).alias("start_ms"), (F.col("window_end") * 1000).alias("end_ms"))
    return sent.groupBy("start_ms", "end_ms").agg(F.count(F.lit(1)).alias("n")).select(
        "start_ms", fx.epoch_millis_to_timestamp_ntz("start_ms").alias("window_start"),
        fx.epoch_millis_to_timestamp_ntz("end_ms").alias("window_end"), "n")


@register("prepared_sample")
def q_prepared_sample(spark, sf_dir):
    """Frame preparation with its row limit: a seeded sample of fixed size."""
    return pf.prepare(roles.states(spark, sf_dir), max_rows=5000).select("obs_id", "geo_altitude", "velocity", "alt_band")


@register("csv_enrich")
def q_csv_enrich(spark, sf_dir):
    """Both dimensions landed as CSV with other column orders and a further column, read by header name."""
    st, af, md = _dims(spark, sf_dir)
    root = shared_path(spark, "csv")
    af.select("operatoricao", "typecode", F.lit('a "quoted", field').alias("note"), "operator", "icao24", "model",
              "icaoaircrafttype", "registration").write.option("header", True).option("escape", '"').csv(f"{root}/airframes")
    md.select("WTC", "Description", F.lit("x").alias("more"), "Designator", "AircraftDescription",
              "ModelFullName").write.option("header", True).csv(f"{root}/models")
    return en.enrich(st, wf.read_airframes_csv(spark, f"{root}/airframes"), wf.read_models_csv(spark, f"{root}/models"))


@register("api_snapshots")
def q_api_snapshots(spark, sf_dir):
    """Rows under the polling API's field names: renamed, stamped, published as messages and decoded, with the
    broker's time kept. Some messages are cut short; they are kept as text."""
    st = roles.states(spark, sf_dir)
    names = {v: k for k, v in API_RENAMES.items()}
    api = st.select(*[F.col(c).alias(names[c]) for c in st.columns if c in names], "obs_id")
    polled = snap.from_api_frame(api, snapshot_ts=1_700_000_000).withColumn("spi", F.coalesce("spi", F.lit(False)))
    text = snap.encode_records(polled.select(*[c for c in polled.columns if c != "sensors"]))
    cut = F.get_json_object("value", "$.squawk") == "0007"
    sent = text.select(F.when(cut, F.expr("left(value, 20)")).otherwise(F.col("value")).alias("value"),
                       F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"))
    got = snap.decode_messages(sent)
    return got.groupBy("origin_country", F.col(snap.CORRUPT).isNotNull().alias("malformed")).agg(
        F.count(F.lit(1)).alias("n"), F.count("velocity").alias("n_velocity"), F.round(F.sum("baro_altitude"), 3).alias("sum_altitude"),
        F.max("snapshot_ts").alias("stamp"), F.max(F.unix_seconds("broker_time")).alias("broker_seconds"))


FILE_WINDOW_SECONDS = 3600  # a window file for each hour of the events: a window of 3 minutes holds hardly a row


@register("window_files")
def q_window_files(spark, sf_dir):
    """Every window written as window files with one write; the newest file found by name and loaded, and all
    files scanned for their rows."""
    root = shared_path(spark, "window-files")
    st = roles.states_from_events(roles.read_table(spark, sf_dir, "events"), FILE_WINDOW_SECONDS)
    written = wf.write_windows(st.drop("date"), root)
    newest = wf.observations_from_window_files(wf.load_window_file(spark, root, wf.latest_window_path(spark, root)))
    return newest.select("obs_id", "icao24", "velocity", "time_position", "window_start", "window_end", "date",
                         F.lit(written).cast("long").alias("window_files"),
                         F.lit(wf.scan_window_files(spark, root).count()).cast("long").alias("rows_in_all_files"))


# ------------------------------------------------------------------ quantiles and density


@register("wtc_speed_quartiles")
def q_wtc_speed_quartiles(spark, sf_dir):
    sup = pf.wtc_supported(prepared(spark, sf_dir))
    q = sel.selected_quantiles(sup, "velocity", [0.25, 0.5, 0.75], group_cols=["WTC"])
    qs = [F.round(F.col("qs")[i], 6).alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    return q.select("WTC", fx.label_ordinal("WTC", fx.WTC_ORDER).alias("wtc_order"), "n", *qs)


@register("country_quantiles")
def q_country_quantiles(spark, sf_dir):
    """Quantiles of speed and of barometric altitude for each country of origin, from a sketch and counts
    (with brackets so small that they are narrowed on small tables too)."""
    st, probs = roles.states(spark, sf_dir), {"q01": 0.01, "q50": 0.5, "q99": 0.99}
    parts = []
    for metric in ("velocity", "baro_altitude"):
        q = sel.selected_quantiles(st, metric, list(probs.values()), ["origin_country"], gather=1000)
        parts.append(q.select("origin_country", F.lit(metric).alias("metric"), "n",
                              *[F.round(F.col("qs")[i], 6).alias(name) for i, name in enumerate(probs)]))
    return reduce(DataFrame.unionByName, parts)


@register("wtc_speed_density")
def q_wtc_speed_density(spark, sf_dir):
    return dn.kde_1d_by_group(pf.wtc_supported(prepared(spark, sf_dir)), "WTC", "velocity")


@register("density_grid")
def q_density_grid(spark, sf_dir):
    return dn.kde_2d_grid(pf.position_sample(enriched(spark, sf_dir), 0.3, 42), "longitude", "latitude")


# ------------------------------------------------------------------ isolation forest


def labelled_observations(spark, sf_dir):
    return isf.fit_predict(roles.states(spark, sf_dir), keep=("callsign",))


@register("iforest_scores")
def q_iforest_scores(spark, sf_dir):
    lab = labelled_observations(spark, sf_dir)
    return lab.select("obs_id", F.round("score", 6).alias("score"), "anomaly")


@register("iforest_anomalies")
def q_iforest_anomalies(spark, sf_dir):
    return isf.anomaly_report(labelled_observations(spark, sf_dir))


@register("anomaly_map")
def q_anomaly_map(spark, sf_dir):
    return isf.anomaly_map(labelled_observations(spark, sf_dir))


# ------------------------------------------------------------------ streaming windows


def run_window_job(spark, sf_dir):
    """Land the observations as JSON-lines snapshot files (one folder per day), stream them through
    the window job with ``availableNow`` and return the folder that holds its output."""
    root = shared_path(spark, "window-stream")
    st = roles.states(spark, sf_dir).withColumn(
        "day", F.date_format(fx.epoch_to_timestamp_ntz("snapshot_ts"), "yyyy-MM-dd"))
    snap.write_snapshots(st.select(*sw.RAW_COLUMNS, "day"), f"{root}/landed", partition_col="day")
    source = snap.read_snapshots(spark, f"{root}/landed", stream=True)
    q = sw.start_window_job(spark, source, f"{root}/out", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()
    return root


def run_window_stream(spark, sf_dir):
    """The (raw, summary) tables that the window job writes."""
    return sw.read_window_outputs(spark, f"{run_window_job(spark, sf_dir)}/out")


@register("stream_window_summary")
def q_stream_window_summary(spark, sf_dir):
    _, summary = run_window_stream(spark, sf_dir)
    return summary.select("window_start", "window_end", "n_obs", "unique_aircraft")


@register("stream_windows")
def q_stream_windows(spark, sf_dir):
    raw, _ = run_window_stream(spark, sf_dir)
    return raw.select("obs_id", "icao24", "snapshot_ts", "velocity", "window_start", "window_end")


STREAM_BATCHES = 6


def staged_parts(spark, rows: DataFrame, root: str, parts: int) -> None:
    """Encoded records staged in one write, a folder of files from every task for each part (column ``part``);
    each part holds a malformed line too."""
    text = snap.encode_records(rows, keep=("part",))
    bad = spark.range(parts).select(F.lit('{"icao24": cut').alias("value"), F.col("id").cast("int").alias("part"))
    text.unionByName(bad).write.partitionBy("part").text(f"{root}/staged")


def arrive(spark, root: str, part: int) -> str:
    """The part's files are moved to where the stream looks for new ones."""
    fs, landed = wf._path(spark, f"{root}/landed")
    fs.mkdirs(landed)
    fs.rename(wf._path(spark, f"{root}/staged/part={part}")[1], wf._path(spark, f"{root}/landed/part-{part:04d}")[1])
    return f"{root}/landed"


def timed_parts(st: DataFrame, parts: int):
    """Observations with the part of the time range in which they are landed, every 50th one part too late;
    the first and last stamp."""
    lo, hi = st.agg(F.min("snapshot_ts"), F.max("snapshot_ts")).first()
    part = F.floor((F.col("snapshot_ts") - F.lit(lo)) * F.lit(parts) / F.lit(hi - lo + 1))
    late = F.when(F.col("obs_id") % 50 == 0, 1).otherwise(0)
    return st.withColumn("part", F.least(part + late, F.lit(parts)).cast("int")).select("part", *sw.RAW_COLUMNS), lo, hi


def run_parts(spark, sf_dir, name, start, parts=STREAM_BATCHES):
    """Part after part arrives, and ``start(source, root, lo, hi)`` starts a job that takes what is new and ends; one
    that fails is started again. Each run goes on from the checkpoint of the one before. Returns the folder."""
    root = shared_path(spark, name)
    rows, lo, hi = timed_parts(roles.states(spark, sf_dir), parts)
    staged_parts(spark, rows, root, parts + 1)
    for part in range(parts + 1):
        landed = arrive(spark, root, part)
        for attempt in range(3):
            job = start(snap.read_snapshots(spark, landed, stream=True, recursive=True), root, lo, hi)
            try:
                job.awaitTermination()
                break
            except StreamingQueryException:
                if attempt == 2:
                    raise
    return root


def run_batched_stream(spark, sf_dir):
    """The window job over parts that arrive one after another, late rows and malformed lines among them. The
    recency filter drops the oldest fifth of the range. Returns the written (raw, summary) tables and the rejects."""
    start = lambda source, root, lo, hi: sw.start_window_job(
        spark, source, f"{root}/out", f"{root}/checkpoint", max_age_minutes=(hi - lo) * 0.8 / 60.0, now=hi)
    root = run_parts(spark, sf_dir, "batched-stream", start)
    landed = snap.read_snapshots(spark, f"{root}/landed", stream=True, recursive=True)
    sw.start_rejects_job(landed, f"{root}/rejects", f"{root}/checkpoint-rejects").awaitTermination()
    return *sw.read_window_outputs(spark, f"{root}/out"), spark.read.parquet(f"{root}/rejects")


@register("stream_batches")
def q_stream_batches(spark, sf_dir):
    raw, summary, rejects = run_batched_stream(spark, sf_dir)
    totals = rejects.agg(F.count(F.lit(1)).alias("n_rejected"))
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("output"), "n")
    obs = summary.agg(F.sum("n_obs").alias("n")).select(F.lit("observations").alias("output"), "n")
    return one(raw, "raw").unionByName(one(summary, "windows")).unionByName(obs).unionByName(
        totals.select(F.lit("rejects").alias("output"), F.col("n_rejected").alias("n")))


@register("stream_sealed_windows")
def q_stream_sealed_windows(spark, sf_dir):
    """Rows of sealed windows: appended as they arrive, late ones kept apart, no rows in any state."""
    start = lambda source, root, lo, hi: sl.start_sealing_job(source, f"{root}/out", f"{root}/checkpoint")
    root = run_parts(spark, sf_dir, "sealed-stream", start)
    return sl.read_sealed(spark, f"{root}/out").select("obs_id", "icao24", "snapshot_ts", "velocity", "window_start", "window_end")


RESUMED_PARTS = 2


def failing(action, epochs, failed):
    """``action``, after which the micro-batch fails, once for each of these epochs: its outputs stand, its commit
    in the stream's checkpoint does not, so the next start replays it."""
    def on_closed(summary, epoch):
        action(summary, epoch)
        if epoch in epochs and epoch not in failed:
            failed.add(epoch)
            raise RuntimeError(f"stopped after the outputs of micro-batch {epoch}")
    return on_closed


@register("stream_resume")
def q_stream_resume(spark, sf_dir):
    """The window job stopped within micro-batches and started again from its checkpoint: each row once."""
    failed: set[int] = set()
    start = lambda source, root, lo, hi: sw.start_window_job(
        spark, source, f"{root}/out", f"{root}/checkpoint", on_closed=failing(sw.log_closed_windows, {1, 2}, failed))
    raw, _ = sw.read_window_outputs(spark, f"{run_parts(spark, sf_dir, 'resumed-stream', start, RESUMED_PARTS)}/out")
    return raw.select("obs_id", "icao24", "snapshot_ts", "window_start", "window_end")


@register("stream_callback")
def q_stream_callback(spark, sf_dir):
    """A callback that enriches each closed window, once, though micro-batches fail after it and are replayed:
    for each window its rows, its enriched rows, and how often it was acted on."""
    _, af, md = _dims(spark, sf_dir)
    failed: set[int] = set()

    def start(source, root, lo, hi):
        def refresh(summary, epoch):
            rows = spark.read.schema(sw.RAW_SCHEMA).parquet(f"{root}/out/raw/batch_id={epoch}").withColumn("date", F.year("time_position"))
            done = en.enrich(rows, af, md).select("obs_id").join(rows.select("obs_id", "window_end"), "obs_id")
            done.groupBy("window_end").agg(F.count(F.lit(1)).alias("n_enriched")).write.mode("append").parquet(f"{root}/acted")
        act = failing(sw.committed(refresh, f"{root}/ledger"), {1, 2}, failed)
        return sw.start_window_job(spark, source, f"{root}/out", f"{root}/checkpoint", on_closed=act)

    root = run_parts(spark, sf_dir, "callback-stream", start, RESUMED_PARTS)
    _, summary = sw.read_window_outputs(spark, f"{root}/out")
    acted = spark.read.parquet(f"{root}/acted").groupBy("window_end").agg(F.sum("n_enriched").alias("n_enriched"), F.count(F.lit(1)).alias("n_acted"))
    return summary.join(acted, "window_end").select("window_end", "n_obs", "unique_aircraft", "n_enriched", "n_acted")


@register("stream_arrival_windows")
def q_stream_arrival_windows(spark, sf_dir):
    """Windows by the time at which the broker took a message, up to four minutes after the poll: observations,
    aircraft, and how many were polled in an earlier window."""
    root, st = shared_path(spark, "arrival-stream"), roles.states(spark, sf_dir)
    came = st.withColumn("came", F.col("snapshot_ts") + (F.col("obs_id") * 37) % 240)
    lo, hi = came.agg(F.min("came"), F.max("came")).first()
    part = F.floor((F.col("came") - F.lit(lo)) * F.lit(RESUMED_PARTS) / F.lit(hi - lo + 1)).cast("int")
    sent = snap.encode_records(came.withColumn("part", part), keep=("part", "came"))
    message = F.to_json(F.struct("value", F.timestamp_seconds("came").alias("timestamp")))
    sent.select(message.alias("value"), "part").write.partitionBy("part").text(f"{root}/staged")
    for p in range(RESUMED_PARTS):
        messages = spark.readStream.schema("value string, timestamp timestamp").option("recursiveFileLookup", True).json(arrive(spark, root, p))
        sw.start_window_job(spark, snap.decode_messages(messages), f"{root}/out", f"{root}/checkpoint", event_time="broker_time").awaitTermination()
    raw, _ = sw.read_window_outputs(spark, f"{root}/out")
    polled = F.col("snapshot_ts") - F.pmod(F.col("snapshot_ts"), F.lit(roles.WINDOW_SECONDS))
    return raw.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("n_obs"), F.countDistinct(F.when(fx.is_present_key("icao24"), F.col("icao24"))).alias("unique_aircraft"),
        F.count_if(polled < F.col("window_start")).alias("n_polled_before"))


@register("stream_metrics")
def q_stream_metrics(spark, sf_dir):
    """What Spark observed in each micro-batch: records, malformed ones, the newest stamp."""
    where = shared_path(spark, "metrics")
    table = sw.MetricsTable(spark, where)
    spark.streams.addListener(table)

    def start(source, root, lo, hi):
        table.ended.clear()
        job = sl.start_sealing_job(sw.observed(source), f"{root}/out", f"{root}/checkpoint")
        job.awaitTermination()
        table.ended.wait(60)  # listeners hear of a query's end, and of its micro-batches before, a little later
        return job

    try:
        run_parts(spark, sf_dir, "observed-stream", start, RESUMED_PARTS)
    finally:
        spark.streams.removeListener(table)
    order = Window.orderBy("batch_id")  # a row for each micro-batch
    return sw.read_metrics(spark, where).select(
        (F.row_number().over(order) - 1).alias("part"), "n_records", "n_malformed", "n_unstamped", "newest")


@register("window_refresh")
def q_window_refresh(spark, sf_dir):
    """Refresh of the newest closed window that the stream has written."""
    root, (_, af, md) = run_window_job(spark, sf_dir), _dims(spark, sf_dir)
    return rf.refresh_from_windows(spark, f"{root}/out", af, md, shared_path(spark, "window-refresh"))


# ------------------------------------------------------------------ refresh job and table sample


@register("full_refresh")
def q_full_refresh(spark, sf_dir):
    st, af, md = _dims(spark, sf_dir)
    return rf.published(spark, shared_path(spark, "refresh"), lambda folder: rf.refresh(spark, st, af, md, folder))


REFRESH_RUNS = 3


def run_incremental(spark, sf_dir, root, runs=REFRESH_RUNS):
    """Closed windows taken in ``runs`` refreshes, each of which sees the history up to then."""
    st, af, md = _dims(spark, sf_dir)
    lo, hi = st.agg(F.min("window_end"), F.max("window_end")).first()
    for i in range(1, runs + 1):
        inc.refresh_new_windows(spark, st.filter(F.col("window_end") <= F.lit(lo + (hi - lo) * i // runs)), af, md, root)
    return root


@register("incremental_refresh")
def q_incremental_refresh(spark, sf_dir):
    """Every output of the incremental refresh after several runs: rows and a sum over its numbers."""
    root = run_incremental(spark, sf_dir, shared_path(spark, "incremental"))
    total = {"enriched_aircraft_states": "obs_id", "flagged_anomalies": "obs_id", "latest_window": "obs_id", "coverage": "n_with_type",
             "altitude_band_counts": "n * (alt_band_order + 1)", "vertical_status": "n_rows * (status_order + 1) + n_aircraft",
             "speed_histogram": "n * (bin + 1)", "category_profile": "aircraft_count", "category_radar": "point"}
    parts = [inc.read_output(spark, root, name).agg(F.count(F.lit(1)).alias("rows"), F.expr(f"CAST(sum({what}) AS BIGINT)").alias("total"))
             .select(F.lit(name).alias("output"), "rows", "total") for name, what in total.items()]
    return reduce(DataFrame.unionByName, parts)


@register("replaced_table")
def q_replaced_table(spark, sf_dir):
    """The window summary published twice, with a write between that fails before its commit: what readers saw
    before, during and after."""
    root, st = shared_path(spark, "replaced"), roles.states(spark, sf_dir)
    early = st.filter(F.col("obs_id") % 2 == 0)
    summary = lambda rows: rows.groupBy("window_end").agg(F.count(F.lit(1)).alias("n_obs"))
    seen = lambda step: vs.read_table(spark, root).agg(F.count(F.lit(1)).alias("windows"), F.sum("n_obs").alias("observations")).select(
        F.lit(step).alias("step"), "windows", "observations")
    vs.replace_table(summary(early), root)
    before = seen("first version")
    lost = vs.begin(spark, root)
    summary(st).limit(1).write.parquet(lost.folder)  # written, never committed
    during = seen("a write that was given up")
    vs.replace_table(summary(st), root)
    return before.unionByName(during).unionByName(seen("second version"))


@register("enriched_sample")
def q_enriched_sample(spark, sf_dir):
    """The analysis sample: first 10,000 enriched rows in a total order (obs_id, type name)."""
    return en.first_enriched(*_dims(spark, sf_dir), 10000)
