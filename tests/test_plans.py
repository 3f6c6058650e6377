"""Plan shape of every registered query: no nested-loop or Cartesian joins, no row-at-a-time Python
UDFs, and the driver-table scans read only the columns they use."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF001
from flightlake.plans.registry import QUERIES as REGISTERED

# queries whose construction runs streams or writes whole result sets (checked by other tests)
EAGER = {"stream_window_summary", "stream_windows", "stream_batches", "window_refresh", "full_refresh", "csv_enrich", "window_files",
         "typed_enrichment", "incremental_refresh", "replaced_table",
         "stream_sealed_windows", "stream_resume", "stream_callback", "stream_arrival_windows", "stream_metrics"}
QUERIES = {k: v for k, v in entry.queries().items() if k not in EAGER and k in REGISTERED}
# queries that fit a model or materialise a ranking, or whose result depends on collected scalars
FITTED = {"iforest_scores", "iforest_anomalies", "anomaly_map", "category_codes", "wtc_speed_quartiles", "density_grid",
          "speed_histogram", "table_profile", "country_quantiles", "prepared_sample", "vertical_status_titled", "table_list"}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = plan_text(QUERIES[name](spark, SF001))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        if "event_id" in schema:
            assert "props" not in schema  # the JSON column is never needed


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_job_while_a_frame_is_built(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"building {name}", "")
    try:
        QUERIES[name](spark, SF001)
        # schema inference of a Parquet file is a job of its own kind: one task, no stage reads rows
        assert len(sc.statusTracker().getJobIdsForGroup(f"building {name}")) <= len(FILES)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


FILES = ("events", "customer", "supplier")


@pytest.mark.parametrize("name", ["enrich", "enrich_coverage", "enrich_coverage_distinct", "altitude_bands", "position_sample",
                                  "category_profile", "density_grid"])
def test_one_scan_of_events(spark, name):
    plan = plan_text(QUERIES[name](spark, SF001))
    assert len(re.findall(r"FileScan parquet[^\n]*events", plan)) == 1


def test_enrich_joins_events_once(spark):
    plan = plan_text(QUERIES["enrich"](spark, SF001))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3


def test_coverage_shuffles_keys_only(spark):
    plan = plan_text(QUERIES["enrich_coverage"](spark, SF001))
    scan = plan.index("events")
    assert "partial_count(1)" in plan[:scan]


@pytest.mark.parametrize("name", ["latest_window", "recent_only"])
def test_time_filter_reaches_the_scan(spark, name):
    plan = plan_text(QUERIES[name](spark, SF001))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan)


def test_sample_takes_observations_before_joining(spark):
    plan = plan_text(QUERIES["enriched_sample"](spark, SF001))
    assert plan.count("TakeOrderedAndProject") == 2


def test_records_are_decoded_once(spark):
    plan = QUERIES["normalised_states"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
