"""Physical plans: no cross products, no Python in core paths, pushed filters, bounded copies."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tremorlake.operators import joins
from tremorlake.operators.filters import EventFilter, since, within_ms
from tremorlake.operators import tables
from tremorlake.operators.ranking import query_events
from tremorlake.operators.tables import insert_new
from tremorlake.plans import fixtures as fx
from tremorlake.plans.queries import QUERIES
from tremorlake.session import checkpoint_dir

SF_DIR = "/root/testdata/sf0.001"
ONE_ROW_PER_FRAME = {"playback_counts"}                # running sum over frames, not events


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_avoid_cross_products_python_and_global_windows(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search(r"Python|InPandas|InArrow", text)
    if name not in ONE_ROW_PER_FRAME:
        for window in re.findall(r"windowspecdefinition\(([^)]*)", text):
            assert not re.match(r"\S+ (ASC|DESC)", window) or "_part" in window


def test_the_user_query_is_a_top_k_with_pushed_filters(spark):
    wanted = EventFilter(start=datetime(2024, 1, 3), end=datetime(2024, 1, 5))
    text = plan(query_events(fx.quakes(spark, SF_DIR), wanted))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,2024-01-03T00:00", text)


@pytest.mark.parametrize("name", ["visible_at", "playback_counts", "playback_heat", "heat_density", "frequency_grid_year"])
def test_time_bounds_reach_the_scan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan(OrEqual)?\(ts,", text) and re.search(r"PushedFilters: \[[^\]]*LessThan(OrEqual)?\(ts,", text)


def test_month_folders_out_of_range_are_not_read(spark, tmp_path):
    months = spark.range(12).select(F.timestamp_add("DAY", F.col("id").cast("int") * 31, F.lit(datetime(2024, 1, 1))).cast("timestamp_ntz").alias("time_utc"))
    months.withColumn("event_month", F.date_format("time_utc", "yyyy-MM")).write.partitionBy("event_month").parquet(str(tmp_path / "s"))
    stored = spark.read.schema("time_utc TIMESTAMP_NTZ, event_month STRING").parquet(str(tmp_path / "s"))
    day = lambda m, d: int((datetime(2024, m, d) - datetime(1970, 1, 1)).total_seconds() * 1000)
    for df in (within_ms(stored, day(3, 1), day(4, 4)), since(stored, F.lit(datetime(2024, 4, 4)).cast("timestamp_ntz"), 24 * 34)):
        assert re.search(r"PartitionFilters: \[[^\]]*event_month[^\]]*>=[^\]]*2024-0[13]", plan(df))
        assert sorted(r[0].month for r in df.collect()) == [3, 4]
    assert within_ms(stored.unionByName(spark.sql("SELECT CAST(null AS TIMESTAMP_NTZ) time_utc, 'unknown' event_month")), -5, 5).count() == 1


def test_counting_reads_no_columns(spark):
    assert "ReadSchema: struct<>" in plan(QUERIES["count_quakes"](spark, SF_DIR))


def test_points_read_only_the_columns_they_need(spark):
    assert re.search(r"ReadSchema: struct<event_id:bigint>", plan(QUERIES["scan_points"](spark, SF_DIR)))


def test_lookup_join_beyond_the_limit_shuffles_and_agrees(spark):
    left = spark.range(1_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"))
    right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    few, many = joins.lookup_join(left, right, ["k"]), joins.lookup_join(left, right, ["k"], max_copied=10)
    assert "BroadcastHashJoin" in plan(few) and "SortMergeJoin" in plan(many)
    assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    assert few.columns == many.columns == ["id", "k", "v"] and many.count() == 1_000


def test_a_small_batch_does_not_move_the_stored_ids(spark):
    stored = spark.range(10**9).select(F.col("id").cast("string").alias("usgs_id"))
    batch = spark.createDataFrame([("x", 1)], "usgs_id STRING, id INT")
    text = plan(insert_new(stored, batch))
    after = text[text.index("LeftAnti"):]
    assert re.search(r"BroadcastHashJoin [^\n]*LeftSemi", after) and "SortMergeJoin" not in text
    many = plan(tables._stored_keys(stored, batch, "usgs_id", max_copied=0))
    assert "Broadcast" not in many


def test_the_shared_folder_is_the_one_configured(spark):
    assert spark.sparkContext.getConf().get("spark.checkpoint.dir") in checkpoint_dir(spark)
