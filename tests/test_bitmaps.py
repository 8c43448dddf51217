"""Bitmaps built by words are those of the engine, and no task sorts its rows for them."""

from pyspark.sql import functions as F

from tremorlake.operators.bitmaps import bitmaps
from tremorlake.operators.membership import key_filters
from tremorlake.operators.textsearch import text_index


def test_equal_the_engines_bitmaps(spark):
    bits = [(1, 0), (1, 63), (1, 64), (1, 32_767), (2, 5), (2, 5), (2, 7), (3, 32_767), (4, 20_000), (None, 9)]
    rows = spark.createDataFrame(bits, "k INT, bit LONG").unionByName(spark.range(40_000).selectExpr("5 AS k", "(id * 7919) % 32768 AS bit"))
    want = rows.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("b"))
    assert {r["k"]: bytes(r["b"]) for r in bitmaps(rows, ["k"], "bit", "b").collect()} == {r["k"]: bytes(r["b"]) for r in want.collect()}


def test_rows_are_not_sorted_before_they_are_reduced(spark):
    rows = spark.range(1000).selectExpr("id", "concat('k', id) AS key", "'a' AS folder", "'some place' AS place", "'title' AS title")
    for made in (key_filters(rows, F.col("key"), ["folder"]), text_index(rows)):
        plan = made._jdf.queryExecution().sparkPlan().toString()
        assert "SortAggregate" not in plan and "bitmap_construct_agg" not in plan
