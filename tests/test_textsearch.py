"""Trigram search gives what the substring filter gives, and reads only blocks and partitions with a candidate."""

import random

from pyspark.sql import functions as F

from tremorlake.operators import textsearch
from tremorlake.operators.filters import text_contains
from test_functions import events

WORDS = ["Ägäis", "naples", "NAPLES bay", "ridge", "a", "", "ab", "%", "_x_", "line\nbreak", "naanaa", "日本海", None]


def _events(spark, n=400):
    rng = random.Random(4)
    said = lambda: rng.choice([None, " ".join(filter(None, rng.choices(WORDS, k=3)))])
    rows = [{"id": rng.choice([None, 0, 7, rng.randrange(2_000_000)]), "usgs_id": f"e{i}", "place": said(), "title": said()} for i in range(n)]
    return events(spark, *rows)


def test_equals_the_filter_for_all_lengths(spark):
    rows = _events(spark).cache()
    index = textsearch.text_index(rows).cache()
    asked = ["n", "na", "nap", "NAPLES", " naples bay ", "naanaa", "ägäis", "日本海", "日本", "%", "_x_", "line\nb", "zzz", "ridge naples bay ridge", "a n"]
    for query in asked:
        want = sorted(r["usgs_id"] for r in rows.where(text_contains(query)).collect())
        for max_copied in (1 << 26, 0):
            found = textsearch.search_text(rows, index, query, max_copied=max_copied)
            assert found.columns == rows.columns
            assert sorted(r["usgs_id"] for r in found.collect()) == want, query
    assert textsearch.search_text(rows, index, "  ").count() == rows.count()
    nothing = rows.where("false")
    assert textsearch.search_text(nothing, textsearch.text_index(nothing), "naples").count() == 0


def test_only_partitions_with_a_candidate_are_read(spark, tmp_path):
    path, kept = str(tmp_path / "events"), str(tmp_path / "index")
    rows = spark.range(4000).select("id", F.concat(F.lit("2024-"), F.lpad((F.col("id") % 8 + 1).cast("string"), 2, "0")).alias("event_month"),
                                    F.when(F.col("id") == 803, "Lone Rock").otherwise("somewhere").alias("place"), F.lit("quake").alias("title"))
    rows.write.partitionBy("event_month").parquet(path)
    stored = spark.read.parquet(path)
    textsearch.text_index(stored, ["event_month"]).write.parquet(kept)
    found = textsearch.search_text(stored, spark.read.parquet(kept), "lone rock", ["event_month"])
    assert [r["id"] for r in found.collect()] == [803]
    assert "PushedFilters: [In(gram" in found._jdf.queryExecution().toString()
