"""Mergeable profiles and key filters."""

import random

import pytest
from pyspark.sql import functions as F

from lakestar.operators.keyfilter import block_count, filter_hits, key_filter
from lakestar.operators.sketches import merge_profiles, mergeable_profile, profile_estimates
from lakestar.sources.appends import appends_read, insert_filtered
from lakestar.sources.files import delete_folder
from lakestar.sources.profiles import refresh_profiles, table_profile_estimate


def estimates(profile):
    return {r["column_name"]: r for r in profile_estimates(profile).collect()}


# --- profiles ---------------------------------------------------------------------------------


def test_merged_parts_equal_the_whole(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 7).cast("string").alias("part"), "id", (F.col("id") % 50).cast("decimal(9,2)").alias("few"),
        F.when(F.col("id") % 4 > 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int"))).alias("day"),
        F.lit(None).cast("int").alias("none"), F.array("id").alias("list"), F.col("id").alias("a.b"))
    got = estimates(merge_profiles(mergeable_profile(rows, ["part"])))
    assert {c: (r["row_count"], r["null_count"]) for c, r in got.items()} == {
        "id": (20_000, 0), "few": (20_000, 0), "day": (20_000, 5_000), "none": (20_000, 20_000), "list": (20_000, 0),
        "a.b": (20_000, 0)}
    whole = estimates(mergeable_profile(rows.drop("part")))
    for name, exact in {"id": 20_000, "few": 50, "day": 750, "none": 0, "list": 20_000}.items():
        assert abs(got[name]["distinct_estimate"] - exact) <= 0.05 * exact
        assert abs(whole[name]["distinct_estimate"] - exact) <= 0.05 * exact
    assert got["none"]["quantiles"] is None and got["list"]["quantiles"] is None
    assert (got["id"]["quantiles"][0], got["id"]["quantiles"][-1]) == (0.0, 19_999.0)
    assert abs(got["id"]["quantiles"][2] - 10_000) <= 0.03 * 20_000
    assert mergeable_profile(rows.limit(0), ["part"]).count() == 0
    assert estimates(mergeable_profile(rows.drop("part").limit(0)))["id"]["quantiles"] is None


def test_refresh_reads_changed_partitions_only(spark, tmp_path):
    table, profiles = f"{tmp_path}/table", f"{tmp_path}/profiles"

    def write(low, high, part):
        spark.range(low, high).select("id", F.lit(part).cast("string").alias("p")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("p").parquet(table)

    write(0, 100, "01")
    write(100, 300, "a b:c/d")
    assert refresh_profiles(spark, table, "p", profiles) == ["p=01", "p=a b:c/d"]
    assert refresh_profiles(spark, table, "p", profiles) == []
    write(300, 350, None)
    assert refresh_profiles(spark, table, "p", profiles) == ["p=__HIVE_DEFAULT_PARTITION__"]
    assert estimates(table_profile_estimate(spark, profiles))["id"]["row_count"] == 350
    write(0, 10, "01")
    assert refresh_profiles(spark, table, "p", profiles) == ["p=01"]
    assert estimates(table_profile_estimate(spark, profiles))["id"]["row_count"] == 260
    delete_folder(spark, f"{table}/p=01")
    assert refresh_profiles(spark, table, "p", profiles) == []
    got = estimates(table_profile_estimate(spark, profiles))["id"]
    assert (got["row_count"], got["quantiles"][0], got["quantiles"][-1]) == (250, 100.0, 349.0)


# --- key filters ------------------------------------------------------------------------------


def test_filter_misses_no_key_and_hits_few_others(spark):
    rows = spark.range(5_000).select("id", F.concat(F.lit("k"), "id").alias("name"))
    blocks = block_count(5_000, 16)
    words = key_filter(rows, ["id", "name"], blocks).select(F.lit(1).alias("append"), F.lit(blocks).alias("blocks"), "*")
    assert filter_hits(rows.union(rows), ["id", "name"], words, [blocks]).count() == 5_000
    others = rows.withColumn("id", F.col("id") + 5_000)
    assert filter_hits(others, ["id", "name"], words, [blocks]).count() <= 50


def test_insert_filtered_equals_the_anti_join(spark, tmp_path):
    random.seed(3)
    path, held = str(tmp_path), {}
    schema = "k int, s string, v long"
    for run in range(5):
        keys = [(random.randrange(60), random.choice(["x", "y", None])) for _ in range(30)]
        staged = [(k, s, run * 1000 + i) for i, (k, s) in enumerate(keys)]
        new = [r for r in staged if r[1] is None or r[:2] not in held]
        got = insert_filtered(spark.createDataFrame(staged, schema), path, ["k", "s"])
        assert (got["inserted"], got["appends"]) == (len(new), run)
        for r in new:
            held[r if r[1] is None else r[:2]] = held.get(r[:2], []) + [r]
    assert sorted(r["v"] for r in appends_read(spark, path).collect()) == sorted(r[2] for rows in held.values() for r in rows)


def test_appends_without_hits_are_not_opened(spark, tmp_path):
    path = str(tmp_path)
    for n in range(3):
        got = insert_filtered(spark.range(n * 1000, n * 1000 + 100), path, ["id"], bits_per_key=32)
        assert got["inserted"] == 100
    delete_folder(spark, f"{path}/filters/v=2")  # as if the load had stopped before its filter
    before = insert_filtered(spark.range(1010, 1020).withColumn("id", F.col("id").cast("int")), path, ["id"], bits_per_key=32)
    assert before == {"inserted": 0, "appends": 3, "opened": 1}
    assert insert_filtered(spark.range(0), path, ["id"]) == {"inserted": 0, "appends": 3, "opened": 0}
    with pytest.raises(ValueError):
        insert_filtered(spark.range(3).withColumn("more", F.lit(1)), path, ["id"])
    with pytest.raises(TypeError):
        insert_filtered(spark.range(3).select(F.col("id").cast("double")), f"{path}/other", ["id"])
    assert appends_read(spark, path).count() == 300
