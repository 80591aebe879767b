import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakestar.contracts import STAGED_ALBUMS, STAGED_TRACKS, TABLES
from lakestar.operators import dedup, dimensions, facts, joins, projection, quality, rankings


def rows(df, *order):
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)


# --- projections


def test_contract_casts_renames_orders_and_drops(spark):
    df = spark.createDataFrame(
        [("s1", "n", "x", "7", "2020", "extra")],
        "song_id string, song_name string, duration_ms string, popularity string, song_added string, more string")
    out = projection.enforce_contract(df, STAGED_TRACKS)
    assert out.columns == STAGED_TRACKS.columns
    assert out.schema["popularity"].dataType.simpleString() == "int"
    row = out.first()
    assert (row["track_id"], row["duration_ms"], row["popularity"], row["url"]) == ("s1", None, 7, None)


def test_contract_reads_partial_release_dates(spark):
    df = spark.createDataFrame([("a", "1999"), ("b", "0000")], "album_id string, release_date string")
    out = projection.enforce_contract(df, STAGED_ALBUMS)
    assert rows(out, "album_id", "release_date") == [("a", datetime(1999, 1, 1)), ("b", None)]


def test_contract_needs_its_key(spark):
    with pytest.raises(ValueError, match="track_id"):
        projection.enforce_contract(spark.createDataFrame([("n",)], "song_name string"), STAGED_TRACKS)


def test_eleven_tables_are_declared():
    assert len(TABLES) == 11


def test_null_keys_are_split_off(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, l int")
    complete, rejected = projection.split_null_keys(df, ["k", "l"])
    assert (complete.count(), rejected.count()) == (1, 2)


# --- dedup


def test_latest_is_independent_of_order_and_partitioning(spark):
    data = [(k, t, v) for k in range(5) for t in (1, 2) for v in range(6)]
    results = set()
    for seed, partitions in ((1, 1), (2, 3), (3, 7)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, t int, v int").repartition(partitions)
        results.add(tuple(rows(dedup.dedup_latest(df, ["k"], ["t"]))))
    assert results == {tuple((k, 2, 5) for k in range(5))}


def test_last_batch_keeps_the_first_row_of_the_last_batch(spark):
    df = spark.createDataFrame(
        [("a", 1, 0, "x"), ("a", 2, 0, "y"), ("a", 2, 1, "z"), ("b", 1, 5, "w")], "k string, b int, p int, v string")
    assert rows(dedup.dedup_last_batch(df, ["k"], ["b"], ["p"]), "k", "v") == [("a", "y"), ("b", "w")]


def test_columns_without_order_break_no_ties(spark):
    df = spark.range(2).select(F.lit(1).alias("k"), F.lit(1).alias("t"), F.create_map(F.lit("a"), F.col("id")).alias("m"),
                               F.array(F.struct(F.create_map(F.lit("a"), F.col("id")).alias("x"))).alias("n"))
    assert dedup.dedup_latest(df, ["k"], ["t"]).count() == 1


def test_dedup_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = dedup.dedup_latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_first_n_unique(spark):
    df = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2), ("c", 3)], "k string, p int")
    assert rows(dedup.first_n_unique(df, ["k"], ["p"], 2)) == [("a", 1), ("b", 0)]


# --- look-ups


def _skewed(spark):
    """A third of the rows holds one key, some have no key, some keys are unknown."""
    data = [(i, 7 if i % 3 == 0 else (None if i % 10 == 1 else i % 40)) for i in range(600)]
    lookup = [(k, f"v{k}") for k in range(30)]
    return spark.createDataFrame(data, "id int, k int"), spark.createDataFrame(lookup, "k int, v string")


@pytest.mark.parametrize("hot_rows", [5, 100, 10_000])
def test_lookup_paths_agree(spark, hot_rows):
    df, lookup = _skewed(spark)
    expected = rows(df.join(lookup, "k", "left"), "id", "k", "v")
    assert joins.lookup_join(df, lookup, "k").columns == ["id", "k", "v"]
    assert rows(joins.lookup_join(df, lookup, "k"), "id", "k", "v") == expected
    split = joins.lookup_join(df, lookup, "k", broadcast_rows=0, hot_rows=hot_rows)
    assert rows(split, "id", "k", "v") == expected
    assert split.count() == 600


def test_lookup_keeps_hot_copies_of_unknown_keys(spark):
    df = spark.createDataFrame([(9,)] * 50 + [(1,)], "k int")
    lookup = spark.createDataFrame([(1, "x")], "k int, v string")
    split = joins.lookup_join(df, lookup, "k", broadcast_rows=0, hot_rows=10)
    assert rows(split.groupBy("k", "v").count()) == [(1, "x", 1), (9, None, 50)]


def test_hot_keys_are_bounded(spark):
    df = spark.createDataFrame([(i % 4,) for i in range(40)], "k int")
    assert joins.hot_keys(df, ["k"], hot_rows=10).count() == 4
    assert joins.hot_keys(df, ["k"], hot_rows=11).count() == 0
    assert joins.hot_keys(df, ["k"], hot_rows=1, max_keys=2).count() == 2


# --- star schema


def test_calendar_attributes(spark):
    bounds = spark.createDataFrame([(datetime(2024, 2, 28), datetime(2024, 3, 1))], "a timestamp, b timestamp")
    out = dimensions.date_dimension(dimensions.date_spine(bounds, "a", "b"))
    assert [r["date_key"] for r in out.orderBy("date_key").collect()] == [20240228, 20240229, 20240301]
    week53 = dimensions.date_dimension(dimensions.date_spine(
        spark.range(1), F.lit("2021-01-03"), F.lit("2021-01-03"))).first()
    assert (week53["week_of_year"], week53["day_of_week"], week53["quarter"]) == (53, 1, 1)
    assert out.columns == TABLES["dim_dates"].columns


def test_dimension_stage_holds_one_current_row_per_entity(spark):
    silver = spark.createDataFrame(
        [("a", "old", "h0", False, datetime(2026, 1, 1), datetime(2026, 1, 2)),
         ("a", "new", "h1", True, datetime(2026, 1, 2), None)],
        "artist_id string, artist_name string, hash_key string, is_current boolean, valid_from timestamp, valid_to timestamp")
    out = dimensions.dimension_scd2(
        silver, "artist_id", "artist_key", "src", datetime(2026, 1, 3),
        ["artist_key", "artist_id", "artist_name", "is_current", "hash_key", "source_system", "last_updated"])
    assert rows(out, "artist_id", "artist_name", "hash_key") == [("a", "new", "h1")]


def test_fact_keeps_rows_without_dimension(spark):
    tracks = spark.createDataFrame([("t1", "a1", 5), ("t2", "zz", 6), ("t3", None, 7)], "t string, artist_id string, p int")
    artists = spark.createDataFrame([("a1", "K1")], "artist_id string, artist_key string")
    out = facts.snapshot_fact(
        tracks, [facts.Lookup(artists, "artist_id", "artist_key")], ["p"], {"date_key": 20260101, "play_count": 1}, ["t"])
    assert rows(out) == [("t1", "K1", 5, 20260101, 1), ("t2", None, 6, 20260101, 1), ("t3", None, 7, 20260101, 1)]


# --- rankings


def test_rankings(spark):
    tracks = spark.createDataFrame(
        [("a", "x", 10, "2020-01-01"), ("a", "x", 30, "2020-05-01"), ("b", "y", 20, "2021-01-01"),
         ("c", "z", None, "bad"), (None, "w", 99, None)], "artist string, album string, pop int, added string")
    artists = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "artist string, name string")
    albums = spark.createDataFrame([("x", "X"), ("z", "Z")], "album string, title string")
    top = rankings.top_entities_by_avg(tracks, artists, "artist", "pop", "name", "avg")
    assert [(r["name"], r["avg"]) for r in top.collect()] == [("A", 20.0), ("B", 20.0), ("C", None)]
    years = rankings.avg_by_year(tracks, "added", "pop", "year", "avg")
    assert [tuple(r) for r in years.collect()] == [("2020", 20.0), ("2021", 20.0)]
    total = rankings.top_groups_prelimit(tracks, albums, "album", "pop", "title", "total", n=2)
    assert rows(total, "title", "total") == [("X", 40)]
    everything = rankings.top_groups_prelimit(tracks, albums, "album", "pop", "title", "total", n=9)
    assert rows(everything, "title", "total") == [("X", 40), ("Z", 0)]
    assert rankings.top_groups_by_count(tracks, "artist", "n").first()["n"] == 2


def test_top_k_is_distributed(spark):
    df = spark.range(100).select((F.col("id") % 9).alias("k"))
    plan = rankings.top_groups_by_count(df, "k", "n")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan


# --- quality


def test_profile_and_reconciliation(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert rows(quality.null_profile(df)) == [("a", "int", 1, 3), ("b", "string", 2, 3)]
    assert tuple(quality.reconcile_counts(df, df.limit(2)).first()) == (3, 2, False)
    assert quality.table_profile({"t": df, "u": df}).count() == 4


def test_bad_values_have_one_reason_and_good_ones_none(spark):
    values = [None, "", "http://x", "www.x", "abc", "2020", "2020-01-02", "2020-01-02T00:00:00Z"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    found = {r["id"]: r["reason"] for r in quality.bad_values(df, "v", ["id"]).collect()}
    assert found == {0: "null", 1: "empty", 2: "url", 3: "url", 4: "no_year", 5: "no_iso_date"}


def test_timestamps_are_sanitised_and_only_named_ones_filled(spark):
    df = spark.createDataFrame(
        [(datetime(1850, 1, 1), None), (datetime(2020, 1, 1), None)], "valid_from timestamp, valid_to timestamp")
    clean = quality.sanitize_timestamps(df)
    filled = quality.fill_timestamps(clean, ["valid_from"], datetime(2026, 1, 1))
    assert rows(filled) == [(datetime(2020, 1, 1), None), (datetime(2026, 1, 1), None)]


def test_empty_rows_are_dropped(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert quality.drop_empty_rows(df).count() == 1


def test_contract_report_counts_misfits(spark):
    df = spark.createDataFrame([("a", "x", "5"), ("b", "1", "1999-05")], "album_id string, total_tracks string, release_date string")
    report = {r["column_name"]: r for r in quality.contract_report(df, STAGED_ALBUMS).collect()}
    assert (report["total_tracks"]["status"], report["total_tracks"]["misfits"]) == ("cast", 1)
    assert report["release_date"]["misfits"] == 1
    assert (report["name"]["status"], report["name"]["required"]) == ("missing", True)
    assert quality.missing_required(df, STAGED_ALBUMS) == ["name", "artist_id"]


def test_observed_counts_need_no_second_job(spark):
    counted, df = quality.observe_counts(spark.range(10), odd=F.count_if(F.col("id") % 2 == 1))
    df.collect()
    assert counted.get == {"rows": 10, "odd": 5}


def test_lookup_reads_its_rows_once(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    parts = spark.read.parquet(f"{sf}/part.parquet")
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet")
    fact = facts.snapshot_fact(
        lines, [facts.Lookup(parts.withColumn("part_key", F.col("p_name")), "p_partkey", "part_key", "l_partkey"),
                facts.Lookup(suppliers.withColumn("supplier_key", F.col("s_name")), "s_suppkey", "supplier_key", "l_suppkey")],
        ["l_tax"], {}, broadcast_rows=0, hot_rows=20)
    text = fact._jdf.queryExecution().executedPlan().toString()
    assert text.count("l_suppkey:bigint") == 1


def test_naive_times_are_of_the_session_zone(spark):
    import os
    import time
    from datetime import datetime

    from lakestar.operators.projection import as_column

    zone = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "Europe/Berlin"
        time.tzset()
        shown = spark.range(1).select(as_column(datetime(2026, 1, 2, 3, 4, 5, 6)).cast("string").alias("t")).first()["t"]
    finally:
        os.environ.pop("TZ") if zone is None else os.environ.update(TZ=zone)
        time.tzset()
    assert shown == "2026-01-02 03:04:05.000006"
