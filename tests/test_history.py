"""Point-in-time look-ups, late rows in stored histories, hot keys with ties."""

from datetime import timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestar.functions.hashing import surrogate_key
from lakestar.operators.asof import asof_join
from lakestar.operators.facts import Lookup, asof_fact
from lakestar.operators.history import scd2_history
from lakestar.session import scratch_dir
from lakestar.sources.timelines import merge_changes, timeline_read
from tests.conftest import T0, T1, T2
from tests.test_scd import SLOW

CHANGES = "id string, name string, seen timestamp, n int, note string"
VERSIONS = "id string, name string, valid_from timestamp, valid_to timestamp"
FACTS = "id string, at timestamp, fact int"


def at(hours):
    return None if hours is None else T0 + timedelta(hours=hours)


def rows_of(df, *columns):
    return sorted((repr(tuple(r)) for r in df.select(*(columns or sorted(df.columns))).collect()))


# --- hot keys ---------------------------------------------------------------------------------


def test_a_hot_key_of_one_time_reaches_no_window_whole(spark):
    """All rows of a key share one time: map tasks send one row each, whatever the number of rows."""
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("id"),
        (F.col("id") % 7).cast("string").alias("name"), F.lit(T0).alias("seen"), F.col("id").cast("int").alias("n"),
        F.lit("x").alias("note"))
    out = scd2_history(rows, ["id"], ["name"], "seen", ["n"], hot_rows=10_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") >= 0
    # Below the windows by key there is one row per key and time: 51 of 40,000.
    found = out.collect()
    assert len(found) == 51 and {r["n"] for r in found if r["id"] == "hot"} == {39_998}
    assert rows_of(out) == rows_of(scd2_history(rows, ["id"], ["name"], "seen", ["n"]))


# --- point in time ----------------------------------------------------------------------------


def brute_asof(facts, versions):
    out = []
    for key, time, fact in facts:
        valid = [v for v in versions if v[0] is not None and v[0] == key and v[2] is not None and time is not None
                 and v[2] <= time]
        best = max(valid, key=lambda v: v[2], default=None)
        name = best[1] if best and (best[3] is None or time < best[3]) else None
        out.append(repr((key, time, fact, name)))
    return sorted(out)


version = st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 20), st.one_of(st.none(), st.integers(1, 9)))
fact = st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-2, 30)))


@SLOW
@given(st.lists(version, max_size=12, unique_by=lambda v: v[:2]), st.lists(fact, max_size=25))
def test_every_row_gets_the_version_of_its_time(spark, versions, facts):
    versions = [(k, f"{k}{s}", at(s), None if n is None else at(s + n)) for k, s, n in versions]
    facts = [(k, at(h), i) for i, (k, h) in enumerate(facts)]
    known, rows = spark.createDataFrame(versions, VERSIONS), spark.createDataFrame(facts, FACTS)
    expected = brute_asof(facts, versions)
    for hot_rows, broadcast_rows in ((1_000, 1_000), (3, 1_000), (1, 0)):
        out = asof_join(rows, known, ["id"], "at", ["name"], hot_rows=hot_rows, broadcast_rows=broadcast_rows)
        assert rows_of(out, "id", "at", "fact", "name") == expected


def test_columns_of_both_sides_are_refused(spark):
    known = spark.createDataFrame([("a", "x", T0, None)], VERSIONS)
    with pytest.raises(ValueError, match="both"):
        asof_join(known.withColumn("at", F.lit(T1)), known, ["id"], "at", ["name"])


def test_look_up_shuffles_each_side_once_and_forms_no_pairs(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderdate", "o_orderkey")
    versions = scd2_history(orders, ["o_custkey"], ["o_orderkey"], "o_orderdate")
    out = asof_join(orders, versions.withColumn("was", F.col("o_orderkey")), ["o_custkey"], "o_orderdate", ["was"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_late_facts_carry_the_version_of_their_day(spark):
    versions = spark.createDataFrame([("a", "old", T0, T1), ("a", "new", T1, None)], VERSIONS)
    versions = versions.withColumn("key", surrogate_key("id", source="src"))
    rows = spark.createDataFrame([("a", T0, 1), ("a", T2, 2), ("b", T2, 3), (None, T2, 4)], FACTS)
    out = asof_fact(rows, [Lookup(versions, "id", "key")], "at", ["fact"], {"one": 1}, keep=["id"])
    found = {r["fact"]: r for r in out.collect()}
    assert out.columns == ["id", "key", "key_version", "fact", "one"]
    assert found[1]["key"] == found[2]["key"] and found[1]["key_version"] != found[2]["key_version"]
    assert found[3]["key"] is None and found[4]["key_version"] is None


# --- late rows --------------------------------------------------------------------------------

change = st.tuples(st.sampled_from("abc"), st.sampled_from(["x", "y"]), st.integers(0, 8), st.integers(0, 1), st.integers(0, 3))


@SLOW
@given(st.lists(change, min_size=1, max_size=25), st.sampled_from([1_000, 3]))
def test_any_order_of_arrival_gives_the_history_of_all_rows(spark, log, hot_rows):
    """Batches of several ages and ties; the last of them is merged twice."""
    path = scratch_dir(spark, "timeline")
    batches = {}
    for i, (key, name, hours, n, batch) in enumerate(log):
        batches.setdefault(batch, []).append((key, name, at(hours), n, f"note {i % 3}"))
    for number in [*sorted(batches), max(batches)]:
        batch = spark.createDataFrame(batches[number], CHANGES)
        merge_changes(batch, path, ["id"], ["name"], "seen", ["n"], hot_rows=hot_rows)
    every = spark.createDataFrame([r for b in batches.values() for r in b], CHANGES)
    assert rows_of(timeline_read(spark, path)) == rows_of(scd2_history(every, ["id"], ["name"], "seen", ["n"]))


def test_counts_torn_merges_and_reserved_names(spark, tmp_path):
    path = str(tmp_path / "t")

    def batch(*rows):
        return spark.createDataFrame([(k, v, at(h), 0, "") for k, v, h in rows], CHANGES)

    arguments = (path, ["id"], ["name"], "seen")
    with pytest.raises(FileNotFoundError):
        timeline_read(spark, path)
    first = merge_changes(batch(("a", "x", 1), ("a", "x", 5), (None, "x", 1), ("b", "x", None)), *arguments)
    assert first == {"rejected": 2, "keys": 1, "late": 0, "logged": 1}
    # A repeat of a value opens no version, but does once a late row comes between.
    assert merge_changes(batch(("a", "y", 3), ("b", "z", 1)), *arguments) == {"rejected": 0, "keys": 2, "late": 1, "logged": 2}
    spans = [("a", "x", at(1), at(3)), ("a", "y", at(3), at(5)), ("a", "x", at(5), None), ("b", "z", at(1), None)]
    assert rows_of(timeline_read(spark, path), "id", "name", "valid_from", "valid_to") == sorted(map(repr, spans))
    # A merge that stopped before its last write is not seen, and the next one replaces its folders.
    for part in ("log", "replaced"):
        spark.read.parquet(f"{path}/{part}/v=2").write.parquet(f"{path}/{part}/v=3")
    assert rows_of(timeline_read(spark, path), "id", "name", "valid_from", "valid_to") == sorted(map(repr, spans))
    assert merge_changes(batch(("b", "z", 9)), *arguments)["logged"] == 1
    assert rows_of(timeline_read(spark, path), "id", "name", "valid_from", "valid_to") == sorted(map(repr, spans))
    assert merge_changes(batch(), *arguments) == {"rejected": 0, "keys": 0, "late": 0, "logged": 0}
    with pytest.raises(ValueError, match="reserved"):
        merge_changes(batch().withColumn("opens", F.lit(True)), *arguments)
    with pytest.raises(TypeError, match="differ"):
        merge_changes(batch(("a", "x", 1)).withColumn("n", F.lit("text")), *arguments)
