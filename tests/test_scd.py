from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestar.functions.hashing import version_key
from lakestar.operators.history import scd2_history
from lakestar.operators.scd import changed_or_new, insert_new_only, scd2_apply, scd2_initial, with_hash
from tests.conftest import T0, T1, T2

STAGE = "id string, name string, seen timestamp"
SLOW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def stage(spark, *data):
    rows = [(i, n, s[0] if s else T0) for i, n, *s in data]
    return with_hash(spark.createDataFrame(rows, STAGE), ["name"])


def versions(df):
    return sorted(
        ((r["id"], r["name"], r["is_current"], r["valid_from"], r["valid_to"]) for r in df.collect()), key=repr)


def test_unchanged_changed_new_and_missing_keys(spark):
    target = scd2_initial(stage(spark, ("a", "1"), ("b", "1"), ("c", "1")), T0)
    out = scd2_apply(target, stage(spark, ("a", "1"), ("b", "2"), ("d", "1")), ["id"], T1)
    assert versions(out) == [
        ("a", "1", True, T0, None),
        ("b", "1", False, T0, T1), ("b", "2", True, T1, None),
        ("c", "1", True, T0, None), ("d", "1", True, T1, None),
    ]
    assert out.columns == target.columns


def test_null_value_is_a_value(spark):
    target = scd2_initial(stage(spark, ("a", None), ("b", "x")), T0)
    same = scd2_apply(target, stage(spark, ("a", None), ("b", None)), ["id"], T1)
    assert versions(same) == [
        ("a", None, True, T0, None), ("b", "x", False, T0, T1), ("b", None, True, T1, None)]


def test_changing_back_opens_a_third_version(spark):
    target = scd2_initial(stage(spark, ("a", "1")), T0)
    target = scd2_apply(target, stage(spark, ("a", "2")), ["id"], T1)
    target = scd2_apply(target, stage(spark, ("a", "1")), ["id"], T2)
    assert versions(target) == [
        ("a", "1", False, T0, T1), ("a", "1", True, T2, None), ("a", "2", False, T1, T2)]


def test_late_rows_are_dropped(spark):
    target = scd2_initial(stage(spark, ("a", "1", T1)), T1)
    late = stage(spark, ("a", "0", T0))
    assert versions(scd2_apply(target, late, ["id"], T2, event_time="seen")) == [("a", "1", True, T1, None)]
    assert changed_or_new(target, late, ["id"], event_time="seen").count() == 0
    assert changed_or_new(target, late, ["id"]).count() == 1


def test_only_new_keys_are_inserted(spark):
    old = stage(spark, ("a", "1"))
    assert [r["id"] for r in insert_new_only(old, stage(spark, ("a", "2"), ("b", "1")), ["id"]).collect()] == ["b"]


extract = st.dictionaries(st.sampled_from("abcd"), st.sampled_from(["x", "y", None]), max_size=4)


@SLOW
@given(st.lists(extract, min_size=2, max_size=4))
def test_fold_is_idempotent_consistent_and_equals_history(spark, extracts):
    """Folding extracts one by one equals the one-shot history of all their rows."""
    target, log = None, []
    for day, values in enumerate(extracts):
        as_of = T0 + timedelta(days=day)
        staged = stage(spark, *((k, v, as_of) for k, v in values.items()))
        log += [(k, v, as_of) for k, v in values.items()]
        if target is None:
            target = scd2_initial(staged, as_of)
        else:
            target = scd2_apply(target, staged, ["id"], as_of)
        again = scd2_apply(target, staged, ["id"], as_of + timedelta(hours=1))
        result = versions(target)
        assert versions(again) == result
        target = spark.createDataFrame(target.collect(), target.schema)
    by_key = {}
    for key, _, current, start, end in result:
        assert current == (end is None)
        by_key.setdefault(key, []).append((start, end))
    for spans in by_key.values():
        spans.sort()
        assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(spans, spans[1:]))
        assert spans[-1][1] is None
    changes = spark.createDataFrame(log, STAGE)
    assert versions(scd2_history(changes, ["id"], ["name"], "seen")) == result


change = st.tuples(
    st.sampled_from("abc"), st.sampled_from(["x", "y"]), st.integers(0, 200), st.integers(0, 3))


@SLOW
@given(st.lists(change, min_size=1, max_size=60), st.randoms())
def test_hot_and_plain_history_agree(spark, log, random):
    """With ties in time and in the tiebreak, in any order of the input."""
    rows = [(k, v, T0 + timedelta(hours=h // 20), n, f"note {i % 5}") for i, (k, v, h, n) in enumerate(log)]
    schema = "id string, name string, seen timestamp, n int, note string"
    other = list(rows)
    random.shuffle(other)
    df = spark.createDataFrame(rows, schema)
    plain = scd2_history(df, ["id"], ["name"], "seen", ["n"])
    wanted = sorted(map(repr, plain.collect()))
    shuffled = scd2_history(spark.createDataFrame(other, schema), ["id"], ["name"], "seen", ["n"])
    assert sorted(map(repr, shuffled.collect())) == wanted
    for hot_rows in (5, 1):
        hot = scd2_history(df, ["id"], ["name"], "seen", ["n"], hot_rows=hot_rows)
        assert sorted(map(repr, hot.collect())) == wanted


def test_hot_history_reads_its_source_three_times(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    hot = scd2_history(orders, ["o_custkey"], ["o_orderstatus"], "o_orderdate", hot_rows=5)
    text = hot._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("FileScan parquet") <= 4


def test_history_of_long_runs_across_chunks(spark):
    """A value that stays over several chunks opens one version."""
    rows = [("a", "x", datetime(2026, 1, d)) for d in range(1, 10)] + [("a", "y", datetime(2026, 1, 20))]
    df = spark.createDataFrame(rows, STAGE)
    out = scd2_history(df, ["id"], ["name"], "seen", hot_rows=1)
    assert versions(out) == [
        ("a", "x", False, datetime(2026, 1, 1), datetime(2026, 1, 20)),
        ("a", "y", True, datetime(2026, 1, 20), None)]


def test_plain_history_takes_one_shuffle(spark):
    df = spark.createDataFrame([("a", "x", T0), ("a", "y", T1)], STAGE)
    out = scd2_history(df, ["id"], ["name"], "seen")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning(id") == 1
    assert final.count("Sort [") == 1


def test_hashes_and_version_keys_do_not_depend_on_the_sessions_zone(spark):
    frame = spark.range(1).select(
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("at"), F.lit("2026-01-02 03:04:05").cast("timestamp_ntz").alias("local"))
    before, found = spark.conf.get("spark.sql.session.timeZone"), []
    try:
        for zone in ("UTC", "Europe/Berlin", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            hashed = with_hash(frame, ["at", "local"])
            found.append(tuple(hashed.select("hash_key", version_key(F.lit("k"), "at"), version_key(F.lit("k"), "local")).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(set(found)) == 1
