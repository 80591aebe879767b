"""Tables in hash buckets: loads that leave the stored side where it is."""

import random

import pytest
from pyspark.sql import functions as F

from lakestar.operators.scd import scd2_apply, scd2_initial, with_hash
from lakestar.sources.copartitioned import (
    Buckets, _name, _read_part, copartitioned_current, copartitioned_insert, copartitioned_merge, copartitioned_read,
    expired_versions, new_rows, next_current,
)
from lakestar.operators.scd import changed_or_new
from tests.conftest import T0, T1, T2

BY_ID = Buckets(("id",), 6)


def stage(spark, values):
    return with_hash(spark.createDataFrame(list(values.items()), "id long, name string"), ["name"])


def rows(df):
    return sorted(map(str, df.select("id", "name", "is_current", "valid_from", "valid_to").collect()))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", range(2))
def test_merges_equal_the_operator_on_the_whole_table(spark, tmp_path, unbroadcast, seed):
    random.seed(seed)
    path, expected = str(tmp_path / "t"), None
    for as_of in (T0, T1, T2):
        staged = stage(spark, {i: random.choice(["a", "b", None]) for i in random.sample(range(60), 35)})
        expected = scd2_initial(staged, as_of) if expected is None else scd2_apply(expected, staged, ["id"], as_of)
        copartitioned_merge(staged, path, BY_ID, as_of)
        got = copartitioned_read(spark, path, BY_ID)
        assert rows(got) == rows(expected)
        assert rows(copartitioned_current(spark, path, BY_ID)) == rows(expected.filter("is_current"))


def test_repeated_and_empty_stages_publish_nothing(spark, tmp_path):
    path, staged = str(tmp_path / "t"), stage(spark, {1: "a", 2: None})
    assert copartitioned_merge(staged, path, BY_ID, T0) == {"inserted": 2, "expired": 0}
    for again in (staged, staged.filter("false")):
        assert copartitioned_merge(again, path, BY_ID, T1) == {"inserted": 0, "expired": 0}
    assert copartitioned_merge(stage(spark, {2: "b"}), path, BY_ID, T1) == {"inserted": 1, "expired": 1}


def test_an_empty_first_stage_makes_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert copartitioned_merge(stage(spark, {1: "a"}).filter("false"), path, BY_ID, T0)["inserted"] == 0
    assert copartitioned_read(spark, path, BY_ID).count() == 0
    assert copartitioned_merge(stage(spark, {1: "a"}), path, BY_ID, T1)["inserted"] == 1


def test_the_stored_side_of_a_merge_is_not_shuffled(spark, tmp_path, unbroadcast):
    path = str(tmp_path / "t")
    copartitioned_merge(stage(spark, {i: "a" for i in range(200)}), path, BY_ID, T0)
    copartitioned_merge(stage(spark, {i: "b" for i in range(100)}), path, BY_ID, T1)
    current = copartitioned_current(spark, path, BY_ID)
    staged = stage(spark, {i: "c" for i in range(300)}).repartition(BY_ID.count, "id")
    assert exchanges(changed_or_new(current, staged, ["id"])) == 1  # the stage
    delta = _read_part(spark, f"{path}/delta/v=2", BY_ID)
    assert exchanges(expired_versions(current, delta, ["id"], T2)) == 0
    assert exchanges(next_current(current, delta, ["id"], T2)) == 0


def test_grouping_by_the_key_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    copartitioned_merge(stage(spark, {i: "a" for i in range(200)}), path, BY_ID, T0)
    assert exchanges(copartitioned_current(spark, path, BY_ID).groupBy("id").count()) == 0


def test_stored_loads_are_not_shuffled_by_an_insert(spark, tmp_path, unbroadcast):
    path = str(tmp_path / "t")
    numbers = spark.range(90).select("id", F.lit("x").alias("name"))
    assert copartitioned_insert(numbers.filter("id < 40"), path, BY_ID) == 40
    assert copartitioned_insert(numbers.filter("id < 60"), path, BY_ID) == 20
    parts = [_read_part(spark, f"{path}/current/v={n}", BY_ID) for n in (1, 2)]
    assert exchanges(new_rows(numbers.repartition(BY_ID.count, "id"), parts, ["id"])) == 1  # the stage
    assert copartitioned_insert(numbers.filter("id < 60"), path, BY_ID) == 0
    assert copartitioned_insert(numbers.filter("false"), path, BY_ID) == 0
    assert copartitioned_read(spark, path, BY_ID).agg(F.count("id"), F.sum("id")).first()[:] == (60, 59 * 30)


def test_another_session_reads_the_layout_from_the_path(spark, tmp_path, unbroadcast):
    path = str(tmp_path / "it's here")
    copartitioned_merge(stage(spark, {i: "a" for i in range(50)}), path, BY_ID, T0)
    spark.sql(f"DROP TABLE {_name(f'{path}/current/v=1')}")  # as in a session that did not write it
    current = copartitioned_current(spark, path, BY_ID)
    assert current.count() == 50
    assert exchanges(current.groupBy("id").count()) == 0


def test_a_torn_merge_is_not_seen_and_repeated_by_a_rerun(spark, tmp_path):
    path = str(tmp_path / "t")
    copartitioned_merge(stage(spark, {1: "a", 2: "b"}), path, BY_ID, T0)
    torn = spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    torn.parquet(f"{path}/current/v=2")
    assert copartitioned_read(spark, path, BY_ID).count() == 2
    assert copartitioned_merge(stage(spark, {1: "c"}), path, BY_ID, T1) == {"inserted": 1, "expired": 1}
    assert copartitioned_read(spark, path, BY_ID).count() == 3


def test_wrong_stages_fail_and_publish_nothing(spark, tmp_path):
    path, good = str(tmp_path / "t"), stage(spark, {1: "a"})
    copartitioned_merge(good, path, BY_ID, T1)
    with pytest.raises(Exception, match="a staged key is null"):
        copartitioned_merge(stage(spark, {None: "a"}), path, BY_ID, T2)
    with pytest.raises(Exception, match="as_of does not lie after"):
        copartitioned_merge(stage(spark, {1: "b"}), path, BY_ID, T0)
    with pytest.raises(ValueError, match="differ from the table's"):
        copartitioned_merge(good.withColumn("more", F.lit(1)), path, BY_ID, T2)
    with pytest.raises(ValueError, match="the table has 6 buckets"):
        copartitioned_merge(good, path, Buckets(("id",), 7), T2)
    with pytest.raises(ValueError):
        Buckets((), 4)
    assert copartitioned_read(spark, path, BY_ID).count() == 1


def test_keys_of_several_columns_with_odd_names(spark, tmp_path, unbroadcast):
    path, by = str(tmp_path / "t"), Buckets(("a key", "part"), 3)
    staged = spark.range(20).select(
        F.col("id").alias("a key"), (F.col("id") % 3).cast("string").alias("part"), F.lit(1).alias("v"))
    assert copartitioned_insert(staged, path, by) == 20
    assert copartitioned_insert(staged.withColumn("part", F.lit("0")), path, by) == 13
    assert copartitioned_read(spark, path, by).count() == 33
