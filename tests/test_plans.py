"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from lakestar.operators.facts import Lookup, snapshot_fact
from lakestar.operators.projection import current_rows
from lakestar.operators.scd import changed_or_new, insert_new_only, scd2_apply, scd2_initial, with_hash
from lakestar.plans.queries import QUERIES
from lakestar.sources.tables import scd2_merge, table_read
from tests.conftest import T0, T1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def parts(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet")


def test_ranking_reads_two_columns_and_aggregates_before_the_shuffle(spark, sf):
    text = plan(QUERIES["top_entities_by_avg"](spark, sf))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert "partial_avg" in text and "TakeOrderedAndProject" in text


def test_ranked_side_is_broadcast_after_the_limit(spark, sf):
    text = plan(QUERIES["top_groups_prelimit"](spark, sf))
    assert re.search(r"BroadcastExchange.*\n(.*Filter.*\n)?.*TakeOrderedAndProject\(limit=5", text)


def test_current_rows_reach_the_scan(spark, tmp_path, parts):
    scd2_initial(parts.select("p_partkey"), T0).write.parquet(str(tmp_path / "t"))
    text = plan(current_rows(spark.read.parquet(str(tmp_path / "t"))).select("p_partkey"))
    assert "EqualTo(is_current,true)" in text


def test_change_detection_reads_keys_and_hash_of_the_stored_side(spark, tmp_path, parts):
    staged = with_hash(parts, ["p_name"])
    scd2_initial(staged, T0).write.parquet(str(tmp_path / "t"))
    text = plan(changed_or_new(spark.read.parquet(str(tmp_path / "t")), staged, ["p_partkey"]))
    assert "ReadSchema: struct<p_partkey:bigint,hash_key:string>" in text


def test_insert_only_reads_keys_of_the_stored_side(spark, tmp_path, parts):
    parts.write.parquet(str(tmp_path / "t"))
    text = plan(insert_new_only(spark.read.parquet(str(tmp_path / "t")), parts, ["p_partkey"]))
    assert "LeftAnti" in text and "ReadSchema: struct<p_partkey:bigint>" in text


def test_apply_joins_each_side_once(spark, parts):
    staged = with_hash(parts, ["p_name"])
    text = optimized(scd2_apply(scd2_initial(staged, T0), staged, ["p_partkey"], T1))
    assert text.count("Join ") == 1


def test_fact_look_ups_are_not_shuffled(spark, sf, parts):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    fact = snapshot_fact(
        lines, [Lookup(parts.withColumn("key", F.col("p_name")), "p_partkey", "key", "l_partkey")], ["l_tax"], {})
    text = plan(fact)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_history_is_pruned_by_version(spark, tmp_path, parts):
    path = str(tmp_path / "t")
    scd2_merge(with_hash(parts.select("p_partkey", "p_name"), ["p_name"]), path, ["p_partkey"], T0)
    changed = parts.select("p_partkey", F.upper("p_name").alias("p_name"))
    assert scd2_merge(with_hash(changed, ["p_name"]), path, ["p_partkey"], T1)["expired"] == parts.count()
    text = plan(table_read(spark, path))
    assert re.search(r"PartitionFilters: \[[^\]]*v#\d+ <= 2", text)


NO_PRODUCT = ("CartesianProduct", "BroadcastNestedLoopJoin")
JOBS = ("run_extract", "run_silver", "run_gold", "run_export", "analysis")
CHEAP = [n for n in sorted(QUERIES) if n not in JOBS]


@pytest.mark.parametrize("name", CHEAP)
def test_no_query_forms_products_or_leaves_the_jvm(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert not any(node in text for node in NO_PRODUCT)
    assert not any(node in text for node in ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas"))
