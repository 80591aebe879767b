"""CSV read by ranges, bridge tables, content reconciliation."""

import random

import pytest
from pyspark.sql import functions as F

from lakestar.contracts import Contract
from lakestar.operators import bridge, reconcile
from lakestar.sources.landing import read_csv_contract
from lakestar.sources.split_csv import read_csv_split
from lakestar.sources.writers import land_snapshot
from tests.conftest import T0

NOTE = Contract("notes", "id string, note string, other string", keys=("id",))


def content(df, *columns):
    return sorted(repr(tuple(r)) for r in df.select(*(columns or sorted(df.columns))).collect())


# --- CSV by ranges ----------------------------------------------------------------------------


@pytest.fixture
def small_splits(spark):
    """Byte ranges of about a hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def note_text(rng):
    return "".join(rng.choice(["a", "b", '"', "\n", "\r\n", ",", " ", "é", '""', "\\", "\n\n"]) for _ in range(rng.randrange(40)))


@pytest.mark.parametrize("seed", range(3))
def test_ranges_give_the_rows_of_whole_files(spark, tmp_path, seed, small_splits):
    rng = random.Random(seed)
    rows = [(str(i), rng.choice([None, "", note_text(rng), note_text(rng)]), rng.choice(["x", None, '"'])) for i in range(120)]
    path, _ = land_snapshot(spark.createDataFrame(rows, NOTE.ddl).coalesce(2), str(tmp_path), "notes", T0)
    split = read_csv_split(spark, path, NOTE)
    assert content(split, "id", "note", "other") == sorted(map(repr, rows))
    assert content(split) == content(read_csv_contract(spark, path, NOTE))
    lines = spark.read.text(path)
    assert lines.rdd.getNumPartitions() > 20


def test_a_record_over_many_ranges(spark, tmp_path, small_splits):
    long = "\n".join(["line, with \"\"marks\"\""] * 200)
    file = tmp_path / "a.csv"
    file.write_text(f'id,note,other\n1,"{long}",x\n2,b,y\n\n3,"{long}",\r\n4,"",z', newline="")
    split = read_csv_split(spark, str(tmp_path), NOTE)
    text = long.replace('""', '"')
    assert content(split, "id", "note", "other") == sorted(map(repr, [
        ("1", text, "x"), ("2", "b", "y"), ("3", text, None), ("4", "", "z")]))


def test_another_header_fails_and_misfits_are_told(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text("note,id,other\nn,1,\n")
    with pytest.raises(Exception, match="header"):
        read_csv_split(spark, str(tmp_path), NOTE).collect()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.csv").write_text("id,note,other\n1,a\n2,b,c\n")
    found = {r["id"]: r["corrupt_record"] for r in read_csv_split(spark, str(tmp_path / "b"), NOTE, corrupt=True).collect()}
    assert found == {"1": "1,a", "2": None}


def test_the_text_is_shuffled_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note,other\n1,a,\n")
    plan = read_csv_split(spark, str(tmp_path), NOTE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- bridges ----------------------------------------------------------------------------------


def test_shares_add_up_to_every_measure(spark):
    pairs = [("t1", "a"), ("t1", "b"), ("t1", "c"), ("t1", "a"), ("t2", "a"), ("t3", None), (None, "a")]
    rows = [("t1", 10), ("t1", -3), ("t2", 5), ("t3", 4), ("t4", None), (None, 2)]
    table = bridge.bridge_table(spark.createDataFrame(pairs, "t string, a string"), "t", "a")
    assert content(table, "t", "a", "position", "n_members") == [
        "('t1', 'a', 0, 3)", "('t1', 'b', 1, 3)", "('t1', 'c', 2, 3)", "('t2', 'a', 0, 1)"]
    assert abs(sum(r["weight"] for r in table.filter("t = 't1'").collect()) - 1) < 1e-12
    totals = bridge.through_bridge(spark.createDataFrame(rows, "t string, m bigint"), table, "t", "a", ["m"])
    assert {r["a"]: r["m"] for r in totals.collect()} == {"a": 3 + 5, "b": 2, "c": 2, None: 6}


@pytest.mark.parametrize("measure", [-7, 0, 1, 11, (1 << 62) + 1])
def test_any_measure_is_divided_without_a_rest(spark, measure):
    pairs = spark.createDataFrame([("t", str(i)) for i in range(7)], "t string, a string")
    rows = spark.createDataFrame([("t", measure)], "t string, m bigint")
    shares = [r["m"] for r in bridge.through_bridge(rows, bridge.bridge_table(pairs, "t", "a"), "t", "a", ["m"]).collect()]
    assert sum(shares) == measure and max(shares) - min(shares) <= 1


# --- content ----------------------------------------------------------------------------------

CELLS = "id int, name string, n int"


def test_one_changed_cell_is_found_and_named(spark, tmp_path):
    rows = [(i, f"n{i}", i % 5) for i in range(400)]
    original = spark.createDataFrame(rows, CELLS)
    taken, observed = reconcile.observed_checksums(original, ["id"])
    observed.write.parquet(str(tmp_path / "t"))
    first = reconcile.checksums_of(spark, taken)
    assert content(first) == content(reconcile.bucket_checksums(original.repartition(7), ["id"]))
    copy = spark.read.parquet(str(tmp_path / "t"))
    assert reconcile.differing_buckets(first, reconcile.bucket_checksums(copy, ["id"])).count() == 0
    changed = copy.withColumn("n", F.when(F.col("id") == 77, 9).otherwise(F.col("n")))
    buckets = reconcile.differing_buckets(first, reconcile.bucket_checksums(changed, ["id"]))
    assert buckets.count() == 1 and buckets.filter("original_rows = saved_rows").count() == 1
    assert content(reconcile.differing_cells(original, changed, ["id"], buckets), "id", "kind", "column_name", "original", "saved") == [
        "(77, 'changed', 'n', '2', '9')"]


def test_repeats_nulls_and_swapped_values(spark):
    original = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, None, 2), (None, "x", 3), (4, "", 4), (5, "p", 6)], CELLS)
    saved = spark.createDataFrame([(1, "a", 1), (2, "", 2), (None, "x", None), (4, None, 4), (6, "q", 5), (6, "q", 5)], CELLS)
    found = reconcile.differing_cells(original, saved, ["id"])
    assert content(found, "id", "kind", "column_name", "original", "saved") == sorted(map(repr, [
        (1, "missing", None, None, None), (2, "changed", "name", None, ""), (None, "changed", "n", "3", None),
        (4, "changed", "name", "", None), (5, "missing", None, None, None), (6, "added", None, None, None),
        (6, "added", None, None, None)]))
    swapped = spark.createDataFrame([(1, "b", 1), (2, "a", 2)], CELLS)
    sums = [reconcile.bucket_checksums(df, ["n"], 1) for df in (swapped, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], CELLS))]
    assert reconcile.differing_buckets(*sums).count() == 1
    empty = spark.createDataFrame([], CELLS)
    assert reconcile.differing_cells(empty, empty, ["id"]).count() == 0 and reconcile.bucket_checksums(empty, ["id"]).count() == 0
    keys_only = reconcile.differing_cells(original.select("id"), saved.select("id"), ["id"])
    assert sorted(r["kind"] for r in keys_only.collect()) == ["added", "added", "missing", "missing"]
    with pytest.raises(ValueError, match="differ"):
        reconcile.differing_cells(original, saved.drop("n"), ["id"])
