import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakestar.functions.dates import (
    calendar_bounds, date_key, date_precision, parse_partial_date, run_stamp, stamp_in_path,
)
from lakestar.functions.hashing import row_hash, surrogate_key, version_key
from lakestar.session import shuffle_partitions


def _hashes(spark, rows, schema="a string, b string"):
    df = spark.createDataFrame(rows, schema)
    return [r["h"] for r in df.select(row_hash(*df.columns).alias("h")).collect()]


def test_hash_separates_values(spark):
    assert len(set(_hashes(spark, [("ab", "c"), ("a", "bc"), ("abc", "")]))) == 3


def test_hash_separates_null_from_text(spark):
    hashes = _hashes(spark, [(None, "x"), ("", "x"), ("~", "x"), ("0:", "x")])
    assert len(set(hashes)) == 4 and None not in hashes


def test_hash_of_null_timestamp_works_under_ansi(spark):
    df = spark.createDataFrame([("x", None)], "a string, t timestamp")
    assert df.select(row_hash("a", "t").alias("h")).first()["h"]


def test_surrogate_key_is_digest_of_key_and_source(spark):
    df = spark.createDataFrame([("k1",), (None,)], "id string")
    keys = [r["k"] for r in df.select(surrogate_key("id", source="src").alias("k")).collect()]
    assert keys == [hashlib.sha256(b"k1src").hexdigest(), None]


def test_composite_surrogate_key_is_separated(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    keys = {r["k"] for r in df.select(surrogate_key("x", "y", source="s").alias("k")).collect()}
    assert len(keys) == 2
    with pytest.raises(ValueError):
        surrogate_key("x", "y", source="s", separator="")


def test_version_key_differs_per_version(spark):
    df = spark.createDataFrame([("k", datetime(2026, 1, 1)), ("k", datetime(2026, 1, 2))], "k string, f timestamp")
    assert df.select(version_key("k", "f")).distinct().count() == 2


@pytest.mark.parametrize("text, expected, precision", [
    ("1999", datetime(1999, 1, 1), "year"),
    ("1999-05", datetime(1999, 5, 1), "month"),
    (" 1999-05-06 ", datetime(1999, 5, 6), "day"),
    ("1999-05-06T07:08:09", datetime(1999, 5, 6, 7, 8, 9), "day"),
    ("", None, None), ("0000", None, None), ("abc", None, None), ("1999-13", None, None),
    ("12:30", None, None), (None, None, None),
])
def test_partial_dates(spark, text, expected, precision):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(parse_partial_date("t", "timestamp_ntz").alias("d"), date_precision("t").alias("p")).first()
    assert (row["d"], row["p"]) == (expected, precision)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_date_key_is_padded_with_and_without_ansi(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = spark.range(1).select(date_key(F.lit(date(2026, 3, 4))).alias("k")).first()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert row["k"] == 20260304


def test_default_calendar_bounds(spark):
    first, last = calendar_bounds(F.lit(date(2026, 7, 1)))
    row = spark.range(1).select(first.alias("a"), last.alias("b")).first()
    assert tuple(row) == (date(2021, 1, 2), date(2031, 1, 2))


def test_stamps(spark):
    assert run_stamp(datetime(2026, 1, 2, 3, 4, 5)) == "20260102_030405"
    df = spark.createDataFrame(
        [("/x/repartitioned_20260102_030405/p",), ("/x/repartitioned_20269902_030405/p",), ("/x/other",)], "p string")
    stamps = [r["s"] for r in df.select(stamp_in_path("p").cast("timestamp_ntz").alias("s")).collect()]
    assert stamps == [datetime(2026, 1, 2, 3, 4, 5), None, None]


def test_partitions_follow_the_shuffled_size():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(100 * 10**12) == 745_059
