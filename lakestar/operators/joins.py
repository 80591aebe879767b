"""Look-up joins that stay whole and balanced when a key is hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A look-up side of at most this many narrow rows (tens of MB) is broadcast.
BROADCAST_ROWS = 200_000
# A key with at least this many rows is hot: it is kept out of the shuffle by key.
HOT_ROWS = 2_000_000
# Parts over which the rows of a hot key are spread.
SALTS = 64
# Upper bound on the hot keys that are singled out, the largest first: any further key holds less than a
# 20,000th of all rows, which a shuffle by key deals out as it is.
MAX_HOT_KEYS = 20_000


def count_rows(df: DataFrame) -> int:
    """Row count by a distributed aggregate that reads no columns of a stored table."""
    return df.agg(F.count(F.lit(1)).alias("n")).first()["n"]


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, max_keys: int = MAX_HOT_KEYS
) -> DataFrame:
    """The keys with at least ``hot_rows`` rows, largest first, at most ``max_keys`` of them.

    Counting is a partial aggregate over the key columns only. The result is bounded, so it may be
    broadcast; it only chooses a physical path and never decides which rows appear in a result.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.filter(F.col("__n") >= hot_rows)
    hot = hot.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return hot.orderBy(F.desc("__n"), *keys).limit(max_keys).select(*keys)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a look-up table with unique keys; every row of ``rows`` appears exactly once.

    A look-up whose counted size is within ``broadcast_rows`` is broadcast and nothing is shuffled.
    Beyond that there is one shuffled join by key and salt: rows of hot keys, and rows with a null key,
    which match nothing, are spread over ``SALTS`` salts by a hash of the row, and the look-up rows of the
    hot keys are repeated once per salt. Hot keys are counted beforehand, in ``counted`` if given (the rows
    as they were before other look-ups), so the join itself reads ``rows`` once.
    """
    on = [on] if isinstance(on, str) else list(on)
    added = [c for c in lookup.columns if c not in on]
    columns = [*rows.columns, *added]
    if count_rows(lookup) <= broadcast_rows:
        return rows.join(F.broadcast(lookup), on, "left").select(*columns)
    found = hot_keys(rows if counted is None else counted, on, hot_rows)
    # At most MAX_HOT_KEYS keys: counted once here, not once for each side of the join.
    hot = rows.sparkSession.createDataFrame(found.collect(), found.schema).withColumn("__hot", F.lit(True))
    flagged = rows.join(F.broadcast(hot), on, "left")
    spread = reduce(lambda a, b: a | b, [F.col("__hot").isNotNull(), *(F.col(k).isNull() for k in on)])
    salt = F.pmod(F.xxhash64(*_hashable(rows)), F.lit(SALTS)).cast("int")
    flagged = flagged.withColumn("__salt", F.when(spread, salt).otherwise(F.lit(0)))
    repeated = lookup.join(F.broadcast(hot), on, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.when(F.col("__hot"), F.lit(SALTS - 1)).otherwise(F.lit(0)))))
    return flagged.join(repeated.drop("__hot"), [*on, "__salt"], "left").select(*columns)


def _hashable(df: DataFrame) -> list[str]:
    """The columns of types that Spark can hash."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.typeName() != "variant"]
