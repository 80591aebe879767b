"""One row per key.

All three forms keep ``row_number() = 1`` over a total order. Catalyst turns that into a
WindowGroupLimit on both sides of the shuffle, so every map task sends at most one row per key: a key
that holds a third of the table arrives as one row per map task, not as a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

ROW = "__row"


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(ROW, F.row_number().over(window)).filter(F.col(ROW) == 1).drop(ROW)


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> list[Column]:
    """The order extended by all remaining columns, so that equal rows are the only ties."""
    return [*order, *(F.col(c).desc_nulls_last() for c in orderable_columns(df, keys))]


def orderable_columns(df: DataFrame, besides: Sequence[str]) -> list[str]:
    """The columns that Spark can sort by, without those named."""
    return [f.name for f in df.schema.fields if f.name not in besides and _orderable(f.dataType)]


def _orderable(data_type: DataType) -> bool:
    """Whether Spark can sort by the type: maps and variants have no order, on any level."""
    if isinstance(data_type, StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, (MapType, VariantType))


def dedup_latest(
    df: DataFrame, keys: Sequence[str], latest: Sequence[str], tiebreak: Sequence[Column] | None = None
) -> DataFrame:
    """The newest row of every key by the ``latest`` columns.

    Rows of one extract share their extraction time, so ties are usual. They are broken by
    ``tiebreak`` or else by all remaining columns, which makes the survivor independent of input
    order and partitioning.
    """
    order = [F.col(c).desc_nulls_last() for c in latest]
    if tiebreak is None:
        return one_per_key(df, keys, total_order(df, [*keys, *latest], order))
    return one_per_key(df, keys, [*order, *tiebreak])


def dedup_first_seen(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """The row of every key that comes first by position."""
    order = [F.col(c).asc_nulls_last() for c in position]
    return one_per_key(df, keys, total_order(df, [*keys, *position], order))


def dedup_last_batch(
    df: DataFrame, keys: Sequence[str], batch: Sequence[str], position: Sequence[str]
) -> DataFrame:
    """The first row of every key inside the last batch that holds the key.

    This is first-seen within each batch followed by later batches overwriting earlier ones, done
    in one pass.
    """
    order = [F.col(c).desc_nulls_last() for c in batch]
    order += [F.col(c).asc_nulls_last() for c in position]
    return one_per_key(df, keys, total_order(df, [*keys, *batch, *position], order))


def first_n_unique(df: DataFrame, keys: Sequence[str], position: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` distinct keys in order of first appearance."""
    first = dedup_first_seen(df, keys, position)
    return first.orderBy(*[F.col(c).asc_nulls_last() for c in (*position, *keys)]).limit(n)
