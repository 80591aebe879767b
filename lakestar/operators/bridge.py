"""Bridge tables: many-to-many relations of a fact's entity, with weights that let measures add up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEMBERS, POSITION = "n_members", "position"


def bridge_table(pairs: DataFrame, entity: str, member: str) -> DataFrame:
    """(entity, member, position, n_members, weight), one row per distinct pair without a null.

    ``position`` numbers the members of an entity from 0 in their order, ``weight`` is one over their number.
    Pairs are made distinct before the shuffle, so an entity that occurs in very many rows arrives once
    per map task and member.
    """
    distinct = pairs.select(entity, member).filter(F.col(entity).isNotNull() & F.col(member).isNotNull()).distinct()
    own = Window.partitionBy(entity)
    return distinct.select(
        entity, member, (F.row_number().over(own.orderBy(member)) - 1).alias(POSITION),
        F.count(F.lit(1)).over(own).alias(MEMBERS)).withColumn("weight", F.lit(1.0) / F.col(MEMBERS))


def allocated(measure: str) -> Column:
    """The share of an integer measure that falls to a row of a bridge.

    The measure is divided without a fraction and the remainder goes to the first members, one each, so the
    shares of an entity add up to its measure exactly.
    """
    rest = f"pmod(`{measure}`, {MEMBERS})"
    return F.expr(f"(`{measure}` - {rest}) div {MEMBERS} + CASE WHEN {POSITION} < {rest} THEN 1 ELSE 0 END")


def through_bridge(
    rows: DataFrame, bridge: DataFrame, entity: str, member: str, measures: Sequence[str]
) -> DataFrame:
    """Totals of the measures per member, their sum over all members unchanged.

    Rows are added up per entity first, so the join with the bridge has one row per entity and
    pair, however many rows an entity has. What belongs to no member is in a row whose member is null.
    """
    totals = rows.groupBy(entity).agg(*(F.sum(m).cast("bigint").alias(m) for m in measures))
    joined = totals.join(bridge.select(entity, member, POSITION, MEMBERS), entity, "left")
    shares = [F.when(F.col(member).isNull(), F.col(m)).otherwise(allocated(m)).alias(m) for m in measures]
    return joined.select(member, *shares).groupBy(member).agg(*(F.sum(m).alias(m) for m in measures))
