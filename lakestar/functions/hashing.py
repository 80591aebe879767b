"""Change hashes and surrogate keys, built from Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "~"
KEY_SEPARATOR = "\x1f"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(*columns: str | Column) -> Column:
    """SHA-256 over the text of the columns, in the given order.

    Each value is written as ``<length>:<text>`` and a null as ``~``, so no two different rows share
    a text: ``('ab', 'c')`` differs from ``('a', 'bc')`` and null differs from the empty string.
    """
    parts = []
    for column in columns:
        text = _column(column).cast("string")
        parts.append(
            F.when(text.isNull(), F.lit(NULL_MARK)).otherwise(
                F.concat(F.length(text).cast("string"), F.lit(":"), text)
            )
        )
    return F.sha2(F.concat(*parts), 256)


def surrogate_key(*natural: str | Column, source: str, separator: str | None = None) -> Column:
    """Durable entity key: SHA-256 of the natural key followed by the source system.

    A single natural key needs no separator, since the source system is a constant suffix. A
    composite key is separated by default. A null natural key gives a null surrogate key.
    """
    if separator is None:
        separator = "" if len(natural) == 1 else KEY_SEPARATOR
    if not separator and len(natural) > 1:
        raise ValueError("a composite natural key needs a separator")
    parts: list[Column] = []
    for column in natural:
        parts += [_column(column).cast("string"), F.lit(separator)]
    return F.sha2(F.concat(*parts, F.lit(source)), 256)


def version_key(entity_key: str | Column, valid_from: str | Column) -> Column:
    """Key of one version of an entity: the durable key plus the start of validity.

    An instant is written in UTC, whatever the session's time zone; a time without a zone as it is.
    """
    start = _column(valid_from)
    in_utc = F.to_utc_timestamp(start, F.current_timezone())
    start = F.when(F.typeof(start) == "timestamp", in_utc).otherwise(start)
    stamp = F.date_format(start, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.sha2(F.concat(_column(entity_key), F.lit(KEY_SEPARATOR), stamp), 256)
