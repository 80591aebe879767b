"""Date and run-stamp expressions."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of run stamps and of the folders that carry them.
STAMP_FORMAT = "yyyyMMdd_HHmmss"
STAMP_PYTHON_FORMAT = "%Y%m%d_%H%M%S"
STAMPED_FOLDER = r"repartitioned_(\d{8}_\d{6})"
# A date given to the year, the month or the day; a time of day may follow a full date.
PARTIAL_DATE = r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2}([ T].*)?)?)?$"


def parse_partial_date(text: str | Column, as_type: str = "timestamp") -> Column:
    """Timestamp of ``yyyy``, ``yyyy-MM``, ``yyyy-MM-dd`` or a full timestamp text, else null.

    Missing parts default to the first month or day. Year ``0000`` is how sources write an unknown
    date and gives null, as does any other text.
    """
    column = F.col(text) if isinstance(text, str) else text
    trimmed = F.trim(column)
    known = trimmed.rlike(PARTIAL_DATE) & ~trimmed.startswith("0000")
    return F.when(known, trimmed).try_cast(as_type)


def date_precision(text: str | Column) -> Column:
    """``year``, ``month`` or ``day`` for a text that `parse_partial_date` accepts, else null."""
    column = F.col(text) if isinstance(text, str) else text
    length = F.length(F.trim(column))
    precision = F.when(length == 4, "year").when(length == 7, "month").otherwise("day")
    return F.when(parse_partial_date(column).isNotNull(), precision)


def date_key(day: str | Column) -> Column:
    """Integer key ``yyyyMMdd`` of a date."""
    return F.date_format(F.col(day) if isinstance(day, str) else day, "yyyyMMdd").cast("int")


def run_stamp(as_of: datetime) -> str:
    """Text stamp of a run, as used in snapshot folder names."""
    return as_of.strftime(STAMP_PYTHON_FORMAT)


def stamp_in_path(path: str | Column, pattern: str = STAMPED_FOLDER) -> Column:
    """Run stamp found in a path as a timestamp; null where no valid stamp is present."""
    column = F.col(path) if isinstance(path, str) else path
    found = F.regexp_extract(column, pattern, 1)
    return F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit(STAMP_FORMAT))


def stamp_of_name(name: str, pattern: str = STAMPED_FOLDER) -> datetime | None:
    """Run stamp of a folder name; None if it carries no valid one."""
    found = re.fullmatch(pattern, name)
    try:
        return datetime.strptime(found[1], STAMP_PYTHON_FORMAT) if found else None
    except ValueError:
        return None


def calendar_bounds(as_of: str | Column) -> tuple[Column, Column]:
    """First and last day of the default ten-year calendar around a day.

    The calendar starts 5 x 365 days before January 1st of the current year, which is January 2nd
    or 3rd once leap days intervene, and ends ten years after its start.
    """
    column = F.col(as_of) if isinstance(as_of, str) else as_of
    first = F.date_sub(F.make_date(F.year(column), F.lit(1), F.lit(1)), 5 * 365)
    return first, F.add_months(first, 120)
