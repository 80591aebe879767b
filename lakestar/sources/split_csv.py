"""CSV with quoted newlines, read by many tasks per file.

Spark reads such files whole, one task each, since a newline may lie inside quotes. Here every task reads a
byte range as lines. Whether a line begins inside quotes follows from the parity of the quotes before it: counted
within each range, and added up over the ranges of a file, of which there is one row each. Lines that begin
outside of quotes begin a record; the few records that cross a range are put together from both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.contracts import Contract
from lakestar.sources.landing import CORRUPT, CSV_READ_OPTIONS, SOURCE_FILE, file_glob

RANGE, LINE, RECORD = "__range", "__line", "__record"
PART = [SOURCE_FILE, RANGE]


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``source_file, __range, __record, record``: the text of every CSV record, header and blank ones included.

    Quotes are doubled inside quotes, so every quote flips the state. The lines are shuffled once, by range,
    and only the pieces of records that cross ranges a second time; ranges are as long as Spark's splits of
    the files. A record is in one task, so it may not outgrow a task's memory, but a file may.
    """
    lines = (
        spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").option("pathGlobFilter", file_glob("csv")).text(path)
        .select(F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias(RANGE),
                F.monotonically_increasing_id().alias(LINE), "value")
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    order = Window.partitionBy(*PART).orderBy(LINE)
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("quotes", quotes)
    lines = lines.withColumn("odd", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)))
    # Records begun so far, if the range itself begins outside of quotes, or inside.
    lines = lines.withColumn("outside", F.count_if(F.col("odd") == 0).over(upto))
    lines = lines.withColumn("inside", F.count_if(F.col("odd") == 1).over(upto))
    lines = lines.join(_ranges(lines), PART, "left")
    lines = lines.withColumn(RECORD, F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside")))
    texts = F.transform(F.array_sort(F.collect_list(F.struct(LINE, "value"))), lambda x: x["value"])
    pieces = lines.groupBy(*PART, RECORD, "owner").agg(F.array_join(texts, "\n").alias("piece"))
    whole = pieces.filter(F.col(RECORD) > 0).drop("owner")
    # What a range holds before its first record belongs to the last record of a range before.
    tails = F.transform(F.array_sort(F.collect_list(F.struct(RANGE, "piece"))), lambda x: x["piece"])
    rest = pieces.filter((F.col(RECORD) == 0) & F.col("owner").isNotNull()).groupBy(
        SOURCE_FILE, F.col("owner.range").alias("__of"), F.col("owner.record").alias("__number")).agg(
        F.array_join(tails, "\n").alias("tail")).withColumnRenamed(SOURCE_FILE, "__file")
    on = (F.col(SOURCE_FILE) == F.col("__file")) & (F.col(RANGE) == F.col("__of")) & (F.col(RECORD) == F.col("__number"))
    return whole.join(rest, on, "left").select(
        *PART, RECORD, F.concat_ws("\n", "piece", "tail").alias("record"))


def _ranges(lines: DataFrame) -> DataFrame:
    """Per range: whether it begins inside quotes, and the record that its first lines go on with."""
    ranges = lines.groupBy(*PART).agg(
        F.sum("quotes").alias("quotes"), F.max("outside").alias("outside"), F.max("inside").alias("inside"))
    order = Window.partitionBy(SOURCE_FILE).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("quotes").over(order), F.lit(0)), F.lit(2)) == 1
    ranges = ranges.withColumn("begins_inside", inside)
    begun = F.when(F.col("begins_inside"), F.col("inside")).otherwise(F.col("outside"))
    last = F.when(begun > 0, F.struct(F.col(RANGE).alias("range"), begun.alias("record")))
    return ranges.withColumn("owner", F.last(last, ignorenulls=True).over(order)).select(*PART, "begins_inside", "owner")


def read_csv_split(
    spark: SparkSession, path: str | list[str], contract: Contract, *, corrupt: bool = False
) -> DataFrame:
    """`read_csv_contract` with quoted newlines, by as many tasks as the files have splits.

    Files are UTF-8 and have a header, whose names are checked against the contract. Blank lines between
    records are skipped, and records may end in ``\\r\\n``.
    """
    names = contract.text_schema().names
    # An unread field of a malformed record is null, with its text aside, as Spark's reader does it.
    parsed_as = contract.text_schema().add(CORRUPT, "string")
    options = {k: v for k, v in CSV_READ_OPTIONS.items() if k != "header"}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    records = csv_records(spark, path)
    record = F.regexp_replace("record", "\r$", "")
    records = records.withColumn("record", record).filter(F.length("record") > 0)
    parsed = records.withColumn("row", F.from_csv("record", parsed_as.simpleString()[7:-1].replace(":", " "), options))
    header = (F.col(RANGE) == 0) & (F.col(RECORD) == 1)
    same = F.lower(F.concat_ws("\x1f", *(F.col("row")[n] for n in names))) == "\x1f".join(names).lower()
    wrong = F.raise_error(F.concat(F.lit("CSV header does not fit the contract's columns: "), SOURCE_FILE))
    rows = parsed.filter(F.when(header, F.when(same, F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(F.lit(True)))
    kept = [*names, CORRUPT] if corrupt else names
    return rows.select(*(F.col("row")[n].alias(n) for n in kept), SOURCE_FILE)
