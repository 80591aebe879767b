"""Reading landing folders: several formats, one declared contract, provenance per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestar.contracts import Contract
from lakestar.functions.dates import STAMPED_FOLDER, stamp_of_name
from lakestar.operators.projection import canonicalize, enforce_contract, misfits, union_by_name
from lakestar.sources.files import matching_paths

FORMATS = ("csv", "json", "parquet")
# Endings of the data files of each format.
ENDINGS = {"csv": ("csv", "csv.gz"), "json": ("json",), "parquet": ("parquet",)}
SOURCE_FILE = "source_file"
CORRUPT = "corrupt_record"
MISFITS = "misfits"
PROBLEM = "problem"
SUCCESS = "_SUCCESS"

# Quotes are doubled and fields may hold newlines; blanks around a value belong to the value.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# An empty cell is null and a quoted empty text stays a text, as the writer tells them apart.
CSV_READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\x00"}


def file_glob(*formats: str) -> str:
    """The pattern of the names of data files."""
    return "*.{" + ",".join(ending for fmt in formats for ending in ENDINGS[fmt]) + "}"


def landing_files(spark: SparkSession, folder: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """(path, modified, length) of every data file below a folder, without reading any content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_glob(*formats))
        .load(folder)
    )
    # Scans are cut by file lengths, though no content is read: a listing needs no more tasks than cores.
    listed = files.select("path", F.col("modificationTime").alias("modified"), "length")
    return listed.coalesce(spark.sparkContext.defaultParallelism)


def present_formats(spark: SparkSession, folder: str) -> list[str]:
    """The formats that have at least one file: one file per format is looked at."""
    return [f for f in FORMATS if landing_files(spark, folder, (f,)).select("path").take(1)]


def latest_snapshot(
    spark: SparkSession, base: str, pattern: str = STAMPED_FOLDER, *, committed: bool = True
) -> str | None:
    """The newest stamped folder directly below ``base``, or None.

    Folders are listed through the file system, no job runs. A folder counts once its job has written
    ``_SUCCESS``; with ``committed`` off, for writers that leave no such mark, once it holds a Parquet
    file, directly or in a partition folder. Folders without a valid stamp are ignored.
    """
    marks = [SUCCESS] if committed else ["*.parquet", "*=*/*.parquet"]
    found = set()
    for mark in marks:
        for path in matching_paths(spark, f"{base}/*/{mark}"):
            folder = path.getParent() if mark.count("/") == 0 else path.getParent().getParent()
            stamp = stamp_of_name(folder.getName(), pattern)
            if stamp is not None:
                found.add((stamp, folder.toString()))
    return max(found)[1] if found else None


def _reader(spark: SparkSession, fmt: str, skip_unreadable: bool) -> DataFrameReader:
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_glob(fmt))
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
    )


def read_csv_contract(
    spark: SparkSession, path: str | list[str], contract: Contract, *, multi_line: bool = True,
    skip_unreadable: bool = False, corrupt: bool = False,
) -> DataFrame:
    """CSV with a header, every column read as text under its source name.

    Types are never inferred, so ``007`` stays ``007``. The header of each file is checked against
    the contract. ``multi_line`` keeps quoted newlines but reads each file in one task; switch it
    off for large files known to have none.
    """
    schema = _with_corrupt(contract.text_schema(), corrupt)
    reader = _reader(spark, "csv", skip_unreadable).options(**CSV_READ_OPTIONS)
    reader = reader.option("multiLine", str(multi_line).lower()).option("enforceSchema", "false")
    return with_source_file(reader.option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path))


def read_json_contract(
    spark: SparkSession, path: str | list[str], contract: Contract, *, skip_unreadable: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """JSON lines, every declared field read as text; source and canonical names are both accepted."""
    schema = contract.text_schema()
    for canonical in contract.renames.values():
        schema = schema.add(canonical, "string")
    reader = _reader(spark, "json", skip_unreadable).option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(_with_corrupt(schema, corrupt)).json(path)
    for original, canonical in contract.renames.items():
        df = df.withColumn(canonical, F.coalesce(canonical, original)).drop(original)
    return with_source_file(df)


def read_parquet_contract(
    spark: SparkSession, path: str | list[str], contract: Contract, *, skip_unreadable: bool = False
) -> DataFrame:
    """Parquet with the files' own types; the contract is enforced afterwards."""
    paths = [path] if isinstance(path, str) else path
    return with_source_file(_reader(spark, "parquet", skip_unreadable).parquet(*paths))


def _with_corrupt(schema: StructType, corrupt: bool) -> StructType:
    return schema.add(CORRUPT, "string") if corrupt else schema


READERS = {"csv": read_csv_contract, "json": read_json_contract, "parquet": read_parquet_contract}


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the path of the file each row was read from."""
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_landing(
    spark: SparkSession, folder: str, contract: Contract, fmt: str, *, skip_unreadable: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """All files of one format below a folder, in the contract's types, with their source file."""
    options = {"multi_line": multi_line} if fmt == "csv" else {}
    df = READERS[fmt](spark, folder, contract, skip_unreadable=skip_unreadable, **options)
    return enforce_contract(df, contract, keep=[SOURCE_FILE])


def landing_union(
    spark: SparkSession, folder: str, contract: Contract, *, skip_unreadable: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """All files of all formats below a folder as one frame: one scan per format, not per file.

    An unreadable file fails the job unless ``skip_unreadable`` is set, which leaves out the rest
    of a corrupt file and logs a warning.
    """
    return union_by_name(*(
        read_landing(spark, folder, contract, f, skip_unreadable=skip_unreadable, multi_line=multi_line)
        for f in _formats_of(spark, folder)
    ))


def _formats_of(spark: SparkSession, folder: str) -> list[str]:
    formats = present_formats(spark, folder)
    if not formats:
        raise FileNotFoundError(f"no landing files below {folder}")
    return formats


def with_problem(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows in the contract's types with their source file and what is wrong with them.

    ``problem`` is ``corrupt`` for a record that does not parse, ``no key`` for a row without a complete
    key, ``misfit`` for a row with values that do not fit their types, which are null and listed in
    ``misfits``, else ``none``.
    """
    df = canonicalize(df, contract.renames)
    if CORRUPT not in df.columns:
        df = df.withColumn(CORRUPT, F.lit(None).cast("string"))
    df = df.withColumn(MISFITS, misfits(df, contract))
    rows = enforce_contract(df, contract, keep=[SOURCE_FILE, CORRUPT, MISFITS])
    keyless = F.concat(*(F.col(k).cast("string") for k in contract.keys)).isNull()
    problem = F.when(F.col(CORRUPT).isNotNull(), "corrupt").when(keyless, "no key")
    return rows.withColumn(PROBLEM, problem.when(F.col(MISFITS).isNotNull(), "misfit").otherwise("none"))


def checked_landing(
    spark: SparkSession, folder: str, contract: Contract, formats: Sequence[str] = ()
) -> DataFrame:
    """`landing_union` that keeps every record and tells what is wrong with it, see `with_problem`."""
    return checked_files(spark, {fmt: [folder] for fmt in formats or _formats_of(spark, folder)}, contract)


def checked_files(spark: SparkSession, paths: Mapping[str, list[str]], contract: Contract) -> DataFrame:
    """`checked_landing` of the named files or folders of each format."""
    frames = []
    for fmt, some in paths.items():
        options = {} if fmt == "parquet" else {"corrupt": True}
        frames.append(with_problem(READERS[fmt](spark, some, contract, **options), contract))
    return union_by_name(*frames)


def corrupt_rows(spark: SparkSession, folder: str, contract: Contract) -> DataFrame:
    """(corrupt_record, source_file) of the CSV and JSON records that do not parse."""
    bad = []
    for fmt in present_formats(spark, folder):
        if fmt != "parquet":
            df = READERS[fmt](spark, folder, contract, corrupt=True)
            # Spark refuses to read the corrupt column alone, so the filter looks at the others too.
            others = F.length(F.concat_ws("", *(c for c in df.columns if c not in (CORRUPT, SOURCE_FILE))))
            bad.append(df.filter(F.col(CORRUPT).isNotNull() & (others >= 0)).select(CORRUPT, SOURCE_FILE))
    if not bad:
        return spark.createDataFrame([], f"{CORRUPT} string, {SOURCE_FILE} string")
    return union_by_name(*bad)
