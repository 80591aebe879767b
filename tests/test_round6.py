"""Jobs in less time: records are built once, stored without vain dictionaries, and cut into even tasks."""

import glob
import gzip
import os
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakestar.plans import extract, gold, queries
from lakestar.plans.extract import run_extract
from lakestar.plans.fixture_data import pages
from lakestar.plans.layout import Layout
from lakestar.session import SCAN_BYTES, SORTED_SCAN_BYTES
from lakestar.sources.pages import PAGES
from lakestar.sources.writers import export_documents, land_snapshot
from tests.conftest import T0, T1
from tests.test_jobs import _write


def test_pages_are_built_in_their_types_without_casts_of_records(spark, sf):
    built = pages(spark, sf)
    declared = spark.createDataFrame([], PAGES).schema
    assert built.schema.simpleString() == declared.simpleString()
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(struct" not in plan and "cast(array(struct" not in plan and "cast(if" not in plan


def test_items_and_staged_songs_have_no_dictionaries(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    run_extract(spark, _write(tmp_path / "one", False), layout, T0, "web")
    for folder in (f"{layout.raw}/items", f"{layout.staged}/songs"):
        files = [f for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)]
        groups = [pq.ParquetFile(f).metadata.row_group(0) for f in files if pq.ParquetFile(f).metadata.num_row_groups]
        columns = [g.column(i) for g in groups for i in range(g.num_columns)]
        assert columns and all(not c.has_dictionary_page and c.compression == "ZSTD" for c in columns)


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_gzip_files_are_written_at_the_fast_level(spark, tmp_path, kind):
    rows = spark.range(20_000).select(F.concat(F.lit("http://track/"), F.col("id") * 7919 % 20_011).alias("url"), "id").coalesce(1)
    if kind == "csv":
        path, count = land_snapshot(rows, str(tmp_path), "tracks", T0, compression="gzip")
        assert count == 20_000
    else:
        path = export_documents(rows, str(tmp_path / "documents"), T0, compression="gzip")
    file, = glob.glob(f"{path}/part-*.gz")
    text = gzip.open(file, "rb").read()
    assert text.count(b"\n") == 20_000 + (kind == "csv")
    fast, usual = (len(zlib.compress(text, level)) for level in (1, 6))
    assert abs(os.path.getsize(file) - fast) < abs(os.path.getsize(file) - usual)


def test_made_pages_are_cut_into_files(spark, sf, tmp_path, monkeypatch):
    seen = {}

    def counted(spark, source, *rest):
        files = glob.glob(f"{source}/part-*")
        seen["rows"] = [sum(1 for _ in gzip.open(f)) for f in files]
        return real(spark, source, *rest)

    real = queries.run_extract
    monkeypatch.setattr(queries, "run_extract", counted)
    monkeypatch.setattr(queries, "PAGES_PER_FILE", 100)
    queries._extract(spark, sf, str(tmp_path / "pages"), Layout(str(tmp_path / "lake")), T0)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert sum(seen["rows"]) == lines and max(seen["rows"]) == 100


def test_gold_reads_silver_in_small_scans(spark, sf, monkeypatch):
    seen = []

    def staged(silver, *rest):
        seen.append(int(spark.conf.get(SCAN_BYTES)))
        return real(silver, *rest)

    real = gold.dimension_scd2
    monkeypatch.setattr(gold, "dimension_scd2", staged)
    layout = queries._lake(spark, sf, 2)
    before = spark.conf.get(SCAN_BYTES)
    gold.run_gold(spark, layout, T1, "src")
    assert len(seen) == 2 and max(seen) <= 2 * SORTED_SCAN_BYTES and spark.conf.get(SCAN_BYTES) == before


def test_pages_are_read_in_small_scans(spark, sf, tmp_path, monkeypatch):
    pages(spark, sf).repartition(20).write.json(f"{tmp_path}/pages", compression="gzip")
    monkeypatch.setattr(extract, "SORTED_SCAN_BYTES", 1 << 20)
    layout = Layout(str(tmp_path / "lake"))
    run_extract(spark, f"{tmp_path}/pages", layout, T0, "web")
    # A task reads one of the small files, not as many as the session's scans hold.
    assert len(glob.glob(f"{layout.raw}/items/*/part-*")) == 20
