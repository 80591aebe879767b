"""Extracts that write little: compressed snapshots, items straight from the pages, staging without a shuffle."""

import json
import os

from pyspark.sql import functions as F

from lakestar.contracts import Contract
from lakestar.plans.extract import run_extract
from lakestar.plans.layout import Layout
from lakestar.plans.queries import QUERIES
from lakestar.plans.silver import run_silver
from lakestar.sources.landing import landing_files, read_landing
from lakestar.sources.ledger import NewFiles
from lakestar.sources.pages import corrupt_pages, read_pages
from lakestar.sources.split_csv import read_csv_split
from lakestar.sources.tables import table_read
from lakestar.sources.writers import land_snapshot, stage_clustered
from tests.conftest import T0, T1

NOTE = Contract("notes", "id string, note string", keys=("id",))


def _page(number, popularity=1):
    album = {"id": f"al{number}", "name": 'an "album"\nof two lines', "release_date": "1999", "total_tracks": 1}
    track = {"id": f"t{number}", "name": "n", "duration_ms": 1, "popularity": popularity, "album": album,
             "artists": [{"id": "a1", "name": "a", "external_urls": {"web": "u"}}]}
    return {"playlist_id": "p", "playlist_position": number, "page_offset": 0,
            "items": [{"added_at": "2020-01-02T00:00:00Z", "track": track}, {"added_at": "", "track": None}]}


def _files(folder):
    return [n for _, _, names in os.walk(folder) for n in names if n.startswith("part-")]


def test_extract_lands_compressed_and_writes_the_pages_once(spark, tmp_path):
    source, layout = tmp_path / "pages", Layout(str(tmp_path / "lake"))
    source.mkdir()
    misfit = json.dumps(_page(3, popularity="high"))
    lines = [json.dumps(_page(1)), misfit, json.dumps(_page(2))[:-3], json.dumps(_page(4))]
    (source / "a.json").write_text("\n".join(lines))
    metrics = {(r.step, r.metric): r.value for r in run_extract(spark, str(source), layout, T0, "web").collect()}
    assert (metrics["pages", "read"], metrics["pages", "rejected"]) == (4, 2)
    assert not os.path.exists(f"{layout.raw}/pages")
    for folder in (f"{layout.raw}/songs", f"{layout.raw}/albums", f"{layout.staged}/albums"):
        names = _files(folder)
        assert names and all(n.endswith(".csv.gz") for n in names)
    items = spark.read.parquet(f"{layout.raw}/items/*")
    assert sorted(r[0] for r in items.select("track.id").collect()) == ["t1", "t4"]
    rejected = spark.read.parquet(f"{layout.rejected}/pages/*")
    assert sorted(r[0] for r in rejected.select("corrupt_record").collect()) == sorted(lines[1:3])
    assert all(r[0].endswith("a.json") for r in rejected.select("source_file").collect())
    run_silver(spark, layout, T1)
    albums = table_read(spark, f"{layout.silver}/albums")
    assert sorted(map(tuple, albums.select("album_id", "name").collect())) == [
        (f"al{n}", 'an "album"\nof two lines') for n in (1, 4)]
    assert table_read(spark, f"{layout.silver}/tracks").count() == 2


def test_corrupt_pages_look_at_every_field(spark, tmp_path):
    bad = json.dumps(_page(3, popularity="high"))
    (tmp_path / "a.json").write_text("\n".join([json.dumps(_page(1)), bad]))
    read = read_pages(spark, str(tmp_path)).withColumn("source_file", F.lit("f"))
    assert [r.corrupt_record for r in corrupt_pages(read).collect()] == [bad]


def test_compressed_snapshots_are_listed_and_read_like_plain_ones(spark, tmp_path):
    data = [("1", 'a "quoted"\nline'), ("2", ""), ("3", None), ("4", "a,b")]
    rows = spark.createDataFrame(data, NOTE.ddl).coalesce(1)
    path, count = land_snapshot(rows, str(tmp_path), "notes", T0, compression="gzip")
    plain, _ = land_snapshot(rows, str(tmp_path), "notes", T1)
    assert count == 4
    assert landing_files(spark, path, ("csv",)).count() == landing_files(spark, plain, ("csv",)).count() == 1
    found = NewFiles(spark, str(tmp_path / "notes"), str(tmp_path / "ledger")).by_format()
    assert set(found) == {"csv"} and len(found["csv"]) == 2
    for folder in (path, plain):
        assert sorted(map(tuple, read_landing(spark, folder, NOTE, "csv").select("id", "note").collect())) == data
        assert sorted(map(tuple, read_csv_split(spark, folder, NOTE).select("id", "note").collect())) == data


def test_clustered_staging_does_not_shuffle(spark, tmp_path):
    rows = spark.range(0, 400, 1, 4).select(F.lit("hot").alias("k"), "id")
    path, count = stage_clustered(rows, str(tmp_path), "k", T0)
    assert count == spark.read.parquet(path).count() == 400
    # One key, hence one bucket, is written by all four tasks.
    assert len(_files(path)) == 4 and len([n for n in os.listdir(path) if n.startswith("bucket=")]) == 1


def test_split_csv_input_is_written_by_all_tasks(spark, tmp_path):
    data = [(n, f"u{n}", f'<a href="x">\n{n}') for n in range(8)]
    spark.createDataFrame(data, "page_id bigint, url string, html string").repartition(4).write.parquet(
        str(tmp_path / "pages.parquet"))
    read = QUERIES["read_csv_split"](spark, str(tmp_path))
    assert sorted(map(tuple, read.collect())) == data
    assert len(read.inputFiles()) > 1
