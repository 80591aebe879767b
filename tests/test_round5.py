"""Jobs that hold little on disk: shuffle files and made input go when they are used, narrow rows are shuffled."""

import glob
import gzip
import json
import os

from pyspark.sql import functions as F

from lakestar.contracts import STAGED_ALBUMS
from lakestar.plans import gold, silver
from lakestar.plans.extract import run_extract
from lakestar.plans.gold import load_fact, run_export, run_gold
from lakestar.plans.layout import Layout
from lakestar.plans.queries import QUERIES
from lakestar.plans.silver import merge_landing, run_silver
from lakestar.sources.tables import table_read
from lakestar.sources.writers import land_snapshot
from tests.conftest import T0, T1
from tests.test_jobs import _write


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def _lake(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    before = _shuffle_files(spark)
    run_extract(spark, _write(tmp_path / "one", False), layout, T0, "web")
    run_silver(spark, layout, T0)
    run_gold(spark, layout, T0, "src")
    return layout, _shuffle_files(spark) - before


def test_jobs_leave_no_shuffle_files_and_documents_are_compressed(spark, tmp_path):
    layout, left = _lake(spark, tmp_path)
    assert not left
    paths = run_export(spark, layout, T1)
    for name, rows in (("artists", 4), ("tracks", 3), ("track_plays", 3)):
        files = glob.glob(f"{paths[name]}/part-*")
        assert files and all(f.endswith(".json.gz") for f in files)
        lines = [line for f in files for line in gzip.open(f, "rt")]
        assert len(lines) == rows and all("last_updated" in json.loads(line) for line in lines)


def test_fact_is_joined_by_natural_keys(spark, tmp_path, monkeypatch):
    layout, _ = _lake(spark, tmp_path)
    seen = {}

    def joined(rows, lookups, *rest, **more):
        for lookup in lookups:
            seen[lookup.key] = lookup.rows.select(F.max(F.length(lookup.key))).first()[0]
        return real(rows, lookups, *rest, **more)

    real = gold.snapshot_fact
    monkeypatch.setattr(gold, "snapshot_fact", joined)
    load_fact(spark, layout, T1, "src")
    assert all(n < 64 for n in seen.values()) and set(seen) == {"artist_key", "album_key"}
    fact = table_read(spark, f"{layout.gold}/fact_track_plays")
    tracks = table_read(spark, f"{layout.silver}/tracks").select("track_id", "artist_id", "album_id")
    expected = {tuple(r) for r in tracks.select(*(F.sha2(F.concat(c, F.lit("src")), 256) for c in tracks.columns)).collect()}
    assert {tuple(r) for r in fact.select("track_key", "artist_key", "album_key").collect()} == expected


def test_albums_are_sorted_without_their_paths(spark, tmp_path, monkeypatch):
    layout, sorted_columns = Layout(str(tmp_path / "lake")), []

    def latest(rows, contract):
        sorted_columns.append(rows.columns)
        return real(rows, contract)

    real = silver.stage_latest
    monkeypatch.setattr(silver, "stage_latest", latest)
    row = ("k", "name", "1999", "3", "u", "a")
    names = ["album_id", "name", "release_date", "total_tracks", "url", "artist_id"]
    for folder in ("b é", "a {x}"):
        frame = spark.createDataFrame([row, ("of " + folder, *row[1:])], names).withColumn("extraction_date", F.lit(T0.isoformat()))
        land_snapshot(frame, f"{layout.staged}/albums", folder, T0)
    found = merge_landing(spark, f"{layout.staged}/albums", STAGED_ALBUMS, layout, "albums", T0)
    assert found["inserted"] == 3 and all("source_file" not in c for c in sorted_columns)
    stored = table_read(spark, f"{layout.silver}/albums").select("album_id", "source_file").collect()
    assert all(p.startswith("file:") for _, p in stored)
    folders = {key: p.split("/")[-2] for key, p in stored}
    # Equal rows are told apart by their paths as before: the last one stays.
    assert folders["k"] == folders["of b é"] != folders["of a {x}"]


def test_queries_remove_the_pages_that_they_made(spark, sf):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    QUERIES["silver_albums"](spark, sf).count()
    made = [f"{root}/{n}" for n in set(os.listdir(root)) - before]
    assert made and not [f for m in made for f in glob.glob(f"{m}/pages/**/part-*", recursive=True)]
