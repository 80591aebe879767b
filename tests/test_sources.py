import json
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lakestar.contracts import STAGED_ALBUMS, STAGED_ARTISTS, Contract, declare_table
from lakestar.operators.projection import current_rows
from lakestar.operators.scd import scd2_apply, scd2_initial, with_hash
from lakestar.plans import silver
from lakestar.plans.extract import run_extract
from lakestar.plans.layout import Layout, Metrics
from lakestar.plans.silver import run_silver
from lakestar.session import SCAN_BYTES, SORTED_SCAN_BYTES, scratch_dir, settings, small_scans
from lakestar.sources import landing, pages, tables, writers
from lakestar.streaming.pickup import picked_up, stream_landing
from tests.conftest import T0, T1, T2

NOTE = Contract("notes", "id string, note string", keys=("id",))


def notes(spark, *data):
    return spark.createDataFrame(list(data), NOTE.ddl)


def content(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# --- landing


def test_csv_keeps_quotes_newlines_blanks_zeros_and_nulls(spark, tmp_path):
    data = [("007", 'a "quoted"\nline'), ("1", "  blanks  "), ("2", ""), ("3", None), ("4", "a,b\r\nc\\"), ("5", '"')]
    path, count = writers.land_snapshot(notes(spark, *data), str(tmp_path), "notes", T0)
    assert count == 6
    assert content(landing.read_landing(spark, path, NOTE, "csv"), "id", "note") == sorted(data, key=repr)


def test_csv_with_another_header_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("note,id\nn,1\n")
    with pytest.raises(Exception, match="header|schema"):
        landing.read_csv_contract(spark, str(tmp_path), NOTE).collect()


def test_three_formats_become_one_frame(spark, tmp_path):
    base = str(tmp_path)
    notes(spark, ("1", "c")).write.csv(f"{base}/c", header=True)
    spark.createDataFrame([(2,)], "id int").write.json(f"{base}/j")
    spark.createDataFrame([(3, 4.5, "z")], "id int, note double, other string").write.parquet(f"{base}/p")
    out = landing.landing_union(spark, base, NOTE)
    assert content(out, "id", "note") == [("1", "c"), ("2", None), ("3", "4.5")]
    assert all(r["source_file"].startswith("file:") for r in out.collect())
    assert landing.present_formats(spark, base) == ["csv", "json", "parquet"]


def test_year_only_dates_are_not_numbers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"album_id": "a", "release_date": 1999, "total_tracks": "x"}))
    (tmp_path / "b.json").write_text(json.dumps({"album_id": "b", "release_date": "1999-05", "total_tracks": 3}))
    out = landing.landing_union(spark, str(tmp_path), STAGED_ALBUMS)
    found = [(r["album_id"], r["release_date"].strftime("%Y-%m-%d"), r["total_tracks"]) for r in out.orderBy("album_id").collect()]
    assert found == [("a", "1999-01-01", None), ("b", "1999-05-01", 3)]


def test_unreadable_file_fails_or_is_skipped(spark, tmp_path):
    base = str(tmp_path)
    notes(spark, ("1", "c")).write.parquet(f"{base}/p")
    os.makedirs(f"{base}/q")
    with open(f"{base}/q/z.parquet", "wb") as f:
        f.write(b"not parquet at all")
    with pytest.raises(Exception):
        landing.landing_union(spark, base, NOTE).collect()
    assert content(landing.landing_union(spark, base, NOTE, skip_unreadable=True), "id") == [("1",)]


def test_corrupt_records_are_listed(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1", "note": "n"}\n{"id": \n')
    (tmp_path / "a.csv").write_text("id,note\n1,n\n2,n,surplus\n")
    bad = landing.corrupt_rows(spark, str(tmp_path), NOTE)
    assert bad.count() == 2
    assert content(bad, "corrupt_record") == [("2,n,surplus",), ('{"id": ',)]
    os.makedirs(tmp_path / "none")
    with pytest.raises(FileNotFoundError):
        landing.landing_union(spark, str(tmp_path / "none"), NOTE)


def test_latest_snapshot_ignores_empty_bad_and_unstamped_folders(spark, tmp_path):
    base = str(tmp_path)
    newest, _ = writers.stage_clustered(notes(spark, ("2", "new")), base, "id", T1)
    writers.stage_clustered(notes(spark, ("1", "old")), base, "id", T0)
    os.makedirs(f"{base}/repartitioned_20990101_000000")
    notes(spark, ("3", "bad")).write.parquet(f"{base}/repartitioned_20991399_000000")
    notes(spark, ("4", "bad")).write.parquet(f"{base}/elsewhere")
    found = landing.latest_snapshot(spark, base)
    assert found.endswith(newest)
    assert content(landing.read_landing(spark, found, NOTE, "parquet"), "id") == [("2",)]
    assert landing.latest_snapshot(spark, f"{base}/elsewhere") is None


def test_latest_snapshot_passes_over_a_torn_one(spark, tmp_path):
    base = str(tmp_path)
    kept, _ = writers.stage_clustered(notes(spark, ("1", "old")), base, "id", T0)
    torn, _ = writers.stage_clustered(notes(spark, ("2", "new")), base, "id", T1)
    os.remove(f"{torn}/_SUCCESS")
    assert landing.latest_snapshot(spark, base).endswith(kept)
    assert landing.latest_snapshot(spark, base, committed=False).endswith(torn)


def test_listing_takes_no_more_tasks_than_cores(spark, tmp_path):
    notes(spark, *((str(i), "n") for i in range(40))).repartition(40).write.csv(str(tmp_path / "c"), header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
        listed = landing.landing_files(spark, str(tmp_path))
        assert listed.count() == len([n for n in os.listdir(tmp_path / "c") if n.endswith(".csv")]) > 8
        assert listed.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_checked_rows_tell_what_is_wrong(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n1,7\n2,x\n,3\n4,5,6\n5\n")
    (tmp_path / "b.json").write_text('{"id": "6", "n": 1}\n{"id": \n')
    counted = Contract("counted", "id string, n int", keys=("id",))
    out = landing.checked_landing(spark, str(tmp_path), counted)
    assert content(out, "id", "n", "misfits", "problem")[:4] == sorted(
        [("1", 7, None, "none"), ("2", None, "n=x", "misfit"), ("4", 5, None, "corrupt"), ("5", None, None, "corrupt")], key=repr)
    assert {r["problem"]: r["count"] for r in out.groupBy("problem").count().collect()} == {
        "none": 2, "misfit": 1, "no key": 1, "corrupt": 3}


def test_clustered_staging_keeps_a_key_in_one_bucket(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    path, count = writers.stage_clustered(df, str(tmp_path), "k", T0, buckets=10)
    stored = spark.read.parquet(path)
    assert count == stored.count() == 3000
    assert stored.groupBy("k").agg(F.count_distinct("bucket").alias("n")).filter("n > 1").count() == 0
    assert set(os.listdir(path)) - {"_SUCCESS", "._SUCCESS.crc"} <= {f"bucket={b}" for b in range(10)}


# --- nested pages


def _artist(key, name):
    return {"id": key, "name": name, "external_urls": {"web": f"u/{key}", "api": "no"}}


def test_pages_are_flattened(spark, tmp_path):
    def track(key, album, artists):
        return {"id": key, "name": key, "duration_ms": 1, "popularity": 2, "album": album, "artists": artists}
    album = {"id": "al", "name": "al", "release_date": "1999", "total_tracks": 2, "artists": [_artist("a", "A"), _artist("b", "B")]}
    docs = [
        {"playlist_id": "p0", "playlist_position": 0, "page_offset": 0, "items": [
            {"added_at": "x", "track": track("t1", album, [_artist("a", "first"), _artist("b", "B")])},
            {"added_at": "x", "track": None}, {"added_at": "x"}]},
        {"playlist_id": "p1", "playlist_position": 1, "page_offset": 0, "items": [
            {"added_at": "y", "track": track("t2", None, [])}]},
        {"playlist_id": "p1", "playlist_position": 1, "page_offset": 100, "items": [
            {"added_at": "z", "track": track("t1", {"id": "al2"}, [_artist("a", "second"), _artist("a", "third")])}]},
        {"playlist_id": "p2", "playlist_position": 2, "page_offset": 0, "items": []},
        {"playlist_id": "p3", "playlist_position": 3, "page_offset": 0},
    ]
    (tmp_path / "x.json").write_text("\n".join(json.dumps(d) for d in docs))
    items = pages.flatten_items(pages.read_pages(spark, str(tmp_path)))
    assert items.count() == 3
    artists = pages.flatten_artists(items, "now", "web")
    assert content(artists) == [("a", "second", "u/a", "now"), ("b", "B", "u/b", "now")]
    albums = pages.flatten_albums(items, "now", "web")
    assert content(albums, "album_id", "artist_id", "url") == [("al", "a", None), ("al2", None, None)]
    songs = pages.flatten_songs(items, "now", "web")
    assert content(songs, "song_id", "song_added", "album_id", "artist_id") == [
        ("t1", "x", "al", "a"), ("t1", "z", "al2", "a"), ("t2", "y", None, None)]


# --- stored tables


def test_versions_count_only_when_complete(spark, tmp_path):
    path = str(tmp_path / "t")
    notes(spark, ("9", "torn")).write.parquet(f"{path}/v=1")
    os.remove(f"{path}/v=1/_SUCCESS")
    assert not tables.table_exists(spark, path)
    assert tables.table_overwrite(notes(spark, ("1", "a")), path) == 1
    notes(spark, ("9", "torn")).write.parquet(f"{path}/v=2")
    os.remove(f"{path}/v=2/_SUCCESS")
    assert content(tables.table_read(spark, path)) == [("1", "a")]
    assert tables.table_overwrite(tables.table_read(spark, path), path) == 2
    assert content(tables.table_read(spark, path)) == [("1", "a")]
    for _ in range(3):
        tables.table_overwrite(tables.table_read(spark, path), path)
    assert sorted(d for d in os.listdir(path)) == ["v=4", "v=5"]


def _hashed(spark, *data):
    return with_hash(notes(spark, *data), ["note"])


def test_stored_merge_is_idempotent_and_survives_a_torn_publish(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.scd2_merge(_hashed(spark, ("a", "1"), ("b", "1")), path, ["id"], T0) == {"inserted": 2, "expired": 0}
    change = _hashed(spark, ("a", "2"), ("c", "1"))
    assert tables.scd2_merge(change, path, ["id"], T1) == {"inserted": 2, "expired": 1}
    assert tables.scd2_merge(change, path, ["id"], T2) == {"inserted": 0, "expired": 0}
    merged = content(tables.table_read(spark, path).drop("hash_key"))
    assert merged == [("a", "1", False, T0, T1), ("a", "2", True, T1, None), ("b", "1", True, T0, None), ("c", "1", True, T1, None)]
    # A run that stopped after the history write leaves a state that readers do not see.
    spark.read.parquet(f"{path}/history/v=2").write.parquet(f"{path}/history/v=3")
    assert content(tables.table_read(spark, path).drop("hash_key")) == merged
    assert tables.scd2_merge(_hashed(spark, ("b", "2")), path, ["id"], T2) == {"inserted": 1, "expired": 1}
    after = tables.table_read(spark, path)
    assert after.count() == 5
    assert current_rows(after).groupBy("id").count().filter("count > 1").count() == 0


def test_insert_new_adds_nothing_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.table_insert_new(notes(spark, ("1", "a")), path, ["id"]) == 1
    both = notes(spark, ("1", "changed"), ("2", "b"))
    assert tables.table_insert_new(both, path, ["id"]) == 1
    assert tables.table_insert_new(both, path, ["id"]) == 0
    assert content(tables.table_read(spark, path)) == [("1", "a"), ("2", "b")]
    noted = notes(spark, ("x", "c")).select("note", "id")
    assert tables.insert_new_only(tables.table_read(spark, path), noted, ["id"]).columns == ["note", "id"]


def test_partition_replacement_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "k string, day int")
    assert not tables.table_exists(spark, path)
    tables.replace_partition(days, path, "day")
    assert tables.table_exists(spark, path)
    assert tables.replace_partition(spark.createDataFrame([("c", 2)], "k string, day int"), path, "day") == 1
    assert content(tables.table_read(spark, path)) == [("a", 1), ("b", 1), ("c", 2)]


def test_a_day_can_be_replaced_by_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([("a", 1), ("b", 2)], "k string, day int")
    tables.replace_partition(days, path, "day")
    assert tables.replace_partition(days.filter("day = 3"), path, "day", [2, 3]) == 0
    assert content(tables.table_read(spark, path)) == [("a", 1)]


def test_a_version_cannot_end_before_it_starts(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.scd2_merge(_hashed(spark, ("a", "1")), path, ["id"], T1)
    for as_of in (T1, T0):
        with pytest.raises(Exception, match="does not lie after"):
            tables.scd2_merge(_hashed(spark, ("a", "2")), path, ["id"], as_of)
        target = scd2_initial(_hashed(spark, ("a", "1")), T1)
        with pytest.raises(Exception, match="does not lie after"):
            scd2_apply(target, _hashed(spark, ("a", "2")), ["id"], as_of).collect()
    assert content(tables.table_read(spark, path), "note", "valid_to") == [("1", None)]
    assert tables.scd2_merge(_hashed(spark, ("a", "2")), path, ["id"], T2) == {"inserted": 1, "expired": 1}


def test_documents_are_replaced_and_open_ends_stay_open(spark, tmp_path):
    df = spark.createDataFrame([("a", None, None), (None, None, None)], "id string, valid_from timestamp, valid_to timestamp")
    path = str(tmp_path / "docs")
    for _ in range(2):
        writers.export_documents(df, path, T0, [])
    documents = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert documents == [{"id": "a", "valid_from": None, "valid_to": None}]


def test_declared_table_reads_the_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    notes(spark, ("1", "a")).write.parquet(path)
    assert declare_table(spark, NOTE, path, "declared_notes") == declare_table(spark, NOTE, path, "declared_notes")
    assert spark.table("declared_notes").count() == 1


def test_scratch_folder_is_below_the_checkpoint_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- streaming


def test_stream_takes_every_file_once_and_drops_late_rows(spark, tmp_path):
    base = str(tmp_path)

    def land(name, when, as_of):
        rows = spark.createDataFrame([("a", name, "u", when)], "artist_id string, artist_name string, external_url string, extraction_date string")
        writers.land_snapshot(rows, f"{base}/in", "artists", as_of)

    def run(as_of):
        stream_landing(spark, f"{base}/in", STAGED_ARTISTS, f"{base}/t", f"{base}/ck", as_of)
        return [r["artist_name"] for r in tables.table_read(spark, f"{base}/t").orderBy("valid_from").collect()]

    land("one", "2026-01-02T00:00:00", T0)
    assert run(T0) == ["one"]
    assert run(T1) == ["one"]
    land("late", "2026-01-01T00:00:00", T1)
    assert run(T1) == ["one"]
    land("two", "2026-01-03T00:00:00", T2)
    assert run(T2) == ["one", "two"]


@pytest.mark.parametrize("per_batch", [1, 2, 1000])
def test_the_size_of_batches_does_not_change_the_table(spark, tmp_path, per_batch):
    base = str(tmp_path)
    schema = "artist_id string, artist_name string, external_url string, extraction_date string"
    for day, name in enumerate(("one", "two", "three"), 1):
        rows = [("a", name, "u", f"2026-01-0{day}T00:00:00"), (None, "lost", "u", "2026-01-01T00:00:00")]
        writers.land_snapshot(spark.createDataFrame(rows, schema), f"{base}/in", f"artists{day}", T0)
    found = stream_landing(spark, f"{base}/in", STAGED_ARTISTS, f"{base}/t", f"{base}/ck", T1, per_batch)
    assert found == {"inserted": 1, "expired": 0, "rejected": 3}
    assert content(tables.table_read(spark, f"{base}/t"), "artist_name", "valid_from", "valid_to") == [("three", T1, None)]
    assert picked_up(spark, f"{base}/ck").filter("problem = 'no key'").count() == 3


def test_a_stream_over_an_empty_folder_does_nothing(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    base = str(tmp_path)
    found = stream_landing(spark, f"{base}/in", STAGED_ARTISTS, f"{base}/t", f"{base}/ck", T1)
    assert found == {"inserted": 0, "expired": 0, "rejected": 0}


# --- schema growth


def _growing(spark, path, rows, schema, as_of, tracked):
    staged = with_hash(spark.createDataFrame(rows, schema), tracked)
    return tables.scd2_merge(staged, path, ["id"], as_of, tracked=tracked)


def test_new_columns_are_kept_and_old_versions_have_null(spark, tmp_path):
    path = str(tmp_path / "t")
    _growing(spark, path, [("a", 1), ("b", 2), ("c", 3)], "id string, v int", T0, ["v"])
    second = _growing(
        spark, path, [("a", 1, None), ("b", 2, "w")], "id string, v int, w string", T1, ["v", "w"])
    assert second == {"inserted": 1, "expired": 1}  # only the row with a value in the new column
    assert _growing(spark, path, [("a", 1, None), ("b", 2, "w")], "id string, v int, w string", T2, ["v", "w"]) == {
        "inserted": 0, "expired": 0}
    assert _growing(spark, path, [("d", "w", 7)], "id string, w string, v int", T2, ["v", "w"])["inserted"] == 1
    stored = tables.table_read(spark, path)
    assert stored.columns == ["id", "v", "hash_key", "is_current", "valid_from", "valid_to", "w"]
    assert content(stored, "id", "v", "w", "is_current") == [
        ("a", 1, None, True), ("b", 2, "w", True), ("b", 2, None, False), ("c", 3, None, True), ("d", 7, "w", True)]


def test_a_column_that_a_stage_lacks_is_null_in_its_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    _growing(spark, path, [("a", "x", 1)], "id string, name string, extra int", T0, ["name"])
    _growing(spark, path, [("a", "y")], "id string, NAME string", T1, ["NAME"])
    assert content(tables.table_read(spark, path), "id", "name", "extra", "is_current") == [
        ("a", "x", 1, False), ("a", "y", None, True)]
    assert "NAME" not in tables.table_read(spark, path).columns


def test_changed_types_fail_and_publish_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    _growing(spark, path, [("a", 1)], "id string, n bigint", T0, ["n"])
    assert _growing(spark, path, [("a", 2)], "id string, n int", T1, ["n"])["expired"] == 1  # fits
    with pytest.raises(TypeError, match="column n: staged as string, stored as bigint"):
        _growing(spark, path, [("a", "3")], "id string, n string", T2, ["n"])
    assert content(current_rows(tables.table_read(spark, path)), "id", "n") == [("a", 2)]
    assert dict(tables.table_read(spark, path).dtypes)["n"] == "bigint"


# --- staging and scans that spill nothing


def test_staging_writes_its_buckets_without_a_sort(spark, tmp_path, monkeypatch):
    """More buckets than open files are written whole too, and the session's setting comes back."""
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    original = DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        return original(self, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    before = spark.conf.get(name)
    df = spark.range(4000).selectExpr("CASE WHEN id % 3 <> 0 THEN id % 200 END AS k", "id AS v")
    for buckets in (10, 40):
        path, count = writers.stage_clustered(df, str(tmp_path / str(buckets)), "k", T0, buckets=buckets)
        stored = spark.read.parquet(path)
        assert count == 4000 and sorted(map(tuple, stored.select("k", "v").collect()), key=repr) == sorted(
            map(tuple, df.collect()), key=repr)
        assert stored.filter("k is not null").groupBy("k").agg(F.count_distinct("bucket").alias("n")).filter("n > 1").isEmpty()
    assert seen == [writers.OPEN_FILES] * 2 and writers.OPEN_FILES >= 10
    assert spark.conf.get(name) == before


def test_overlapping_settings_come_back(spark):
    before = spark.conf.get(SCAN_BYTES)
    outer, inner = settings(spark, {SCAN_BYTES: "1000"}), settings(spark, {SCAN_BYTES: "1000"})
    outer.__enter__()
    inner.__enter__()
    outer.__exit__(None, None, None)
    assert spark.conf.get(SCAN_BYTES) == "1000"
    inner.__exit__(None, None, None)
    assert spark.conf.get(SCAN_BYTES) == before
    assert small_scans(spark, 5) == {SCAN_BYTES: "5"}
    with settings(spark, {SCAN_BYTES: "3"}):
        assert small_scans(spark, 5) == {SCAN_BYTES: "3"}


def test_jobs_sort_small_scans(spark, tmp_path, monkeypatch):
    """Extract and silver read few bytes per task where tasks sort what they read."""
    seen = []
    original = Metrics.run

    def watched(self, steps):
        seen.append(spark.conf.get(SCAN_BYTES))
        return original(self, steps)
    monkeypatch.setattr(Metrics, "run", watched)
    before = spark.conf.get(SCAN_BYTES)
    layout = Layout(str(tmp_path / "lake"))
    page = {"playlist_id": "p", "playlist_position": 0, "page_offset": 0, "items": [
        {"added_at": "2020-01-02", "track": {"id": "t", "name": "n", "album": {"id": "al", "name": "al"}, "artists": [_artist("a", "A")]}}]}
    (tmp_path / "pages.json").write_text(json.dumps(page))
    run_extract(spark, str(tmp_path / "pages.json"), layout, T0, "web")
    run_silver(spark, layout, T0)
    assert seen == [str(2 * SORTED_SCAN_BYTES), str(SORTED_SCAN_BYTES)]
    assert spark.conf.get(SCAN_BYTES) == before


def test_tracks_are_sorted_without_their_paths(spark, tmp_path, monkeypatch):
    """Of equal rows the one in the last file stays, as with the paths themselves, which come back whole."""
    seen, original = [], silver.dedup_latest

    def watched(df, *args):
        seen.append(df.columns)
        return original(df, *args)
    monkeypatch.setattr(silver, "dedup_latest", watched)
    layout = Layout(str(tmp_path / "a lake"))
    songs = spark.createDataFrame(
        [(k, k, f"a{i}", "2026-01-01T00:00:00") for i in range(9) for k in ("t1", "t2", None)],
        "song_id string, song_name string, artist_id string, extraction_date string")
    path, _ = writers.stage_clustered(songs.withColumn("artist_id", F.lit("a")).unionByName(songs), f"{layout.staged}/songs", "artist_id", T0)
    silver._insert_tracks(spark, layout, T0)
    stored = tables.table_read(spark, f"{layout.silver}/tracks")
    read = landing.read_landing(spark, path, silver.STAGED_TRACKS, "parquet").filter("track_id is not null")
    expected = original(read, ["track_id"], ["extraction_date"])
    assert content(stored, *expected.columns) == content(expected, *expected.columns) and stored.count() == 2
    assert stored.filter("source_file not like '%.parquet'").isEmpty()
    assert all("source_file" not in columns for columns in seen) and seen


def test_stored_hashes_take_half_their_digits(spark, tmp_path):
    rows = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    tables.table_overwrite(rows.coalesce(1), str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t" / "v=1").glob("*.parquet"))
    assert size < 0.65 * 64 * 20000
