"""End to end: nested pages to ranked queries, run again with a changed second extract."""

import json

import pytest
from pyspark.sql import functions as F

from lakestar.contracts import TABLES
from lakestar.operators.projection import current_rows
from lakestar.plans.catalog import declare_lake
from lakestar.plans.extract import run_extract
from lakestar.plans.gold import analysis, load_fact, run_export, run_gold
from lakestar.plans.layout import Layout
from lakestar.plans.silver import latest_tracks, run_silver
from lakestar.sources.tables import table_read
from tests.conftest import T0, T1, T2

SOURCE = "src"


def _page(number, second):
    def artist(key):
        name = f'artist "{key}"\n' + ("renamed" if second and key == "a1" else "")
        return {"id": key, "name": name, "external_urls": {"web": f"u/{key}"}}
    album = {"id": "al1", "name": "album", "release_date": "1999-05", "total_tracks": 4 if second else 3,
             "external_urls": {"web": "u"}, "artists": [artist("a1")]}
    tracks = [
        {"added_at": "2020-01-02T00:00:00Z", "track": {
            "id": f"t{number}", "name": "n", "duration_ms": 1, "popularity": number * 10, "album": album,
            "external_urls": {"web": "u"}, "artists": [artist("a1"), artist(f"b{number}")]}},
        {"added_at": "2020-01-02", "track": None},
        {"added_at": "", "track": {"id": None, "name": "local", "artists": []}},
    ]
    if second:
        tracks.append({"added_at": "2021-01-01", "track": {"id": "t9", "name": "new", "popularity": 99, "artists": [artist("zz")]}})
    return {"playlist_id": f"p{number}", "playlist_position": number, "page_offset": 0, "items": tracks}


def _write(folder, second):
    folder.mkdir()
    lines = [json.dumps(_page(i, second)) for i in range(3)] + (['{"playlist_id": "torn", "items": ['] if second else [])
    (folder / "pages.json").write_text("\n".join(lines))
    return str(folder)


def _metrics(df):
    return {f"{r['step']}.{r['metric']}": r["value"] for r in df.collect() if r["metric"] != "millis"}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    layout = Layout(str(base / "lake"))
    runs = []
    for name, second, as_of in (("one", False, T0), ("two", True, T1)):
        source = _write(base / name, second)
        runs.append((
            _metrics(run_extract(spark, source, layout, as_of, "web")),
            _metrics(run_silver(spark, layout, as_of)),
            _metrics(run_gold(spark, layout, as_of, SOURCE)),
        ))
    return layout, runs


def test_counts_of_the_runs(lake):
    _, ((extract1, silver1, gold1), (extract2, silver2, gold2)) = lake
    assert extract1["artists.extracted"] == extract1["artists.staged"] == 4
    assert extract1["songs.landed"] == 6 and extract2["songs.landed"] == 9
    assert (extract1["pages.read"], extract1["pages.rejected"]) == (3, 0)
    assert (extract2["pages.read"], extract2["pages.rejected"]) == (4, 1)
    none = {f"{step}.{metric}": 0 for step in ("artists", "albums", "tracks") for metric in ("corrupt", "misfits")}
    assert silver1 == {"artists.inserted": 4, "artists.expired": 0, "artists.rejected": 0, "albums.inserted": 1,
                       "albums.expired": 0, "albums.rejected": 0, "tracks.inserted": 3, "tracks.rejected": 3, **none}
    assert (silver2["artists.inserted"], silver2["artists.expired"]) == (2, 1)
    assert (silver2["albums.inserted"], silver2["albums.expired"], silver2["tracks.inserted"]) == (1, 1, 1)
    assert (gold1["dim_albums.inserted"], gold2["dim_albums.inserted"], gold2["dim_albums.expired"]) == (1, 1, 1)
    assert (gold1["fact_track_plays.written"], gold2["fact_track_plays.written"]) == (3, 4)


def test_changed_album_has_a_current_row(spark, lake):
    albums = table_read(spark, f"{lake[0].gold}/dim_albums")
    found = [(r["total_tracks"], r["is_current"], r["valid_from"], r["valid_to"]) for r in albums.orderBy("valid_from").collect()]
    assert found == [(3, False, T0, T1), (4, True, T1, None)]
    assert albums.select("album_key").distinct().count() == 1


def test_repeated_runs_change_nothing(spark, lake):
    layout, _ = lake
    def state():
        names = ("dim_artists", "dim_albums", "dim_tracks", "dim_dates", "fact_track_plays")
        return {n: sorted(map(repr, table_read(spark, f"{layout.gold}/{n}").drop("last_updated").collect())) for n in names}
    before = state()
    run_silver(spark, layout, T1)
    run_gold(spark, layout, T1, SOURCE)
    assert state() == before


def test_fact_rows_and_the_days_popularity(spark, lake):
    layout, _ = lake
    path = f"{layout.gold}/fact_track_plays"
    fact = table_read(spark, path)
    assert {r["date_key"]: r["count"] for r in fact.groupBy("date_key").count().collect()} == {20260101: 3, 20260102: 4}
    measured = spark.createDataFrame([("t1", 77), ("t1", 7)], "track_id string, popularity int")
    load_fact(spark, layout, T2, SOURCE, measured)
    day = table_read(spark, path).filter("date_key = 20260103")
    assert sorted(r["popularity"] for r in day.collect()) == [0, 20, 77, 99]
    assert day.filter("album_key is null").count() == 1
    load_fact(spark, layout, T2, SOURCE, latest_tracks(spark, layout))
    assert table_read(spark, path).filter("date_key = 20260103").count() == 4


def test_torn_pages_are_kept_aside(spark, lake):
    torn = spark.read.option("recursiveFileLookup", "true").parquet(f"{lake[0].rejected}/pages").collect()
    assert [r["corrupt_record"][:22] for r in torn] == ['{"playlist_id": "torn"']


def test_tables_have_names_for_sql(spark, lake):
    names = declare_lake(spark, lake[0])
    assert names == list(TABLES)
    found = spark.sql("""
        SELECT d.artist_name, count(*) AS n FROM fact_track_plays f JOIN dim_artists d USING (artist_key)
        WHERE d.is_current AND f.date_key = 20260102 GROUP BY 1 ORDER BY 1""")
    assert [tuple(r) for r in found.collect()] == [('artist "a1"\nrenamed', 3), ('artist "zz"\n', 1)]
    for name, contract in TABLES.items():
        declared = [(f.name, f.dataType) for f in contract.schema.fields]
        assert sorted((f.name, f.dataType) for f in spark.table(name).schema.fields) == sorted(declared, key=str), name


def test_quarantine_holds_rows_without_key(spark, lake):
    layout, _ = lake
    rejected = spark.read.option("recursiveFileLookup", "true").parquet(f"{layout.rejected}/tracks")
    assert rejected.filter(F.col("track_id").isNotNull()).count() == 0
    assert rejected.count() >= 6


def test_export_and_analysis(spark, lake):
    layout, _ = lake
    exported = run_export(spark, layout, T2)
    assert spark.read.text(exported["artists"]).count() == table_read(spark, f"{layout.gold}/dim_artists").count()
    profile = {(r["table_name"], r["column_name"]): r for r in spark.read.json(exported["profile"]).collect()}
    assert profile["tracks", "album_id"]["row_count"] == table_read(spark, f"{layout.gold}/dim_tracks").count()
    found = analysis(spark, layout)
    top = [(r["artist_name"], r["avg_popularity"]) for r in found["artists_by_popularity"].collect()]
    assert top == [('artist "zz"\n', 99.0), ('artist "a1"\nrenamed', 10.0)]
    assert [tuple(r) for r in found["popularity_by_year"].collect()] == [("2020", 10.0), ("2021", 99.0)]
    assert [r["album_name"] for r in found["albums_by_popularity"].collect()] == ["album"]
    assert found["artists_by_rows"].first()["count"] == 3
    assert current_rows(table_read(spark, f"{layout.gold}/dim_artists")).count() == 5
