"""Whole batch jobs from JSON lines, by every route, against the SQL of the catalogue."""

import duckdb
import pytest
from pyspark.sql import functions as F

from layercake.catalog import fixtures as fx
from layercake.catalog.oracles import ORACLES
from layercake.plans import gold, jobs, silver
from layercake.schemas import GOLD, RAW_PLAYLISTS, RAW_TRACKS, SILVER, SILVER_KEYS
from layercake.sources import Lake, export_json, read_json

SF_DIR = "/root/testdata/sf0.001"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("orders", "lineitem", "part", "supplier"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")

    def run(name, columns):
        return sorted(
            connection.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall(),
            key=repr,
        )

    return run


@pytest.fixture(scope="module")
def batches(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("batches")
    playlists, tracks = fx.playlists(spark, SF_DIR), fx.tracks(spark, SF_DIR)
    paths = {}
    for n in (1, 2, 3):
        paths[n] = (str(root / f"p{n}"), str(root / f"t{n}"))
        export_json(fx.playlists_batch(playlists, n), paths[n][0])
        export_json(fx.tracks_batch(tracks, n), paths[n][1])
    return paths


def full_gold(lake):
    """Both gold tables as a rebuild of the current silver tables gives them."""
    s = {name: lake.read(f"silver/{name}") for name in SILVER}
    return {
        "gold/playlists": rows(gold.playlists_rebuild(s["playlist_tracks"], s["playlists"])),
        "gold/playlist_tracks": rows(
            gold.tracks_rebuild(s["playlist_tracks"], s["songs"], s["albums"], s["artists"])
        ),
    }


def test_three_batches(spark, duck, batches, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    assert rows(lake.read("gold/playlists")) == duck("gold_playlists_build", GOLD["playlists"])
    assert rows(lake.read("silver/songs")) == duck("silver_songs", SILVER["songs"])
    assert lake.read("bronze/tracks").count() == len(duck("bronze_tracks", ["pid"]))

    jobs.upsert_batch(lake, *batches[2])
    for name, query in {
        "songs": "merge_songs",
        "albums": "merge_albums",
        "artists": "merge_artists",
        "playlists": "merge_playlists",
        "playlist_tracks": "merge_slots",
    }.items():
        assert rows(lake.read(f"silver/{name}")) == duck(query, SILVER[name])
        assert lake.entries()[f"silver/{name}"].unique_on == tuple(SILVER_KEYS[name])
    assert rows(lake.read("gold/playlists")) == duck("gold_playlists_rebuild", GOLD["playlists"])
    assert rows(lake.read("gold/playlist_tracks")) == duck(
        "gold_tracks_rebuild", GOLD["playlist_tracks"]
    )

    # The second upsert takes the incremental routes.
    jobs.upsert_batch(lake, *batches[3])
    assert rows(lake.read("gold/playlists")) == duck("three_batches", GOLD["playlists"])
    s = {name: lake.read(f"silver/{name}") for name in SILVER}
    full = gold.tracks_rebuild(s["playlist_tracks"], s["songs"], s["albums"], s["artists"])
    assert rows(lake.read("gold/playlist_tracks")) == rows(full)

    # Keys are unique, none is lost, and gold adds up to silver.
    for name, keys in SILVER_KEYS.items():
        assert s[name].dropDuplicates(keys).count() == s[name].count()
        first = silver.build(fx.playlists(spark, SF_DIR), fx.tracks(spark, SF_DIR))[name]
        assert first.join(s[name], keys, "left_anti").isEmpty()
    listed = s["playlist_tracks"].join(s["playlists"], "playlist_id", "left_semi")
    assert (
        listed.agg(F.sum("duration_ms")).first()[0]
        == lake.read("gold/playlists").agg(F.sum("total_duration_ms")).first()[0]
    )

    # Applying a batch again changes nothing.
    before = {t: rows(lake.read(t)) for t in lake.entries()}
    jobs.upsert_batch(lake, *batches[3])
    assert {t: rows(lake.read(t)) for t in lake.entries()} == before


def one_playlist(spark, batches, tmp_path, pid):
    """A batch of one playlist and its tracks."""
    paths = str(tmp_path / f"one-p{pid}"), str(tmp_path / f"one-t{pid}")
    for source, schema, out in zip(batches[3], (RAW_PLAYLISTS, RAW_TRACKS), paths, strict=True):
        export_json(read_json(spark, source, schema).where(F.col("pid") == pid), out)
    return paths


def test_gold_after_point_updates_of_silver_only(spark, batches, tmp_path):
    patch = {"name": "'Late shift'"}
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    jobs.upsert_batch(lake, *batches[2])
    jobs.point_update(lake, "playlist_id = 994", patch, ["silver/playlists"])
    jobs.point_update(lake, "playlist_id = 996", patch)
    jobs.upsert_batch(lake, *one_playlist(spark, batches, tmp_path, 998))
    full = full_gold(lake)
    assert {t: rows(lake.read(t)) for t in full} == full
    assert jobs._current("gold/playlists", lake.entries())

    jobs.point_update(lake, "true", {"artist_name": "'Anon'"}, ["silver/artists"])
    jobs.point_update(lake, "playlist_id = 996", patch)
    jobs.upsert_batch(lake, *one_playlist(spark, batches, tmp_path, 994))
    full = full_gold(lake)
    assert {t: rows(lake.read(t)) for t in full} == full
    names = {r[0] for r in lake.read("gold/playlist_tracks").select("artist_name").collect()}
    assert names == {"Anon"}


def test_name_that_comes_with_a_later_batch(spark, batches, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    jobs.upsert_batch(lake, *batches[2])
    # The songs lose a key; gold is rebuilt without its entries, and the key comes back.
    jobs.point_update(lake, "true", {"track_uri": "concat(track_uri, '-old')"}, ["silver/songs"])
    jobs.upsert_batch(lake, *one_playlist(spark, batches, tmp_path, 998))
    jobs.upsert_batch(lake, *batches[3])
    full = full_gold(lake)
    assert {t: rows(lake.read(t)) for t in full} == full


def test_failed_batch_leaves_the_lake_as_it_was(spark, batches, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    jobs.upsert_batch(lake, *batches[2])
    before = lake.entries()

    def fail(*args):
        raise RuntimeError("no gold")

    for name in ("playlists_patch", "playlists_rebuild", "playlists_merge"):
        monkeypatch.setattr(gold, name, fail)
    for job in (jobs.upsert_batch, jobs.merge_batch):
        with pytest.raises(RuntimeError):
            job(lake, *batches[3])
        assert lake.entries() == before


def test_merge_keeps_what_is_unique(spark, duck, batches, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    jobs.upsert_batch(lake, *batches[2])
    before = rows(lake.read("gold/playlists"))
    jobs.merge_batch(lake, *one_playlist(spark, batches, tmp_path, 996))
    entries = lake.entries()
    assert entries["silver/playlists"].unique_on == ("playlist_id",)
    assert entries["gold/playlists"].unique_on == ("playlist_id",)
    assert rows(lake.read("gold/playlists")) == full_gold(lake)["gold/playlists"]
    assert len(set(rows(lake.read("gold/playlists"))) - set(before)) <= 1


def test_unreadable_lines(spark, tmp_path):
    playlists, tracks = tmp_path / "p.json", tmp_path / "t.json"
    playlists.write_text('{"pid": 1, "name": "a"}\n{"pid": "x3", "name": "b"}\n{"pid": 2, \n')
    tracks.write_text('{"pid": 1, "track_uri": "t", "pos": 0}\n')
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jobs.build_lake(lake, str(playlists), str(tracks))
    assert lake.entries() == {}
    jobs.build_lake(lake, str(playlists), str(tracks), keep_corrupt=True)
    bronze = lake.read("bronze/playlists")
    kept = bronze.where("_corrupt_record IS NOT NULL").select("_corrupt_record")
    assert {r[0] for r in kept.collect()} == {'{"pid": "x3", "name": "b"}', '{"pid": 2, '}
    assert [r["playlist_id"] for r in lake.read("silver/playlists").collect()] == [1]


def test_declared_column_that_is_null_in_every_line(spark, tmp_path):
    playlists, tracks = tmp_path / "p.json", tmp_path / "t.json"
    playlists.write_text('{"pid": 1, "name": "a", "extra": 5}\n')
    tracks.write_text('{"pid": 1, "track_uri": "t", "pos": 0}\n')
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, str(playlists), str(tracks), infer_schema=True)
    assert "extra" in lake.read("bronze/playlists").columns
    (row,) = lake.read("silver/playlists").collect()
    assert row["description"] is None and row["name"] == "a"


def test_unknown_columns_are_refused(spark, batches, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    with pytest.raises(ValueError, match="nmae"):
        jobs.point_update(lake, "playlist_id = 996", {"nmae": "'x'"}, ["silver/playlists"])


def test_merge_batch(spark, duck, batches, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    jobs.merge_batch(lake, *batches[3], columns=gold.MERGE_COLUMNS)
    assert rows(lake.read("silver/playlist_tracks")) == duck(
        "merge_generic", SILVER["playlist_tracks"]
    )
    assert rows(lake.read("silver/playlists")) == duck(
        "merge_generic_playlists", SILVER["playlists"]
    )
    assert rows(lake.read("gold/playlists")) == duck("merge_partial_columns", GOLD["playlists"])


def test_patched_batch(spark, duck, batches, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    patched = str(tmp_path / "patched.json")
    patch = {"name": "'Late shift'", "collaborative": "'True'"}
    jobs.patch_batch(spark, batches[2][0], "pid = 996", patch, patched)
    jobs.upsert_batch(lake, patched, batches[2][1])
    assert rows(lake.read("silver/playlists")) == duck("patch_then_merge", SILVER["playlists"])


def test_point_update_of_both_layers(spark, duck, batches, tmp_path, capsys):
    lake = Lake(spark, str(tmp_path / "lake"))
    patch = {"name": "'Late shift'", "collaborative": "true"}
    jobs.ingest_bronze(lake, fx.playlists(spark, SF_DIR), fx.tracks(spark, SF_DIR))
    jobs.build_silver(lake)
    jobs.point_update(lake, "playlist_id = 996", patch)
    assert "gold/playlists: no such table" in capsys.readouterr().out
    assert rows(lake.read("silver/playlists")) == duck("update_where", SILVER["playlists"])

    jobs.upsert_batch(lake, *batches[2])
    jobs.point_update(lake, "playlist_id = 998", patch)
    both = lake.entries()
    assert both["silver/playlists"].snapshot == both["gold/playlists"].snapshot
    for table in ("silver/playlists", "gold/playlists"):
        (row,) = lake.read(table).filter("playlist_id = 998").collect()
        assert (row["name"], row["collaborative"]) == ("Late shift", "true")
    # An update of one layer alone makes the next batch rebuild gold.
    jobs.point_update(lake, "playlist_id = 994", patch, ["silver/playlists"])
    assert not jobs._current("gold/playlists", lake.entries())
    jobs.upsert_batch(lake, *batches[3])
    s = {name: lake.read(f"silver/{name}") for name in ("playlists", "playlist_tracks")}
    full = gold.playlists_rebuild(s["playlist_tracks"], s["playlists"])
    assert rows(lake.read("gold/playlists")) == rows(full)


def test_json_tables_and_inferred_schema(spark, duck, batches, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1], fmt="json", infer_schema=True)
    assert rows(lake.read("gold/playlists").select(GOLD["playlists"])) == duck(
        "gold_playlists_build", GOLD["playlists"]
    )
    jobs.upsert_batch(lake, *batches[2])
    assert rows(lake.read("silver/playlists")) == duck("merge_playlists", SILVER["playlists"])


def test_silver_functions_match_their_schema(spark):
    built = silver.build(fx.playlists(spark, SF_DIR), fx.tracks(spark, SF_DIR))
    assert {name: df.columns for name, df in built.items()} == SILVER


def test_a_rebuild_counts_entries_once(spark, batches, tmp_path, monkeypatch):
    """Summaries that are written with the uses of entries come from these."""
    lake = Lake(spark, str(tmp_path / "lake"))
    jobs.build_lake(lake, *batches[1])
    monkeypatch.setattr(gold, "summarise", lambda entries: pytest.fail("entries are counted twice"))
    jobs.upsert_batch(lake, *batches[2])
    monkeypatch.undo()
    assert rows(lake.read("gold/playlists")) == full_gold(lake)["gold/playlists"]
    assert jobs._current("gold/playlists", lake.entries())
