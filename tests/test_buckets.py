"""Tables in buckets: a batch costs what it touches, and gives the rows of a whole rebuild."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layercake.operators import CHANGE, upsert_non_null
from layercake.plans import gold, jobs
from layercake.schemas import GOLD, SILVER
from layercake.sources import BUCKET, Lake

TABLES = [*(f"silver/{n}" for n in SILVER), *(f"gold/{n}" for n in GOLD), jobs.USES]


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def entry(pid, pos, track, album="al", artist="ar", duration=1000):
    names = {"track_name": f"n{track}", "album_name": f"n{album}", "artist_name": f"n{artist}"}
    uris = {"track_uri": track, "album_uri": album, "artist_uri": artist}
    return {"pid": pid, "pos": pos, "duration_ms": duration, **uris, **names}


def write(folder, name, playlists, tracks):
    paths = folder / f"{name}-p.json", folder / f"{name}-t.json"
    for path, lines in zip(paths, (playlists, tracks), strict=True):
        path.write_text("".join(json.dumps(x) + "\n" if isinstance(x, dict) else x + "\n" for x in lines))
    return tuple(map(str, paths))


def playlist(pid, name="p", **more):
    return {"pid": pid, "name": name, "collaborative": "false", **more}


def files(lake, table, version):
    """{bucket: bytes} of what a version of a table has of its own."""
    found = {}
    for f in Path(lake.root, table, f"v={version}").glob(f"{BUCKET}=*/part-*"):
        found[int(f.parent.name.split("=")[1])] = found.get(int(f.parent.name.split("=")[1]), 0) + f.stat().st_size
    return found


def check_gold(lake):
    s = {name: lake.read(f"silver/{name}") for name in SILVER}
    names = (s["songs"], s["albums"], s["artists"])
    assert rows(lake.read("gold/playlists")) == rows(gold.playlists_rebuild(s["playlist_tracks"], s["playlists"]))
    assert rows(lake.read("gold/playlist_tracks")) == rows(gold.tracks_rebuild(s["playlist_tracks"], *names))
    assert rows(lake.read(jobs.USES)) == rows(gold.uses_build(s["playlist_tracks"]))
    assert rows(gold.summarise_uses(lake.read(jobs.USES))) == rows(
        gold.summarise(s["playlist_tracks"].where("playlist_id IS NOT NULL"))
    )
    assert all(jobs._current(t, lake.entries()) for t in jobs.GOLD_TABLES)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake of 300 playlists in 32 buckets, unique after one upsert."""
    folder = tmp_path_factory.mktemp("lake")
    pick = random.Random(1)
    playlists = [playlist(i) for i in range(300)]
    tracks = [
        entry(i, pos, f"t{pick.randrange(900)}", f"al{pick.randrange(200)}", f"ar{pick.randrange(90)}", pick.randrange(9))
        for i in range(300)
        for pos in range(8)
    ]
    made = Lake(spark, str(folder / "lake"), buckets=32)
    jobs.build_lake(made, *write(folder, "first", playlists, tracks))
    jobs.upsert_batch(made, *write(folder, "second", playlists[:1], tracks[:8]))
    check_gold(made)
    return made


def test_small_batch_writes_its_buckets(spark, lake, tmp_path):
    before = lake.entries()
    (one, al, ar), (two, *_) = lake.read("silver/playlist_tracks").select("track_uri", "album_uri", "artist_uri").take(2)
    batch = [entry(7, 2, one, al, ar, 50), entry(7, 50, "t-new", al, "ar-new", 6), entry(8, 0, two, al, ar, 70)]
    jobs.upsert_batch(lake, *write(tmp_path, "b", [playlist(7, "other"), playlist(8)], batch))
    after = lake.entries()
    version = max(e.snapshot for e in after.values())
    # Songs, artists: the bucket of the one new key; albums had none.
    assert len(files(lake, "silver/songs", version)) == 1 == len(files(lake, "silver/artists", version))
    assert after["silver/albums"] == before["silver/albums"] and files(lake, "silver/albums", version) == {}
    for table in ("silver/playlist_tracks", "gold/playlists", "gold/playlist_tracks", jobs.USES):
        assert 1 <= len(files(lake, table, version)) <= 2
        referred = dict(after[table].parts)
        assert set(referred[version]) <= set(files(lake, table, version))
        assert sum(len(b) for _, b in after[table].parts) == sum(len(b) for _, b in before[table].parts)
    # Only playlist 7 has another name.
    assert len(dict(after["silver/playlists"].parts)[version]) == 1
    check_gold(lake)
    # What is written follows the batch: a few of 32 buckets.
    for table in ("silver/playlist_tracks", "gold/playlist_tracks"):
        whole = sum(sum(files(lake, table, v).values()) for v, _ in before[table].parts)
        assert sum(files(lake, table, version).values()) < whole / 4


def test_identical_batch_changes_nothing(spark, lake, tmp_path, monkeypatch):
    same = [tuple(r) for r in lake.read("silver/playlist_tracks").where("playlist_id IN (3, 4)").collect()]
    batch = [entry(i, pos, t, al, ar, ms) for i, t, al, ar, pos, ms in same]
    before = {t: (lake.entries()[t].parts, rows(lake.read(t))) for t in TABLES}

    def fail(*args):
        raise AssertionError("recomputed")

    for name in ("playlists_patch", "playlists_refresh", "playlists_rebuild", "tracks_refresh", "tracks_rebuild", "uses_refresh", "uses_build"):
        monkeypatch.setattr(gold, name, fail)
    jobs.upsert_batch(lake, *write(tmp_path, "same", [playlist(3), playlist(4)], batch))
    jobs.upsert_batch(lake, *write(tmp_path, "empty", [], []))
    monkeypatch.undo()
    assert {t: (lake.entries()[t].parts, rows(lake.read(t))) for t in TABLES} == before
    check_gold(lake)


def test_last_use_of_a_uri(spark, lake, tmp_path):
    def counts():
        (row,) = lake.read("gold/playlists").where("playlist_id = 20").collect()
        return tuple(row)[1:5]

    one = [entry(20, p, f"x{p % 2}", f"y{p % 2}", "z", 10) for p in range(8)]
    jobs.upsert_batch(lake, *write(tmp_path, "one", [playlist(20)], one))
    assert counts() == (2, 1, 2, 80)
    # Every use of x1 goes but one, then that one.
    jobs.upsert_batch(lake, *write(tmp_path, "two", [], [entry(20, p, "x0", "y0", "z", 10) for p in (1, 3, 5)]))
    assert counts() == (2, 1, 2, 80)
    jobs.upsert_batch(lake, *write(tmp_path, "three", [], [entry(20, 7, "x0", "y0", "w", None)]))
    assert counts() == (1, 2, 1, 80)
    check_gold(lake)


def test_random_batches(spark, lake, tmp_path):
    """New and known playlists, moved and repeated entries, nulls, entries without a playlists row."""
    pick = random.Random(7)
    for n in range(3):
        ids = [pick.choice([None, *range(290, 310)]) for _ in range(12)]
        tracks = [
            entry(pick.choice(ids), pick.randrange(10), pick.choice([None, "t1", f"t{n}-new"]), pick.choice(["al1", f"al{n}"]), "ar1", pick.choice([None, 3]))
            for _ in range(40)
        ]
        listed = [playlist(i, pick.choice([None, "q"])) for i in ids if pick.random() < 0.7]
        jobs.upsert_batch(lake, *write(tmp_path, f"r{n}", listed, tracks))
        s = {name: lake.read(f"silver/{name}") for name in SILVER}
        assert rows(lake.read("gold/playlists")) == rows(gold.playlists_rebuild(s["playlist_tracks"], s["playlists"]))
        assert rows(lake.read(jobs.USES)) == rows(gold.uses_build(s["playlist_tracks"]))
        names = (s["songs"], s["albums"], s["artists"])
        assert rows(lake.read("gold/playlist_tracks")) == rows(gold.tracks_rebuild(s["playlist_tracks"], *names))


def test_merge_writes_its_buckets(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=32)
    playlists, tracks = [playlist(i) for i in range(60)], [entry(i, p, f"t{p}") for i in range(60) for p in range(4)]
    whole = Lake(spark, str(tmp_path / "whole"), buckets=1)
    batches = [
        write(tmp_path, "one", playlists, tracks),
        write(tmp_path, "two", [playlist(3, "other")], [entry(3, 9, "t1"), entry(3, 5, "new")]),
        write(tmp_path, "three", [playlist(700)], [entry(700, 0, "t0"), entry(4, 7, "t2", duration=9)]),
    ]
    for made in (lake, whole):
        jobs.build_lake(made, *batches[0])
        jobs.upsert_batch(made, *write(tmp_path, "same", playlists[:1], tracks[:4]))
        for n in (1, 2):
            jobs.merge_batch(made, *batches[n])
    version = lake.entries()["gold/playlists"].snapshot
    for table in ("silver/playlists", "silver/playlist_tracks", "gold/playlists"):
        assert rows(lake.read(table)) == rows(whole.read(table))
        assert 1 <= len(files(lake, table, version)) <= 2
        assert sum(len(b) for _, b in lake.entries()[table].parts) > 20
        s = [lake.read(f"silver/{n}") for n in ("playlist_tracks", "playlists")]
        assert rows(lake.read("gold/playlists")) == rows(gold.playlists_rebuild(*s))
    jobs.merge_batch(lake, *write(tmp_path, "none", [], []))
    assert rows(lake.read("gold/playlists")) == rows(whole.read("gold/playlists"))


def test_point_update_writes_one_bucket(spark, lake):
    before = {t: rows(lake.read(t)) for t in ("silver/playlists", "gold/playlists")}
    jobs.point_update(lake, "playlist_id = 11", {"name": "'x'"})
    after = lake.entries()
    version = after["gold/playlists"].snapshot
    for table, old in before.items():
        assert len(files(lake, table, version)) == 1
        name = 5 if table == "gold/playlists" else 1
        changed = [tuple("x" if i == name and r[0] == 11 else v for i, v in enumerate(r)) for r in old]
        assert rows(lake.read(table)) == sorted(changed, key=repr)
    jobs.point_update(lake, "playlist_id = -5", {"name": "'x'"})
    assert lake.entries() == after
    # Assigning the column that buckets go by writes the table anew.
    jobs.point_update(lake, "playlist_id = 11", {"playlist_id": "-11"}, ["silver/playlists"])
    moved = lake.entries()["silver/playlists"]
    assert len(moved.parts) == 1 and moved.bucket_on == "playlist_id"
    jobs.point_update(lake, "playlist_id = -11", {"name": "'y'"}, ["silver/playlists"])
    assert lake.read("silver/playlists").where("playlist_id = -11 AND name = 'y'").count() == 1


def test_rejected_lines_of_a_batch(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    jobs.build_lake(lake, *write(tmp_path, "one", [playlist(1)], [entry(1, 0, "a")]))
    bad = write(tmp_path, "two", [playlist(2), '{"pid": 3, ', playlist(4)], [entry(2, 0, "b"), '{"pid": "x"}', "no json"])
    before = lake.entries()
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jobs.upsert_batch(lake, *bad)
    assert lake.entries() == before
    jobs.upsert_batch(lake, *bad, keep_corrupt=True)
    found = lake.entries()
    assert found[jobs.REJECTS].snapshot == found["silver/playlists"].snapshot
    first = found[jobs.REJECTS].snapshot
    expected = [(first, "playlists", '{"pid": 3, '), (first, "tracks", '{"pid": "x"}'), (first, "tracks", "no json")]
    assert rows(lake.read(jobs.REJECTS)) == sorted(expected, key=repr)
    assert [r[0] for r in rows(lake.read("gold/playlists").select("playlist_id"))] == [1, 2]
    jobs.merge_batch(lake, *write(tmp_path, "three", ["{"], [entry(2, 1, "c")]), keep_corrupt=True)
    assert len(rows(lake.read(jobs.REJECTS))) == 4 and rows(lake.read("silver/playlists").select("playlist_id")) == [(1,), (2,), (4,)]
    # A batch without such lines leaves the table as it is.
    jobs.upsert_batch(lake, *write(tmp_path, "four", [playlist(5)], []), keep_corrupt=True)
    assert len(rows(lake.read(jobs.REJECTS))) == 4


def test_changes_of_an_upsert(spark):
    """The column of changes against a comparison of rows before and after."""
    pick = random.Random(3)

    def some(n):
        return [tuple(pick.choice([None, 1, 2, 3]) for _ in range(4)) for _ in range(n)]

    schema = "a long, b long, x long, y long"
    for _ in range(4):
        old = upsert_non_null(spark.createDataFrame([], schema), spark.createDataFrame(some(12), schema), ["a", "b"])
        old = spark.createDataFrame(old.collect(), schema)
        new = spark.createDataFrame(some(12), schema)
        plain = upsert_non_null(old, new, ["a", "b"], old_unique=True)
        marked = upsert_non_null(old, new, ["a", "b"], old_unique=True, changes=True).collect()
        assert sorted((tuple(r)[:4] for r in marked), key=repr) == rows(plain)
        stored = {(r["a"], r["b"]): (r["x"], r["y"]) for r in old.collect()}
        for r in marked:
            was, now = stored.get((r["a"], r["b"])), (r["x"], r["y"])
            kind = "inserted" if was is None else None if was == now else "updated"
            assert (r[CHANGE] and r[CHANGE]["kind"]) == kind
            assert kind != "updated" or (r[CHANGE]["x"], r[CHANGE]["y"]) == was


def test_hot_bucket_is_cut(spark, tmp_path):
    """A playlist with most entries does not make one task write its bucket."""
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    table = spark.range(400_000).select(F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        lake.publish({"silver/t": table}, bucket_on={"silver/t": "k"})
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    most = max(len(list(f.glob("part-*"))) for f in Path(lake.root, "silver/t/v=1").glob(f"{BUCKET}=*"))
    assert most > 4 and lake.read("silver/t").count() == 400_000
    assert lake.read("silver/t", buckets={0, 1, 2, 3}).agg(F.sum("k")).first() == table.agg(F.sum("k")).first()


def test_few_buckets_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """A task writes its rows to the folders of all buckets, without a sort; many buckets are dealt out first."""
    hints = []
    kind, real = type(spark.range(1)), type(spark.range(1)).hint
    monkeypatch.setattr(kind, "hint", lambda df, *a: hints.append(a[0]) or real(df, *a))
    table = spark.range(2000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    for buckets, expected in ((16, 0), (17, 1)):
        lake = Lake(spark, str(tmp_path / f"lake-{buckets}"), buckets=buckets)
        lake.publish({"silver/t": table}, bucket_on={"silver/t": "k"})
        assert hints.count("rebalance") == expected
        assert rows(lake.read("silver/t")) == rows(table)
        assert len(files(lake, "silver/t", 1)) == buckets == sum(len(b) for _, b in lake.entries()["silver/t"].parts)
        one = lake.read("silver/t", buckets={3})
        assert 0 < one.count() < 400 and one.join(table, "k", "left_anti").isEmpty()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
