"""Gold tables on small hand-made rows."""

import pytest

from layercake.plans import gold

ENTRIES = (
    "playlist_id long, track_uri string, album_uri string, artist_uri string, pos long, "
    "duration_ms long"
)
PLAYLISTS = "playlist_id long, name string, collaborative string, description string"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def entries(spark):
    return spark.createDataFrame(
        [
            (1, "t1", "a1", "r1", 0, 10),
            (1, "t1", "a1", "r1", 1, 10),
            (1, "t2", None, "r1", 2, 5),
            (2, "t9", "a1", "r1", 0, 7),
            (None, "t1", "a1", "r1", 0, 3),
        ],
        ENTRIES,
    )


@pytest.fixture
def playlists(spark):
    return spark.createDataFrame(
        [(1, "x", "true", None), (3, "unused", "true", None), (None, "no id", "true", None)],
        PLAYLISTS,
    )


@pytest.fixture
def names(spark):
    songs = spark.createDataFrame(
        [("One", "t1"), ("Two", "t2"), ("One", "t1"), (None, "t1"), ("Eins", "t1")],
        "track_name string, track_uri string",
    )
    albums = spark.createDataFrame(
        [("a1", "First", "r1"), ("a1", "First", "r2")],
        "album_uri string, album_name string, artist_uri string",
    )
    artists = spark.createDataFrame([("r1", "Ann")], "artist_uri string, artist_name string")
    return songs, albums, artists


def test_summaries_keep_or_drop_unlisted_playlists(entries, playlists):
    first = (1, 2, 1, 1, 25, "x", "true", None)
    assert rows(gold.playlists_build(entries, playlists)) == sorted(
        [first, (2, 1, 1, 1, 7, None, None, None), (None, 1, 1, 1, 3, None, None, None)], key=repr
    )
    assert rows(gold.playlists_rebuild(entries, playlists)) == [first]


def test_build_repeats_a_playlist_listed_twice(entries, playlists):
    twice = playlists.unionByName(playlists)
    plain = gold.summarise(entries).join(twice, "playlist_id", "left")
    assert rows(gold.playlists_build(entries, twice)) == rows(plain)


def test_names_left_and_inner(entries, names):
    built = rows(gold.tracks_build(entries, *names))
    assert built == sorted(
        [
            (1, 0, "Eins", "First", "Ann"),
            (1, 1, "Eins", "First", "Ann"),
            (1, 2, "Two", None, "Ann"),
            (2, 0, None, "First", "Ann"),
            (None, 0, "Eins", "First", "Ann"),
        ],
        key=repr,
    )
    assert rows(gold.tracks_rebuild(entries, *names)) == [r for r in built if r[2] and r[3]]


def test_fanout_weights_equal_the_plain_join(entries, names):
    songs, albums, artists = names
    plain = (
        entries.join(songs, "track_uri", "left")
        .join(albums.drop("artist_uri"), "album_uri", "left")
        .join(artists, "artist_uri", "left")
        .select("playlist_id", "pos", "track_name", "album_name", "artist_name")
    )
    weighted = gold.tracks_fanout(entries, *names)
    repeated = weighted.selectExpr("*", "explode(sequence(1, copies)) AS i").drop("copies", "i")
    assert rows(repeated) == rows(plain)
    assert weighted.count() < plain.count()


def test_refresh_equals_rebuild(spark, entries, playlists, names):
    changed = spark.createDataFrame([(1,), (4,), (None,)], "playlist_id long")
    more = spark.createDataFrame(
        [(1, "t2", "a1", "r1", 9, 50), (4, "t1", "a1", "r1", 0, 1), (None, "t2", "a1", "r1", 1, 1)],
        ENTRIES,
    )
    after = entries.unionByName(more)
    listed = playlists.unionByName(spark.createDataFrame([(4, "new", "true", "d")], PLAYLISTS))
    refreshed = gold.playlists_refresh(
        gold.playlists_rebuild(entries, playlists), changed, after, listed
    )
    assert rows(refreshed) == rows(gold.playlists_rebuild(after, listed))
    refreshed = gold.tracks_refresh(
        gold.tracks_rebuild(entries, *names), changed, after, *names
    )
    assert rows(refreshed) == rows(gold.tracks_rebuild(after, *names))


def test_merge_of_selected_columns(spark, entries, playlists):
    before = spark.createDataFrame(
        [(1, 7, 7, 7, 7, "old", "false", "d"), (5, 1, 1, 1, 1, "kept", "true", None)],
        "playlist_id long, num_tracks long, num_artists long, num_albums long, "
        "total_duration_ms long, name string, collaborative string, description string",
    )
    listed = playlists.unionByName(spark.createDataFrame([(2, "y", "true", "d")], PLAYLISTS))
    fresh = gold.merge_source(entries, listed.unionByName(listed))
    kept = (5, 1, 1, 1, 1, "kept", "true", None)
    assert rows(gold.playlists_merge(before, fresh)) == [
        (1, 2, 1, 1, 25, "x", "true", None),
        (2, 1, 1, 1, 7, "y", "true", "d"),
        kept,
    ]
    assert rows(gold.playlists_merge(before, fresh, gold.MERGE_COLUMNS)) == [
        (1, 7, 7, 7, 25, "x", "true", None),
        (2, None, None, None, 7, "y", "true", "d"),
        kept,
    ]
