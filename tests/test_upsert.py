"""Upserts on small hand-made rows: NULLs, duplicates, and both routes of each."""

import random

import pytest
from pyspark.sql import functions as F

from layercake.operators import (
    insert_missing,
    keep_first,
    keep_least,
    merge_into,
    update_where,
    upsert_non_null,
)
from layercake.schemas import SILVER

PLAYLISTS = "playlist_id long, name string, collaborative string, description string"
SLOTS = "playlist_id long, pos long, track_uri string, album_uri string"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def expect(frame, *expected):
    assert rows(frame) == sorted(expected, key=repr)


@pytest.fixture
def slots(spark):
    return lambda *data: spark.createDataFrame(list(data), SLOTS)


@pytest.fixture
def playlists(spark):
    return lambda *data: spark.createDataFrame(list(data), PLAYLISTS)


@pytest.mark.parametrize("small", [False, True])
def test_null_in_batch_keeps_or_overwrites(playlists, small):
    old, new = playlists((1, "a", "true", "x")), playlists((1, None, "false", None))
    keys = ["playlist_id"]
    expect(
        upsert_non_null(old, new, keys, old_unique=small),
        (1, "a", "false", "x"),
    )
    expect(
        merge_into(old, new, keys, SILVER["playlists"], target_unique=small),
        (1, None, "false", None),
    )


@pytest.mark.parametrize("small", [False, True])
def test_taken_slot(slots, small):
    old, new = slots((1, 0, "t1", "a1")), slots((1, 0, "t2", None))
    # The entry is replaced, except for what the batch leaves NULL.
    expect(
        upsert_non_null(old, new, ["playlist_id", "pos"], old_unique=small),
        (1, 0, "t2", "a1"),
    )
    # Keyed by track, both entries share the position.
    expect(
        merge_into(old, new, ["playlist_id", "track_uri"], old.columns, target_unique=small),
        (1, 0, "t1", "a1"),
        (1, 0, "t2", None),
    )


def test_merge_source_and_target_duplicates(slots):
    keys = ["playlist_id", "track_uri"]
    twice = slots((1, 5, "t1", "a"), (1, 0, "t1", "a"))
    expect(
        merge_into(slots(), twice, keys, twice.columns), (1, 0, "t1", "a")
    )
    old = slots((1, 0, "t1", "a"), (1, 3, "t1", "a"))
    new = slots((1, 7, "t1", "b"))
    expect(
        merge_into(old, new, keys, old.columns),
        (1, 7, "t1", "b"),
        (1, 7, "t1", "b"),
    )


@pytest.mark.parametrize("small", [False, True])
def test_merge_partial_columns(spark, small):
    schema = "playlist_id long, num long, dur long"
    gold = spark.createDataFrame([(1, 2, 5)], schema)
    source = spark.createDataFrame([(1, 9, 8), (2, 3, 4)], schema)
    expect(
        merge_into(gold, source, ["playlist_id"], ["playlist_id", "dur"], target_unique=small),
        (1, 2, 8),
        (2, None, 4),
    )


@pytest.mark.parametrize("small", [False, True])
def test_merge_never_matches_null_keys(playlists, small):
    old, new = playlists((None, "a", "true", "x")), playlists((None, "b", "true", "y"))
    expect(
        merge_into(old, new, ["playlist_id"], old.columns, target_unique=small),
        (None, "a", "true", "x"),
        (None, "b", "true", "y"),
    )


@pytest.mark.parametrize("small", [False, True])
def test_upsert_null_keys_keep_one_stored_row(slots, small):
    keys = ["playlist_id", "pos"]
    old = slots((1, None, "t1", None), (None, 2, "t3", "a"))
    new = slots(
        (1, None, "t2", "b"), (None, None, "t4", "c"), (None, 2, "t5", "a"), (0, 0, "t6", "z")
    )
    expect(
        upsert_non_null(old, new, keys, old_unique=small),
        (1, None, "t1", None),
        (None, 2, "t3", "a"),
        (None, None, "t4", "c"),
        (0, 0, "t6", "z"),
    )


def test_upsert_deduplicates_both_sides(slots):
    old = slots((1, 0, "t2", "a"), (1, 0, "t1", "b"), (1, 1, None, "a"), (1, 1, "t1", "a"))
    new = slots((1, 0, "t9", None), (1, 0, "t8", None))
    expect(
        upsert_non_null(old, new, ["playlist_id", "pos"]),
        (1, 0, "t8", "b"),
        (1, 1, "t1", "a"),
    )


def test_batch_lacking_a_column(spark, slots):
    old = slots((1, 0, "t1", "a1"))
    new = spark.createDataFrame([(1, 0, "t2"), (2, 0, "t3")], "playlist_id long, pos int, track_uri string")
    for unique in (False, True):
        expect(
            upsert_non_null(old, new, ["playlist_id", "pos"], unique),
            (1, 0, "t2", "a1"),
            (2, 0, "t3", None),
        )


def test_keep_first_prefers_stored_row_and_fills_missing_columns(spark):
    old = spark.createDataFrame([("u1", "z"), ("u2", None), (None, "q")], "uri string, name string")
    new = spark.createDataFrame([("u1",), ("u3",), (None,)], "uri string")
    expected = [("u1", "z"), ("u2", None), ("u3", None), (None, "q")]
    expect(keep_first([old, new], ["uri"]), *expected)
    expect(insert_missing(old, new, ["uri"]), *expected)


def test_keep_least_orders_nulls_last(spark):
    frame = spark.createDataFrame(
        [("k", None, 1), ("k", "b", 2), ("k", "b", None), (None, "x", 1), (None, "w", 5)],
        "k string, a string, b int",
    )
    for for_join in (False, True):
        expect(keep_least(frame, ["k"], for_join), ("k", "b", 2), (None, "w", 5))
    expect(keep_least(frame.select("k"), ["k"]), ("k",), (None,))


def test_update_where(playlists):
    table = playlists((1, "a", "false", "x"), (2, "b", "false", None), (None, "c", "true", "z"))
    updated = update_where(
        table, "playlist_id = 2", {"name": "concat(name, '!')", "collaborative": "true"}
    )
    expect(
        updated,
        (1, "a", "false", "x"),
        (2, "b!", "true", None),
        (None, "c", "true", "z"),
    )
    assert updated.schema["collaborative"].dataType.simpleString() == "string"
    # Every assignment sees the row as it was.
    swapped = update_where(
        table, F.col("playlist_id") == 1, {"name": "description", "description": "name"}
    )
    assert ("x", "a") in [(r["name"], r["description"]) for r in swapped.collect()]


def _random(spark, seed, n):
    pick = random.Random(seed)
    maybe = lambda values: pick.choice([*values, None])
    return spark.createDataFrame(
        [
            (maybe(range(6)), maybe(range(4)), maybe(["t1", "t2", "t3"]), maybe(["a1", "a2"]))
            for _ in range(n)
        ],
        SLOTS,
    )


def _brute_upsert(old, new, keys, columns):
    at = [columns.index(k) for k in keys]
    last = lambda row: [(v is None, v if v is not None else 0) for v in row]

    def least(data):
        best = {}
        for row in data:
            key = tuple(row[i] for i in at)
            if key not in best or last(row) < last(best[key]):
                best[key] = row
        return best

    stored, batch = least(old), least(new)
    result = dict(stored)
    for key, row in batch.items():
        if key not in stored:
            result[key] = row
        elif None not in key:
            result[key] = tuple(n if n is not None else o for n, o in zip(row, stored[key]))
    return sorted(result.values(), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_upsert_equals_brute_force_by_every_route(spark, seed):
    keys, old, new = ["playlist_id", "pos"], _random(spark, seed, 60), _random(spark, seed + 9, 40)
    expected = _brute_upsert(
        [tuple(r) for r in old.collect()], [tuple(r) for r in new.collect()], keys, old.columns
    )
    merged = upsert_non_null(old, new, keys)
    assert rows(merged) == expected
    stored = keep_least(old, keys)
    assert rows(upsert_non_null(stored, new, keys, True)) == expected
    # A batch applied twice changes nothing more.
    assert rows(upsert_non_null(merged, new, keys, old_unique=True)) == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_dimension_routes_agree(spark, seed):
    old, new = _random(spark, seed, 40), _random(spark, seed + 9, 40)
    expected = rows(keep_first([old, new], ["track_uri"]))
    stored = keep_least(old, ["track_uri"])
    assert rows(insert_missing(stored, new, ["track_uri"])) == expected
    assert len({r[2] for r in expected}) == len(expected)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("unique", [False, True])
def test_merge_equals_brute_force(spark, seed, unique):
    keys, old, new = ["playlist_id", "track_uri"], _random(spark, seed, 60), _random(spark, seed + 9, 40)
    old = keep_least(old, keys) if unique else old
    source = {(r[0], r[2]): tuple(r) for r in keep_least(new, keys).collect()}
    target = [tuple(r) for r in old.collect()]
    match = lambda r: None not in (r[0], r[2]) and (r[0], r[2]) in source
    expected = [source[r[0], r[2]] if match(r) else r for r in target]
    known = {(r[0], r[2]) for r in target}
    expected += [s for k, s in source.items() if None in k or k not in known]
    merged = merge_into(old, new, keys, old.columns, target_unique=unique)
    assert rows(merged) == sorted(expected, key=repr)


def test_unknown_columns_are_refused(playlists):
    old = playlists((1, "a", "true", "x"))
    with pytest.raises(ValueError, match="nmae"):
        update_where(old, "playlist_id = 1", {"nmae": "'x'"})
    for keys, update, insert in (
        (["id"], ["name"], None),
        (["playlist_id"], ["nmae"], ["name"]),
        (["playlist_id"], ["name"], ["nmae"]),
    ):
        with pytest.raises(ValueError, match="id|nmae"):
            merge_into(old, old, keys, update, insert)
    lacking = old.drop("description")
    with pytest.raises(ValueError, match="description"):
        merge_into(old, lacking, ["playlist_id"], old.columns)
