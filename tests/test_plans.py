"""Physical plans: what is split, combined early, pushed down or not shuffled."""

import pytest
from pyspark.sql import functions as F

from layercake.operators import keep_first, keep_least, merge_into, upsert_non_null
from layercake.plans import gold

HOT = 7


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Entries with a third of the rows on one track, and on one playlist."""
    root = str(tmp_path_factory.mktemp("plans"))
    hot = lambda n, m: F.when(F.col("id") % 3 == n, F.lit(HOT)).otherwise(F.col("id") % m)
    entries = spark.range(120_000).select(
        hot(0, 4000).alias("playlist_id"),
        F.concat(F.lit("t"), hot(1, 5000)).alias("track_uri"),
        F.concat(F.lit("a"), F.col("id") % 500).alias("album_uri"),
        F.concat(F.lit("r"), F.col("id") % 50).alias("artist_uri"),
        F.col("id").alias("pos"),
        F.lit(1).cast("long").alias("duration_ms"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    entries.repartition(12).write.parquet(f"{root}/entries")
    return spark.read.parquet(f"{root}/entries")


@pytest.fixture
def shuffling(spark):
    """Joins cannot broadcast by themselves and partitions count as hot early."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.tail(1)
    return plan_of(frame).split("Initial Plan")[0]


def songs(entries):
    return entries.select(
        F.concat("track_uri", F.lit(" name")).alias("track_name"),
        "track_uri",
        "duration_ms",
        "album_uri",
        "artist_uri",
    )


def albums(entries):
    return entries.select("album_uri", F.col("album_uri").alias("album_name"), "artist_uri")


def artists(entries):
    return entries.select("artist_uri", F.col("artist_uri").alias("artist_name"))


@pytest.mark.parametrize("build", [gold.tracks_build, gold.tracks_rebuild, gold.tracks_fanout])
def test_hot_track_is_split(tables, shuffling, build):
    frame = build(tables, songs(tables), albums(tables), artists(tables))
    assert "SortMergeJoin(skew=true) [track_uri" in final_plan(frame)


def test_hot_null_track_is_split(tables, shuffling):
    gaps = tables.withColumn("track_uri", F.expr(f"nullif(track_uri, 't{HOT}')"))
    frame = gold.tracks_build(gaps, songs(tables), albums(tables), artists(tables))
    assert "SortMergeJoin(skew=true) [track_uri" in final_plan(frame)


def test_hot_raw_playlist_is_split(tables, shuffling):
    raw = tables.select(
        "playlist_id", F.col("filler").alias("name"), F.lit("true").alias("collaborative"),
        F.col("filler").alias("description"),
    )
    assert "SortMergeJoin(skew=true)" in final_plan(gold.playlists_build(tables, raw))


def test_hot_target_of_a_merge_is_split(tables, shuffling):
    merged = merge_into(tables, tables.limit(50_000), ["playlist_id"], tables.columns)
    assert "SortMergeJoin(skew=true)" in final_plan(merged)


def test_hot_playlist_of_a_refresh_is_split(tables, shuffling):
    changed = tables.select("playlist_id").filter("playlist_id < 1000")
    names = (songs(tables), albums(tables), artists(tables))
    before = gold.tracks_rebuild(tables, *names)
    frame = gold.tracks_refresh(before, changed, tables, *names)
    plan = final_plan(frame)
    assert "SortMergeJoin(skew=true) [coalesce(playlist_id" in plan


def test_survivors_are_chosen_before_the_shuffle(tables):
    for frame in (
        keep_least(tables, ["track_uri"]),
        keep_first([tables, tables], ["track_uri"]),
        upsert_non_null(tables, tables, ["playlist_id", "pos"]),
    ):
        lines = plan_of(frame).splitlines()
        shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
        assert shuffles
        for i in shuffles:
            assert "WindowGroupLimit" in lines[i + 1] and "Partial" in lines[i + 1]


def test_upsert_adds_no_exchange_to_the_deduplication(tables, shuffling):
    plan = plan_of(upsert_non_null(tables, tables, ["playlist_id", "pos"]))
    assert plan.count("Exchange") == 2 and "FullOuter" in plan


def test_summary_is_spread_by_uri_before_the_playlist(tables):
    lines = [line for line in plan_of(gold.summarise(tables)).splitlines() if "Exchange" in line]
    assert len(lines) == 2
    assert "track_uri" in lines[1] and "artist_uri" in lines[1] and "album_uri" in lines[1]


def test_summary_has_no_row_for_the_duration_alone(spark, tables):
    assert "Expand" not in plan_of(gold.summarise(tables))
    rows = [(1, "a", None, None, 5), (1, "a", "r", None, None), (1, None, "r", "x", 7), (None, None, None, None, None)]
    names = "playlist_id long, track_uri string, artist_uri string, album_uri string, duration_ms long"
    found = gold.summarise(spark.createDataFrame(rows, names)).collect()
    assert {tuple(r) for r in found} == {(1, 1, 1, 1, 12), (None, 0, 0, 0, None)}


def test_keys_of_whole_tables_are_not_broadcast(tables):
    raw = tables.select(
        "playlist_id", F.lit("n").alias("name"), F.lit("true").alias("collaborative"), F.lit("d").alias("description")
    )
    assert "Broadcast" not in plan_of(gold.playlists_build(tables, raw))
    merged = plan_of(merge_into(tables, tables, ["playlist_id"], tables.columns))
    (anti,) = [line for line in merged.splitlines() if "LeftAnti" in line]
    assert "SortMergeJoin" in anti


def test_merge_into_a_unique_target_reads_each_side_once(tables, shuffling):
    batch = tables.limit(10)
    keys = ["playlist_id", "track_uri"]
    plan = plan_of(merge_into(tables, batch, keys, tables.columns, target_unique=True))
    assert plan.count("FullOuter") >= 1 and "LeftAnti" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(tables):
    plan = plan_of(tables.filter("playlist_id = 3").select("playlist_id", "pos"))
    assert "EqualTo(playlist_id,3)" in plan
    assert "ReadSchema: struct<playlist_id:bigint,pos:bigint>" in plan
    summary = plan_of(gold.summarise(tables))
    assert "filler" not in summary


def test_uses_are_brought_up_to_date_with_one_shuffle(tables):
    uses = gold.uses_build(tables)
    entries = tables.drop("filler")
    changed = upsert_non_null(entries, entries.withColumn("duration_ms", F.lit(2).cast("long")), ["playlist_id", "pos"], changes=True)
    alone = [plan_of(f).count("Exchange hashpartitioning") for f in (uses, changed, gold.uses_refresh(uses, changed))]
    assert alone[2] == alone[0] + alone[1] + 1
