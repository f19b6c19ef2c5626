"""One query per operator or composite job, each over the whole given tables."""

from pyspark.sql import functions as F

from layercake.catalog import fixtures as fx
from layercake.operators import keep_least, update_where
from layercake.plans import gold, jobs, silver, upsert
from layercake.schemas import RAW_PLAYLISTS, SILVER_KEYS
from layercake.sources import (
    Lake,
    export_json,
    inventory,
    new_folder,
    preview,
    read_json,
    read_table,
    stage,
    storage_report,
    write_table,
)

# The playlist that is looked up and patched, and its new name.
PLAYLIST = 996
NEW_NAME = "Late shift"


def _raw(spark, sf_dir):
    return {"playlists": fx.playlists(spark, sf_dir), "tracks": fx.tracks(spark, sf_dir)}


def _stored(spark, sf_dir):
    """The raw inputs with the tracks written out.

    For queries that read the tracks three times or more: as in a lake, they then
    scan the columns they need instead of repeating the join the tracks come from.
    """
    raw = _raw(spark, sf_dir)
    return {**raw, "tracks": stage(spark, raw["tracks"], "raw-tracks")}


def _table(raw, name, batch=1):
    """One silver table of one batch."""
    if name == "playlists":
        return silver.playlists(fx.playlists_batch(raw["playlists"], batch))
    return getattr(silver, name)(fx.tracks_batch(raw["tracks"], batch))


def _merged(raw, name):
    """One silver table after batch 2 was upserted into batch 1."""
    return upsert.upsert_table(name, _table(raw, name, 1), _table(raw, name, 2))


def _merged_by_key(raw, name):
    """One silver table after batch 3 was merged into batch 1 with MERGE semantics."""
    return upsert.merge_table(name, _table(raw, name, 1), _table(raw, name, 3))


# Sources and sinks


def scan_json(spark, sf_dir):
    path = new_folder(spark, "scan-json")
    export_json(fx.playlists(spark, sf_dir), path)
    return read_json(spark, path, RAW_PLAYLISTS)


def scan_parquet(spark, sf_dir):
    return fx.playlists(spark, sf_dir)


def write_roundtrip(spark, sf_dir):
    path = new_folder(spark, "write-roundtrip")
    albums = silver.albums(fx.tracks(spark, sf_dir))
    write_table(albums, path)
    return read_table(spark, path, schema=albums.schema)


def replace_in_place(spark, sf_dir):
    lake = Lake(spark, new_folder(spark, "replace-in-place"))
    table = "silver/playlists"
    lake.publish({table: silver.playlists(fx.playlists(spark, sf_dir))})
    batch = silver.playlists(fx.playlists_batch(fx.playlists(spark, sf_dir), 2))
    lake.publish({table: upsert.upsert_table("playlists", lake.read(table), batch)})
    return lake.read(table)


def storage(spark, sf_dir):
    """What of the report does not depend on the file format: layers, tables, and sums."""
    lake = Lake(spark, new_folder(spark, "storage-report"))
    jobs.ingest_bronze(lake, fx.playlists(spark, sf_dir), fx.tracks(spark, sf_dir))
    jobs.build_silver(lake)
    jobs.build_gold(lake)
    report = storage_report(lake)
    parts = report.where("layer <> 'total'").agg(F.sum("bytes").alias("sum"), F.sum("tables").alias("n"))
    (whole,) = parts.collect()  # one row
    total = F.col("layer") == "total"
    adds_up = ~total | ((F.col("bytes") == whole["sum"]) & (F.col("tables") == whole["n"]))
    return report.select(
        "layer", "tables", (F.col("size_mib") > 0).alias("has_files"), adds_up.alias("adds_up")
    )


def guarded_read(spark, sf_dir):
    """The tables of a lake that has bronze and silver, and one that it lacks."""
    lake = Lake(spark, new_folder(spark, "guarded-read"))
    jobs.ingest_bronze(lake, fx.playlists(spark, sf_dir), fx.tracks(spark, sf_dir))
    jobs.build_silver(lake)
    return inventory(lake, ["bronze/tracks", "silver/playlists", "silver/albums", "gold/playlists"])


# Bronze and silver


def bronze_tracks(spark, sf_dir):
    lake = Lake(spark, new_folder(spark, "bronze"))
    jobs.ingest_bronze(lake, fx.playlists(spark, sf_dir), fx.tracks(spark, sf_dir))
    return lake.read("bronze/tracks")


def silver_songs(spark, sf_dir):
    return silver.songs(fx.tracks(spark, sf_dir))


def silver_albums(spark, sf_dir):
    return silver.albums(fx.tracks(spark, sf_dir))


def silver_artists(spark, sf_dir):
    return silver.artists(fx.tracks(spark, sf_dir))


def silver_playlists(spark, sf_dir):
    return silver.playlists(fx.playlists(spark, sf_dir))


def silver_playlist_tracks(spark, sf_dir):
    return silver.playlist_tracks(fx.tracks(spark, sf_dir))


# Rows and sets


def point_lookup(spark, sf_dir):
    return silver_playlists(spark, sf_dir).filter(F.col("playlist_id") == PLAYLIST)


def patch_rows(spark, sf_dir):
    return update_where(
        fx.playlists_batch(fx.playlists(spark, sf_dir), 2),
        F.col("pid") == PLAYLIST,
        {"name": F.lit(NEW_NAME), "collaborative": F.lit("True")},
    )


def update_silver(spark, sf_dir):
    return update_where(
        silver_playlists(spark, sf_dir),
        f"playlist_id = {PLAYLIST}",
        {"name": f"'{NEW_NAME}'", "collaborative": "true"},
    )


def table_preview(spark, sf_dir):
    return preview(silver_playlists(spark, sf_dir), ["playlist_id"])


def union_by_name(spark, sf_dir):
    fewer = silver.albums(fx.tracks_batch(fx.tracks(spark, sf_dir), 2)).drop("album_name")
    return silver_albums(spark, sf_dir).unionByName(fewer, allowMissingColumns=True)


def dedup_by_key(spark, sf_dir):
    return keep_least(silver_songs(spark, sf_dir), SILVER_KEYS["songs"])


def dedup_by_composite_key(spark, sf_dir):
    return keep_least(silver_playlist_tracks(spark, sf_dir), SILVER_KEYS["playlist_tracks"])


# Gold


def agg_playlist(spark, sf_dir):
    return gold.summarise(silver_playlist_tracks(spark, sf_dir))


def gold_playlists_build(spark, sf_dir):
    return gold.playlists_build(
        silver_playlist_tracks(spark, sf_dir), silver_playlists(spark, sf_dir)
    )


def _entries_and_dimensions(raw, table):
    return [table(raw, name) for name in ("playlist_tracks", *upsert.DIMENSIONS)]


def gold_tracks_build(spark, sf_dir):
    return gold.tracks_build(*_entries_and_dimensions(_stored(spark, sf_dir), _table))


def gold_tracks_fanout(spark, sf_dir):
    return gold.tracks_fanout(*_entries_and_dimensions(_stored(spark, sf_dir), _table))


def gold_playlists_rebuild(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return gold.playlists_rebuild(_merged(raw, "playlist_tracks"), _merged(raw, "playlists"))


def gold_tracks_rebuild(spark, sf_dir):
    return gold.tracks_rebuild(*_entries_and_dimensions(_stored(spark, sf_dir), _merged))


# Upserts


def _upsert(name):
    return lambda spark, sf_dir: _merged(_raw(spark, sf_dir), name)


def merge_generic(spark, sf_dir):
    """MERGE into a stored table, from a stored batch."""
    raw = _raw(spark, sf_dir)
    old, new = (stage(spark, _table(raw, "playlist_tracks", n), f"entries-{n}") for n in (1, 3))
    return upsert.merge_table("playlist_tracks", old, new)


def merge_generic_playlists(spark, sf_dir):
    return _merged_by_key(_raw(spark, sf_dir), "playlists")


def merge_partial_columns(spark, sf_dir):
    raw = _stored(spark, sf_dir)
    old, new = (stage(spark, _table(raw, "playlist_tracks", n), f"entries-{n}") for n in (1, 3))
    built = gold.playlists_build(old, _table(raw, "playlists"))
    before = stage(spark, built, "gold-before")
    merged = upsert.merge_table("playlist_tracks", old, new)
    source = gold.merge_source(merged, _merged_by_key(raw, "playlists"))
    fresh = stage(spark, source, "gold-fresh")
    return gold.playlists_merge(before, fresh, gold.MERGE_COLUMNS)


def patch_then_merge(spark, sf_dir):
    path = new_folder(spark, "patched-playlists")
    export_json(patch_rows(spark, sf_dir), path)
    batch = silver.playlists(read_json(spark, path, RAW_PLAYLISTS))
    return upsert.upsert_table("playlists", silver_playlists(spark, sf_dir), batch)


def three_batches(spark, sf_dir):
    """gold.playlists after batches 1, 2 and 3 were applied in turn."""
    raw = _raw(spark, sf_dir)
    tables = {
        name: upsert.upsert_table(name, _merged(raw, name), _table(raw, name, 3), unique=True)
        for name in ("playlists", "playlist_tracks")
    }
    return gold.playlists_rebuild(tables["playlist_tracks"], tables["playlists"])


# The jobs, from JSON lines to the table that is current at the end


def _lake(spark, sf_dir, *batches):
    """A lake after the first build and the given upserted batches, and the paths of all batches."""
    playlists, tracks = (_stored if len(batches) > 1 else _raw)(spark, sf_dir).values()
    paths = {}
    for n in (1, *batches):
        paths[n] = (new_folder(spark, f"json-playlists-{n}"), new_folder(spark, f"json-tracks-{n}"))
        export_json(fx.playlists_batch(playlists, n), paths[n][0])
        export_json(fx.tracks_batch(tracks, n), paths[n][1])
    lake = Lake(spark, new_folder(spark, "lake"))
    jobs.build_lake(lake, *paths[1])
    return lake, paths


def _upserted(spark, sf_dir):
    """A lake after three batches; the third refreshes gold instead of rebuilding it."""
    lake, paths = _lake(spark, sf_dir, 2, 3)
    jobs.upsert_batch(lake, *paths[2])
    jobs.upsert_batch(lake, *paths[3])
    return lake


def job_upsert_playlists(spark, sf_dir):
    return _upserted(spark, sf_dir).read("gold/playlists")


def job_upsert_tracks(spark, sf_dir):
    return _upserted(spark, sf_dir).read("gold/playlist_tracks")


def job_merge_playlists(spark, sf_dir):
    lake, paths = _lake(spark, sf_dir, 3)
    jobs.merge_batch(lake, *paths[3], columns=gold.MERGE_COLUMNS)
    return lake.read("gold/playlists")


def job_upsert_again(spark, sf_dir):
    """Gold after a batch that comes twice: the second time nothing differs and nothing is written."""
    lake, paths = _lake(spark, sf_dir, 2)
    jobs.upsert_batch(lake, *paths[2])
    before = lake.entries()
    jobs.upsert_batch(lake, *paths[2])
    after = lake.entries()
    moved = [t for t in before if before[t].parts != after[t].parts or before[t].path and not before[t].parts]
    kept = F.lit(all(t.startswith("bronze/") for t in moved))
    return lake.read("gold/playlists").withColumn("kept", kept)


def gold_uses(spark, sf_dir):
    """Playlists by their counts, from the uses of entries that were brought up to date by batches."""
    lake = _upserted(spark, sf_dir)
    return gold.summarise_uses(lake.read(jobs.USES))


def point_update_gold(spark, sf_dir):
    lake, _ = _lake(spark, sf_dir)
    patch = {"name": f"'{NEW_NAME}'", "collaborative": "'true'"}
    jobs.point_update(lake, f"playlist_id = {PLAYLIST}", patch)
    return lake.read("gold/playlists")


def _refresh_inputs(spark, sf_dir, names):
    """Silver tables after batch 1 and 2 and after batch 3 as well, and the ids of batch 3."""
    raw = _stored(spark, sf_dir)
    old = {n: stage(spark, _merged(raw, n), f"silver-{n}") for n in names}
    # Read once by the refresh, so not written out.
    new = {n: upsert.upsert_table(n, old[n], _table(raw, n, 3), unique=True) for n in names}
    ids = [_table(raw, n, 3).select("playlist_id") for n in ("playlists", "playlist_tracks")]
    return old, new, ids[0].unionByName(ids[1])


def gold_playlists_refresh(spark, sf_dir):
    names = ("playlist_tracks", "playlists")
    old, new, ids = _refresh_inputs(spark, sf_dir, names)
    return gold.playlists_refresh(
        gold.playlists_rebuild(*(old[n] for n in names)), ids, *(new[n] for n in names)
    )


def gold_tracks_refresh(spark, sf_dir):
    names = ("playlist_tracks", *upsert.DIMENSIONS)
    old, new, ids = _refresh_inputs(spark, sf_dir, names)
    return gold.tracks_refresh(
        gold.tracks_rebuild(*(old[n] for n in names)), ids, *(new[n] for n in names)
    )


QUERIES = {
    "scan_json": scan_json,
    "scan_parquet": scan_parquet,
    "write_roundtrip": write_roundtrip,
    "replace_in_place": replace_in_place,
    "storage_report": storage,
    "guarded_read": guarded_read,
    "bronze_tracks": bronze_tracks,
    "silver_songs": silver_songs,
    "silver_albums": silver_albums,
    "silver_artists": silver_artists,
    "silver_playlists": silver_playlists,
    "silver_playlist_tracks": silver_playlist_tracks,
    "point_lookup": point_lookup,
    "patch_rows": patch_rows,
    "update_where": update_silver,
    "table_preview": table_preview,
    "union_by_name": union_by_name,
    "dedup_by_key": dedup_by_key,
    "dedup_by_composite_key": dedup_by_composite_key,
    "agg_playlist": agg_playlist,
    "gold_playlists_build": gold_playlists_build,
    "gold_tracks_build": gold_tracks_build,
    "gold_tracks_fanout": gold_tracks_fanout,
    "gold_playlists_rebuild": gold_playlists_rebuild,
    "gold_tracks_rebuild": gold_tracks_rebuild,
    "merge_songs": _upsert("songs"),
    "merge_albums": _upsert("albums"),
    "merge_artists": _upsert("artists"),
    "merge_playlists": _upsert("playlists"),
    "merge_slots": _upsert("playlist_tracks"),
    "merge_generic": merge_generic,
    "merge_generic_playlists": merge_generic_playlists,
    "merge_partial_columns": merge_partial_columns,
    "patch_then_merge": patch_then_merge,
    "three_batches": three_batches,
    "gold_playlists_refresh": gold_playlists_refresh,
    "gold_tracks_refresh": gold_tracks_refresh,
    "job_upsert_playlists": job_upsert_playlists,
    "job_upsert_tracks": job_upsert_tracks,
    "job_merge_playlists": job_merge_playlists,
    "job_upsert_again": job_upsert_again,
    "gold_uses": gold_uses,
    "point_update_gold": point_update_gold,
}
