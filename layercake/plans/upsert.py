"""Applying a later batch to the silver layer."""

from layercake.operators import CHANGE, insert_missing, keep_first, merge_into, missing, upsert_non_null
from layercake.plans import silver
from layercake.schemas import ENTRY_MERGE_KEYS, SILVER, SILVER_KEYS

# Dimensions keep the stored row; the other two take the batch's non-NULL values.
DIMENSIONS = ("songs", "albums", "artists")


def upsert_table(name, old, new, unique=False, changes=False):
    """The new version of one silver table; its rows are unique on ``SILVER_KEYS``.

    ``unique`` says that ``old`` already is, which spares its deduplication. ``changes`` adds the
    column ``CHANGE`` of ``upsert_non_null`` to a table that takes the batch's values.
    """
    keys = SILVER_KEYS[name]
    if name not in DIMENSIONS:
        merged = upsert_non_null(old, new, keys, old_unique=unique, changes=changes)
        if changes:
            return merged.select(*SILVER[name], CHANGE)
    elif unique:
        merged = insert_missing(old, new, keys)
    else:
        merged = keep_first([old, new], keys)
    return merged.select(*SILVER[name])


def new_rows(name, old, new):
    """What a batch adds to a dimension that is unique: its rows whose key is not stored."""
    return missing(old, new.select(*SILVER[name]), SILVER_KEYS[name])


def upsert_silver(tables, raw_playlists, raw_tracks, unique=()):
    """All five silver tables after a batch.

    ``unique`` names the stored tables that are unique on their key already.
    """
    batch = silver.build(raw_playlists, raw_tracks)
    return {
        name: upsert_table(name, tables[name], batch[name], name in unique)
        for name in SILVER
    }


# The tables a MERGE batch changes, with the keys it matches on.
MERGE_KEYS = {"playlists": ["playlist_id"], "playlist_tracks": ENTRY_MERGE_KEYS}


def merge_table(name, old, new, unique=False):
    """The new version of one silver table under MERGE.

    Entries are keyed by playlist and track, so a moved track changes position
    instead of taking another entry's place, and NULLs of the batch overwrite.
    ``unique`` says that ``old`` is unique on these keys.
    """
    return merge_into(old, new, MERGE_KEYS[name], SILVER[name], target_unique=unique)


def merge_silver(tables, raw_playlists, raw_tracks, unique=()):
    """The two silver tables a MERGE batch changes; the other three stay as they are."""
    batch = {
        "playlists": silver.playlists(raw_playlists),
        "playlist_tracks": silver.playlist_tracks(raw_tracks),
    }
    return {
        name: merge_table(name, tables[name], batch[name], name in unique)
        for name in MERGE_KEYS
    }
