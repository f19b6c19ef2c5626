"""The same queries as plain SQL, written independently of the DataFrame code."""

from layercake.catalog.fixtures import CTES
from layercake.catalog.queries import NEW_NAME, PLAYLIST


def _silver_ctes(n):
    return f"""
songs_{n} AS (SELECT track_name, track_uri, duration_ms, album_uri, artist_uri FROM tracks_{n}),
albums_{n} AS (SELECT DISTINCT album_uri, album_name, artist_uri FROM tracks_{n}),
artists_{n} AS (SELECT DISTINCT artist_uri, artist_name FROM tracks_{n}),
plists_{n} AS (SELECT pid AS playlist_id, name, collaborative, description FROM playlists_{n}),
entries_{n} AS (
  SELECT pid AS playlist_id, track_uri, album_uri, artist_uri, pos, duration_ms FROM tracks_{n})"""


def _least(table, keys, order):
    ordering = ", ".join(f"{c} NULLS LAST" for c in order.split(", "))
    return (
        f"(SELECT * FROM {table}"
        f" QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {ordering}) = 1)"
    )


def _first(old, new, columns, keys, order):
    ordering = ", ".join(f"{c} NULLS LAST" for c in order.split(", "))
    return f"""SELECT {columns} FROM (
  SELECT 0 AS side, {columns} FROM {old} UNION ALL SELECT 1 AS side, {columns} FROM {new})
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY side, {ordering}) = 1"""


_PLAYLIST = "name, collaborative, description"
_ENTRY = "track_uri, album_uri, artist_uri, duration_ms"


def _upsert_playlists(old, new):
    return f"""SELECT coalesce(n.playlist_id, o.playlist_id) AS playlist_id,
  coalesce(n.name, o.name) AS name, coalesce(n.collaborative, o.collaborative) AS collaborative,
  coalesce(n.description, o.description) AS description
FROM {_least(old, "playlist_id", _PLAYLIST)} o
FULL JOIN {_least(new, "playlist_id", _PLAYLIST)} n ON o.playlist_id = n.playlist_id"""


def _upsert_entries(old, new):
    return f"""SELECT coalesce(n.playlist_id, o.playlist_id) AS playlist_id,
  coalesce(n.track_uri, o.track_uri) AS track_uri, coalesce(n.album_uri, o.album_uri) AS album_uri,
  coalesce(n.artist_uri, o.artist_uri) AS artist_uri, coalesce(n.pos, o.pos) AS pos,
  coalesce(n.duration_ms, o.duration_ms) AS duration_ms
FROM {_least(old, "playlist_id, pos", _ENTRY)} o
FULL JOIN {_least(new, "playlist_id, pos", _ENTRY)} n
  ON o.playlist_id = n.playlist_id AND o.pos = n.pos"""


def _merge(target, source, keys, columns, updated=None):
    columns = columns.split(", ")
    updated = columns if updated is None else updated.split(", ")
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys.split(", "))
    key = keys.split(", ")[0]
    setters = ", ".join(
        f"CASE WHEN s.{key} IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
        if c in updated
        else f"t.{c} AS {c}"
        for c in columns
    )
    values = ", ".join(f"s.{c}" if c in updated else f"NULL AS {c}" for c in columns)
    return f"""SELECT {setters} FROM {target} t LEFT JOIN {source} s ON {on}
UNION ALL SELECT {values} FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})"""


def _summary(entries):
    return f"""(SELECT playlist_id, count(DISTINCT track_uri) AS num_tracks,
  count(DISTINCT artist_uri) AS num_artists, count(DISTINCT album_uri) AS num_albums,
  CAST(sum(duration_ms) AS BIGINT) AS total_duration_ms FROM {entries} GROUP BY playlist_id)"""


def _gold(entries, plists, join):
    return f"""SELECT g.*, p.name, p.collaborative, p.description
FROM {_summary(entries)} g {join} JOIN {plists} p ON g.playlist_id = p.playlist_id"""


def _with(body, *extra):
    """``body`` with the fixture and silver CTEs in front of it, then ``extra`` ones."""
    ctes = [CTES] + [_silver_ctes(n) for n in (1, 2, 3)] + list(extra)
    return "WITH " + ",".join(ctes) + "\n" + body


_M4_KEYS = "playlist_id, track_uri"
_SONG = "track_name, track_uri, duration_ms, album_uri, artist_uri"
_ALBUM = "album_uri, album_name, artist_uri"
_ARTIST = "artist_uri, artist_name"
_PLIST_COLUMNS = "playlist_id, name, collaborative, description"
_ENTRY_COLUMNS = "playlist_id, track_uri, album_uri, artist_uri, pos, duration_ms"
_GOLD_COLUMNS = (
    "playlist_id, num_tracks, num_artists, num_albums, total_duration_ms, "
    "name, collaborative, description"
)

_songs_12 = _first("songs_1", "songs_2", _SONG, "track_uri", "track_name, duration_ms, album_uri, artist_uri")
_albums_12 = _first("albums_1", "albums_2", _ALBUM, "album_uri", "album_name, artist_uri")
_artists_12 = _first("artists_1", "artists_2", _ARTIST, "artist_uri", "artist_name")
_plists_12 = f"plists_12 AS ({_upsert_playlists('plists_1', 'plists_2')})"
_entries_12 = f"entries_12 AS ({_upsert_entries('entries_1', 'entries_2')})"

_merged_entries = _merge(
    "entries_1",
    _least("entries_3", _M4_KEYS, "album_uri, artist_uri, pos, duration_ms"),
    _M4_KEYS,
    _ENTRY_COLUMNS,
)
_merged_plists = _merge(
    "plists_1", _least("plists_3", "playlist_id", _PLAYLIST), "playlist_id", _PLIST_COLUMNS
)

_patched = f"""SELECT pid,
  CASE WHEN pid = {PLAYLIST} THEN '{NEW_NAME}' ELSE name END AS name,
  CASE WHEN pid = {PLAYLIST} THEN 'True' ELSE collaborative END AS collaborative,
  description FROM playlists_2"""

_GOLD_TRACKS = "e.playlist_id, e.pos, s.track_name, a.album_name, r.artist_name"

ORACLES = {
    "scan_json": _with("SELECT * FROM playlists_1"),
    "scan_parquet": _with("SELECT * FROM playlists_1"),
    "write_roundtrip": _with("SELECT * FROM albums_1"),
    "replace_in_place": _with(_upsert_playlists("plists_1", "plists_2")),
    "bronze_tracks": _with("SELECT * FROM tracks_1"),
    "silver_songs": _with("SELECT * FROM songs_1"),
    "silver_albums": _with("SELECT * FROM albums_1"),
    "silver_artists": _with("SELECT * FROM artists_1"),
    "silver_playlists": _with("SELECT * FROM plists_1"),
    "silver_playlist_tracks": _with("SELECT * FROM entries_1"),
    "point_lookup": _with(f"SELECT * FROM plists_1 WHERE playlist_id = {PLAYLIST}"),
    "patch_rows": _with(_patched),
    "update_where": _with(
        f"""SELECT playlist_id,
  CASE WHEN playlist_id = {PLAYLIST} THEN '{NEW_NAME}' ELSE name END AS name,
  CASE WHEN playlist_id = {PLAYLIST} THEN 'true' ELSE collaborative END AS collaborative,
  description FROM plists_1"""
    ),
    "table_preview": _with("SELECT * FROM plists_1 ORDER BY playlist_id NULLS LAST LIMIT 10"),
    "union_by_name": _with(
        """SELECT album_uri, album_name, artist_uri FROM albums_1
UNION ALL SELECT album_uri, NULL AS album_name, artist_uri
FROM (SELECT DISTINCT album_uri, album_name, artist_uri FROM tracks_2)"""
    ),
    "dedup_by_key": _with(
        f"SELECT * FROM {_least('songs_1', 'track_uri', 'track_name, duration_ms, album_uri, artist_uri')}"
    ),
    "dedup_by_composite_key": _with(
        f"SELECT * FROM {_least('entries_1', 'playlist_id, pos', _ENTRY)}"
    ),
    "agg_playlist": _with(f"SELECT * FROM {_summary('entries_1')}"),
    "gold_playlists_build": _with(_gold("entries_1", "plists_1", "LEFT")),
    "gold_tracks_build": _with(
        f"""SELECT {_GOLD_TRACKS} FROM entries_1 e
LEFT JOIN {_least("songs_1", "track_uri", "track_name, duration_ms, album_uri, artist_uri")} s
  ON e.track_uri = s.track_uri
LEFT JOIN {_least("albums_1", "album_uri", "album_name, artist_uri")} a
  ON e.album_uri = a.album_uri
LEFT JOIN {_least("artists_1", "artist_uri", "artist_name")} r ON e.artist_uri = r.artist_uri"""
    ),
    "gold_tracks_fanout": _with(
        f"""SELECT playlist_id, pos, track_name, album_name, artist_name, count(*) AS copies
FROM (SELECT e.id, {_GOLD_TRACKS}
  FROM (SELECT *, row_number() OVER () AS id FROM entries_1) e
  LEFT JOIN songs_1 s ON e.track_uri = s.track_uri
  LEFT JOIN albums_1 a ON e.album_uri = a.album_uri
  LEFT JOIN artists_1 r ON e.artist_uri = r.artist_uri)
GROUP BY id, playlist_id, pos, track_name, album_name, artist_name"""
    ),
    "gold_playlists_rebuild": _with(
        _gold("entries_12", "plists_12", "INNER"), _plists_12, _entries_12
    ),
    "gold_tracks_rebuild": _with(
        f"""SELECT {_GOLD_TRACKS} FROM entries_12 e
JOIN ({_songs_12}) s ON e.track_uri = s.track_uri
JOIN ({_albums_12}) a ON e.album_uri = a.album_uri
JOIN ({_artists_12}) r ON e.artist_uri = r.artist_uri""",
        _entries_12,
    ),
    "merge_songs": _with(_songs_12),
    "merge_albums": _with(_albums_12),
    "merge_artists": _with(_artists_12),
    "merge_playlists": _with(_upsert_playlists("plists_1", "plists_2")),
    "merge_slots": _with(_upsert_entries("entries_1", "entries_2")),
    "merge_generic": _with(_merged_entries),
    "merge_generic_playlists": _with(_merged_plists),
    "merge_partial_columns": _with(
        _merge(
            "gold_1",
            f"({_gold('merged_entries', 'merged_plists', 'INNER')})",
            "playlist_id",
            _GOLD_COLUMNS,
            "playlist_id, total_duration_ms, name, collaborative, description",
        ),
        f"merged_entries AS ({_merged_entries})",
        f"merged_plists AS ({_merged_plists})",
        f"gold_1 AS ({_gold('entries_1', 'plists_1', 'LEFT')})",
    ),
    "patch_then_merge": _with(
        _upsert_playlists("plists_1", "patched"),
        f"patched AS (SELECT pid AS playlist_id, name, collaborative, description FROM ({_patched}))",
    ),
    "three_batches": _with(
        _gold("entries_123", "plists_123", "INNER"),
        _plists_12,
        _entries_12,
        f"plists_123 AS ({_upsert_playlists('plists_12', 'plists_3')})",
        f"entries_123 AS ({_upsert_entries('entries_12', 'entries_3')})",
    ),
}

_entries_123 = f"entries_123 AS ({_upsert_entries('entries_12', 'entries_3')})"
_dimensions_123 = [
    f"songs_12 AS ({_songs_12})",
    f"albums_12 AS ({_albums_12})",
    f"artists_12 AS ({_artists_12})",
    f"songs_123 AS ({_first('songs_12', 'songs_3', _SONG, 'track_uri', 'track_name, duration_ms, album_uri, artist_uri')})",
    f"albums_123 AS ({_first('albums_12', 'albums_3', _ALBUM, 'album_uri', 'album_name, artist_uri')})",
    f"artists_123 AS ({_first('artists_12', 'artists_3', _ARTIST, 'artist_uri', 'artist_name')})",
]
_tracks_123 = _with(
    f"""SELECT {_GOLD_TRACKS} FROM entries_123 e
JOIN songs_123 s ON e.track_uri = s.track_uri
JOIN albums_123 a ON e.album_uri = a.album_uri
JOIN artists_123 r ON e.artist_uri = r.artist_uri""",
    _entries_12,
    _entries_123,
    *_dimensions_123,
)

ORACLES |= {
    "storage_report": """SELECT layer, tables, true AS has_files, true AS adds_up
FROM (VALUES ('bronze', 2::BIGINT), ('silver', 5), ('gold', 2), ('total', 9)) AS t(layer, tables)""",
    "guarded_read": _with(
        """SELECT * FROM (
  SELECT 'bronze/tracks' AS "table", true AS found,
    'pid, pos, track_uri, track_name, album_uri, album_name, artist_uri, artist_name, duration_ms' AS columns,
    (SELECT count(*) FROM tracks_1) AS rows
  UNION ALL SELECT 'silver/playlists', true, 'playlist_id, name, collaborative, description', (SELECT count(*) FROM plists_1)
  UNION ALL SELECT 'silver/albums', true, 'album_uri, album_name, artist_uri', (SELECT count(*) FROM albums_1)
  UNION ALL SELECT 'gold/playlists', false, NULL, NULL)"""
    ),
    "job_upsert_again": _with(
        f"""SELECT *, true AS kept FROM ({_gold("entries_12", "plists_12", "INNER")})""", _plists_12, _entries_12
    ),
    "gold_uses": _with(
        f"SELECT * FROM {_summary('entries_123')}", _plists_12, _entries_12, _entries_123
    ),
    # A refresh and a rebuild give the same table, and so do the jobs.
    "gold_playlists_refresh": ORACLES["three_batches"],
    "gold_tracks_refresh": _tracks_123,
    "job_upsert_playlists": ORACLES["three_batches"],
    "job_upsert_tracks": _tracks_123,
    "job_merge_playlists": ORACLES["merge_partial_columns"],
    "point_update_gold": _with(
        f"""SELECT g.* REPLACE (
  CASE WHEN playlist_id = {PLAYLIST} THEN '{NEW_NAME}' ELSE name END AS name,
  CASE WHEN playlist_id = {PLAYLIST} THEN 'true' ELSE collaborative END AS collaborative)
FROM ({_gold("entries_1", "plists_1", "LEFT")}) g"""
    ),
}
