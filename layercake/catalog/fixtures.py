"""The raw inputs of the checks, derived from the given tables.

An order stands for a playlist and its lines for the entries. Every batch is
derived from all orders and all lines; none leaves rows out.

* batch 1: the tables as they are;
* batch 2: even playlists are sent again, odd ones arrive under a new id. Names
  and durations change, some descriptions are NULL, and entries from position 5
  on (artists from 7 on) refer to tracks that batch 1 does not have;
* batch 3: playlists divisible by 3 are sent again, others hit batch 2's new ids
  or arrive under ids of their own. All become collaborative, every fifth has no
  name, and every entry moves on by one position.
"""

from layercake.schemas import RAW_TRACKS

# Fixed value: offset of the ids that only batch 3 has.
NEW_ID = 1_000_000_000_000

# The columns read. Declaring them spares a job per table that
# would look them up in the file footers.
_COLUMNS = {
    "orders": "o_orderkey long, o_orderstatus string, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double",
    "part": "p_partkey long, p_name string, p_brand string",
    "supplier": "s_suppkey long, s_name string",
}


def _read(spark, sf_dir, name):
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def playlists(spark, sf_dir):
    return _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS pid",
        "o_orderpriority AS name",
        "if(o_orderstatus = 'O', 'true', 'false') AS collaborative",
        "if(o_orderkey % 3 = 0, NULL, o_orderstatus) AS description",
    )


def tracks(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_partkey": "p_partkey", "l_suppkey": "s_suppkey"}
    )
    return (
        lines.join(_read(spark, sf_dir, "part"), "p_partkey")
        .join(_read(spark, sf_dir, "supplier"), "s_suppkey")
        .selectExpr(
            "l_orderkey AS pid",
            "CAST(l_linenumber AS BIGINT) AS pos",
            "'track:' || p_partkey AS track_uri",
            "p_name AS track_name",
            "'album:' || p_brand || ':' || s_suppkey AS album_uri",
            "p_brand || ' ' || s_name AS album_name",
            "'artist:' || s_suppkey AS artist_uri",
            "s_name AS artist_name",
            "CAST(l_quantity AS BIGINT) * 1000 AS duration_ms",
        )
    )


_SECOND_ID = "if(pid % 2 = 0, pid, -pid - 1) AS pid"
_THIRD_ID = f"CASE pid % 3 WHEN 0 THEN pid WHEN 1 THEN -pid - 1 ELSE pid + {NEW_ID} END AS pid"


def _playlists_2(raw):
    return raw.selectExpr(
        _SECOND_ID,
        "name || ' v2' AS name",
        "collaborative",
        "if(pid % 4 = 0, NULL, description) AS description",
    )


def _tracks_2(raw):
    return raw.selectExpr(
        _SECOND_ID,
        "pos",
        "if(pos >= 5, track_uri || ':live', track_uri) AS track_uri",
        "if(pos >= 5, track_name || ' (live)', track_name) AS track_name",
        "if(pos >= 5, album_uri || ':live', album_uri) AS album_uri",
        "if(pos >= 5, album_name || ' (live)', album_name) AS album_name",
        "if(pos >= 7, artist_uri || ':guest', artist_uri) AS artist_uri",
        "if(pos >= 7, artist_name || ' (guest)', artist_name) AS artist_name",
        "duration_ms + 1 AS duration_ms",
    )


def _playlists_3(raw):
    return raw.selectExpr(
        _THIRD_ID, "if(pid % 5 = 0, NULL, name) AS name", "'true' AS collaborative", "description"
    )


def _tracks_3(raw):
    columns = [f.name for f in RAW_TRACKS if f.name not in ("pid", "pos")]
    return raw.selectExpr(_THIRD_ID, "pos + 1 AS pos", *columns)


def playlists_batch(raw, n):
    """Batch ``n`` of the raw playlists, derived from batch 1."""
    return {1: lambda df: df, 2: _playlists_2, 3: _playlists_3}[n](raw)


def tracks_batch(raw, n):
    """Batch ``n`` of the raw tracks, derived from batch 1."""
    return {1: lambda df: df, 2: _tracks_2, 3: _tracks_3}[n](raw)


# The same definitions for the SQL side, as common table expressions.
CTES = f"""
tracks_1 AS (
  SELECT l_orderkey AS pid, CAST(l_linenumber AS BIGINT) AS pos,
         concat('track:', CAST(l_partkey AS VARCHAR)) AS track_uri, p_name AS track_name,
         concat('album:', p_brand, ':', CAST(l_suppkey AS VARCHAR)) AS album_uri,
         concat(p_brand, ' ', s_name) AS album_name,
         concat('artist:', CAST(l_suppkey AS VARCHAR)) AS artist_uri, s_name AS artist_name,
         CAST(l_quantity AS BIGINT) * 1000 AS duration_ms
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
playlists_1 AS (
  SELECT o_orderkey AS pid, o_orderpriority AS name,
         CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS collaborative,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS description
  FROM orders),
playlists_2 AS (
  SELECT CASE WHEN pid % 2 = 0 THEN pid ELSE -pid - 1 END AS pid, concat(name, ' v2') AS name,
         collaborative, CASE WHEN pid % 4 = 0 THEN NULL ELSE description END AS description
  FROM playlists_1),
tracks_2 AS (
  SELECT CASE WHEN pid % 2 = 0 THEN pid ELSE -pid - 1 END AS pid, pos,
         CASE WHEN pos >= 5 THEN concat(track_uri, ':live') ELSE track_uri END AS track_uri,
         CASE WHEN pos >= 5 THEN concat(track_name, ' (live)') ELSE track_name END AS track_name,
         CASE WHEN pos >= 5 THEN concat(album_uri, ':live') ELSE album_uri END AS album_uri,
         CASE WHEN pos >= 5 THEN concat(album_name, ' (live)') ELSE album_name END AS album_name,
         CASE WHEN pos >= 7 THEN concat(artist_uri, ':guest') ELSE artist_uri END AS artist_uri,
         CASE WHEN pos >= 7 THEN concat(artist_name, ' (guest)') ELSE artist_name END AS artist_name,
         duration_ms + 1 AS duration_ms
  FROM tracks_1),
playlists_3 AS (
  SELECT CASE WHEN pid % 3 = 0 THEN pid WHEN pid % 3 = 1 THEN -pid - 1
              ELSE pid + {NEW_ID} END AS pid,
         CASE WHEN pid % 5 = 0 THEN NULL ELSE name END AS name,
         'true' AS collaborative, description
  FROM playlists_1),
tracks_3 AS (
  SELECT CASE WHEN pid % 3 = 0 THEN pid WHEN pid % 3 = 1 THEN -pid - 1
              ELSE pid + {NEW_ID} END AS pid,
         pos + 1 AS pos, track_uri, track_name, album_uri, album_name, artist_uri, artist_name,
         duration_ms
  FROM tracks_1)"""
