"""Raw input schemas and the column order of every table."""

from pyspark.sql import types as T

RAW_PLAYLISTS = T.StructType(
    [
        T.StructField("pid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("collaborative", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

RAW_TRACKS = T.StructType(
    [
        T.StructField("pid", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("track_uri", T.StringType()),
        T.StructField("track_name", T.StringType()),
        T.StructField("album_uri", T.StringType()),
        T.StructField("album_name", T.StringType()),
        T.StructField("artist_uri", T.StringType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("duration_ms", T.LongType()),
    ]
)

# Table and column names of the two derived layers.
SILVER = {
    "songs": ["track_name", "track_uri", "duration_ms", "album_uri", "artist_uri"],
    "albums": ["album_uri", "album_name", "artist_uri"],
    "artists": ["artist_uri", "artist_name"],
    "playlists": ["playlist_id", "name", "collaborative", "description"],
    "playlist_tracks": ["playlist_id", "track_uri", "album_uri", "artist_uri", "pos", "duration_ms"],
}
GOLD = {
    "playlists": [
        "playlist_id",
        "num_tracks",
        "num_artists",
        "num_albums",
        "total_duration_ms",
        "name",
        "collaborative",
        "description",
    ],
    "playlist_tracks": ["playlist_id", "pos", "track_name", "album_name", "artist_name"],
}

# Key of each silver table once a batch has been upserted into it.
SILVER_KEYS = {
    "songs": ["track_uri"],
    "albums": ["album_uri"],
    "artists": ["artist_uri"],
    "playlists": ["playlist_id"],
    "playlist_tracks": ["playlist_id", "pos"],
}
# Key of playlist_tracks when batches are applied with MERGE semantics instead.
ENTRY_MERGE_KEYS = ["playlist_id", "track_uri"]
