"""Silver layer: raw playlists and tracks split into five tables."""

from pyspark.sql import functions as F

from layercake.schemas import SILVER


def songs(tracks):
    """One row per playlist entry: a song repeats with every playlist it is on."""
    return tracks.select(*SILVER["songs"])


def albums(tracks):
    return tracks.select(*SILVER["albums"]).distinct()


def artists(tracks):
    return tracks.select(*SILVER["artists"]).distinct()


def playlists(raw):
    return raw.select(F.col("pid").alias("playlist_id"), *SILVER["playlists"][1:])


def playlist_tracks(tracks):
    return tracks.select(F.col("pid").alias("playlist_id"), *SILVER["playlist_tracks"][1:])


def build(raw_playlists, raw_tracks):
    """All five tables of a first build, by name."""
    return {
        "songs": songs(raw_tracks),
        "albums": albums(raw_tracks),
        "artists": artists(raw_tracks),
        "playlists": playlists(raw_playlists),
        "playlist_tracks": playlist_tracks(raw_tracks),
    }
