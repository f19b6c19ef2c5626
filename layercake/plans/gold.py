"""Gold layer: playlist summaries and entries with names.

Two families exist and differ on purpose. A first build uses left joins and
keeps entries that have no song or playlists row; a rebuild after an upsert uses
inner joins and drops them.
"""

from pyspark.sql import functions as F

from layercake.operators import CHANGE, distinct_keys, keep_least, label_lookup, merge_into, weighted_labels
from layercake.schemas import GOLD, SILVER

# What is counted per playlist, with the columns it is found in.
COUNTED = {"track": "track_uri", "artist": "artist_uri", "album": "album_uri"}
TIMED = "timed"


def summarise(entries):
    """Distinct tracks, artists and albums and the total duration per playlist.

    Each entry is expanded into one row per distinct count, grouped by playlist
    *and* URI first, so a playlist holding a third of all entries is
    spread over many tasks; only partial counts meet on the playlist id. The row of
    the track carries the duration, where ``count(DISTINCT ...)`` would add a fourth row for it.
    """

    def only(column, wanted):
        return F.when(F.lit(wanted), F.col(column)).alias(column)

    rows = [
        F.struct(*(only(c, c == own) for c in COUNTED.values()), only("duration_ms", own == "track_uri"))
        for own in COUNTED.values()
    ]
    uses = entries.select("playlist_id", F.inline(F.array(*rows)))
    distinct = uses.groupBy("playlist_id", *COUNTED.values()).agg(F.sum("duration_ms").alias("duration_ms"))
    return distinct.groupBy("playlist_id").agg(
        *(F.count(c).alias(f"num_{kind}s") for kind, c in COUNTED.items()),
        F.sum("duration_ms").alias("total_duration_ms"),
    )


def _use_rows(uses, duration, sign):
    """The rows one entry adds to ``uses`` or takes from it, as an array of structs."""

    def row(kind, uri, number, amount):
        return F.struct(
            F.lit(kind).alias("kind"),
            uri.alias("uri"),
            number.cast("long").alias("uses"),
            amount.cast("long").alias("amount"),
        )

    timed = F.when(duration.isNotNull(), F.lit(sign)).otherwise(0)
    rows = [row(kind, uses[c], F.lit(sign), F.lit(0)) for kind, c in COUNTED.items()]
    rows.append(row(TIMED, F.lit(""), timed, F.coalesce(duration * sign, F.lit(0))))
    return F.filter(F.array(*rows), lambda r: r["uri"].isNotNull())


def _added(rows):
    """Uses of equal playlist, kind and URI added up; those that are used no more go."""
    summed = rows.groupBy("playlist_id", "kind", "uri").agg(
        F.sum("uses").alias("uses"), F.sum("amount").alias("amount")
    )
    return summed.where((F.col("uses") > 0) | (F.col("kind") == TIMED))


def uses_build(entries):
    """How often each playlist uses each track, artist and album, and its durations.

    The counts of a playlist are the numbers of its rows, and unlike those they can be
    brought up to date by the entries that changed. Kind ``timed`` has one row per playlist, with
    the number and sum of the durations that are known. Entries without a playlist are left out.
    """
    uris = {c: F.col(c) for c in COUNTED.values()}
    rows = entries.where("playlist_id IS NOT NULL").select(
        "playlist_id", F.inline(_use_rows(uris, F.col("duration_ms"), 1))
    )
    return _added(rows)


def uses_refresh(uses, changed):
    """``uses_build`` after an upsert, from what it was and the changed entries.

    ``changed`` has entries as they are now, with what they were in ``CHANGE``. An entry adds its own
    URIs and takes away those it had, so a URI goes with its last use.
    """
    now = {c: F.col(c) for c in COUNTED.values()}
    was = {c: F.col(f"{CHANGE}.{c}") for c in COUNTED.values()}
    gone = F.when(
        F.col(f"{CHANGE}.kind") == "updated",
        _use_rows(was, F.col(f"{CHANGE}.duration_ms"), -1),
    ).otherwise(F.filter(_use_rows(was, F.lit(None).cast("long"), -1), lambda r: F.lit(False)))
    both = F.concat(_use_rows(now, F.col("duration_ms"), 1), gone)
    delta = changed.where("playlist_id IS NOT NULL").select("playlist_id", F.inline(both))
    return _added(uses.unionByName(delta))


def summarise_uses(uses):
    """``summarise`` of the entries that ``uses`` counts: each distinct URI is one row there, so
    these are plain counts, which combine before the shuffle whatever the size of a playlist."""

    def number(kind):
        return F.count_if(F.col("kind") == kind)

    timed = F.col("kind") == TIMED
    return uses.groupBy("playlist_id").agg(
        *(number(kind).alias(f"num_{kind}s") for kind in COUNTED),
        F.sum(F.when(timed & (F.col("uses") > 0), F.col("amount"))).alias("total_duration_ms"),
    )


def playlists_from_uses(uses, playlists):
    """``playlists_rebuild`` from the uses of entries."""
    return summarise_uses(uses).join(playlists, "playlist_id").select(*GOLD["playlists"])


def playlists_build(entries, playlists):
    """Summary LEFT JOIN playlists, as on a first build.

    Raw playlists may repeat an id, even very often, and a left join cannot be
    split on its right side. So ids without a playlists row are added to the
    playlists as rows of NULLs, and the join becomes an inner one, which can.

    Both joins are merges: Spark goes by the size of compressed files, and would send the ids of
    millions of playlists through the driver.
    """
    listed = playlists.filter(F.col("playlist_id").isNotNull())
    unlisted = distinct_keys(entries, ["playlist_id"]).join(
        distinct_keys(listed, ["playlist_id"]).hint("merge"), "playlist_id", "left_anti"
    )
    left = listed.select(*SILVER["playlists"]).unionByName(unlisted, allowMissingColumns=True)
    right = summarise(entries).withColumnRenamed("playlist_id", "id")
    # Null-safe: entries without a playlist id form a group and keep their row.
    same = F.col("playlist_id").eqNullSafe(F.col("id"))
    return left.join(right.hint("merge"), same).select(*GOLD["playlists"])


def playlists_rebuild(entries, playlists):
    """Summary INNER JOIN playlists; ``playlists`` has one row per id after an upsert."""
    return summarise(entries).join(playlists, "playlist_id").select(*GOLD["playlists"])


def _with_names(entries, songs, albums, artists, how):
    # Every lookup has one row per key, so each join keeps the number of entries,
    # and hot tracks are split by AQE on the entries' side.
    return (
        entries.join(label_lookup(songs, "track_uri", "track_name"), "track_uri", how)
        .join(label_lookup(albums, "album_uri", "album_name"), "album_uri", how)
        .join(label_lookup(artists, "artist_uri", "artist_name"), "artist_uri", how)
        .select(*GOLD["playlist_tracks"])
    )


def tracks_build(entries, songs, albums, artists):
    """Entries with the names of their track, album and artist, NULL where unknown."""
    return _with_names(entries, songs, albums, artists, "left")


def tracks_rebuild(entries, songs, albums, artists):
    """The same after an upsert: entries lacking a song, album or artist are dropped."""
    return _with_names(entries, songs, albums, artists, "inner")


def tracks_fanout(entries, songs, albums, artists):
    """The first build's plain join on songs that were never deduplicated.

    A track on n playlists meets n song rows for each of its n entries. Instead
    of writing the n copies, ``copies`` says how often the plain join has the row.
    """
    return (
        entries.join(weighted_labels(songs, "track_uri", "track_name", "__n"), "track_uri", "left")
        .join(weighted_labels(albums, "album_uri", "album_name", "__m"), "album_uri", "left")
        .join(weighted_labels(artists, "artist_uri", "artist_name", "__k"), "artist_uri", "left")
        .withColumn(
            "copies",
            F.coalesce("__n", F.lit(1)) * F.coalesce("__m", F.lit(1)) * F.coalesce("__k", F.lit(1)),
        )
        .select(*GOLD["playlist_tracks"], "copies")
    )


# The columns a MERGE refresh of gold.playlists sets; the counts
# of tracks, artists and albums are not among them.
MERGE_COLUMNS = ["playlist_id", "total_duration_ms", "name", "collaborative", "description"]


def merge_source(entries, playlists, changed=None):
    """Fresh summaries with one row per playlist, to be merged into gold.playlists.

    Silver playlists kept up by MERGE may still repeat an id; one row is used. With
    ``changed``, a frame of playlist ids, only these are summarised.
    """
    if changed is not None:
        _, entries = _split(entries, changed)
        _, playlists = _split(playlists, changed)
    return playlists_rebuild(entries, keep_least(playlists, ["playlist_id"]))


def playlists_merge(gold, fresh, columns=None, unique=False):
    """MERGE ``merge_source`` rows into an existing gold.playlists.

    By default every column is set. With ``MERGE_COLUMNS`` the counts of a known
    playlist keep their old value and those of a new one are NULL. ``unique`` says that
    ``gold`` has one row per playlist.
    """
    columns = GOLD["playlists"] if columns is None else columns
    return merge_into(
        gold, fresh, ["playlist_id"], columns, source_unique=True, target_unique=unique
    )


def _split(table, changed):
    """Rows of ``table`` outside and inside the changed playlists."""
    ids = distinct_keys(changed, ["playlist_id"]).withColumnRenamed("playlist_id", "id")
    same = F.col("playlist_id").eqNullSafe(F.col("id"))
    return table.join(ids, same, "left_anti"), table.join(ids, same, "left_semi")


def playlists_refresh(gold, changed, entries, playlists):
    """``playlists_rebuild`` recomputed only for the ``changed`` playlist ids.

    Valid when ``gold`` is itself the rebuild of the silver tables before the
    batch and ``changed`` holds every playlist id of the batch.
    """
    kept, _ = _split(gold, changed)
    _, touched = _split(entries, changed)
    _, described = _split(playlists, changed)
    return kept.unionByName(playlists_rebuild(touched, described))


def playlists_patch(gold, changed, uses, playlists):
    """``playlists_refresh`` from the uses of entries after the batch."""
    kept, _ = _split(gold, changed)
    _, touched = _split(uses, changed)
    _, described = _split(playlists, changed)
    return kept.unionByName(playlists_from_uses(touched, described))


def tracks_refresh(gold, changed, entries, songs, albums, artists):
    """``tracks_rebuild`` recomputed only for the ``changed`` playlist ids.

    Valid when ``gold`` is the rebuild of the silver tables before the batch, the batch
    was an upsert, which keeps the names of known URIs, and every entry had its names:
    then the entries of other playlists keep the rows they have.
    """
    kept, _ = _split(gold, changed)
    _, touched = _split(entries, changed)
    return kept.unionByName(tracks_rebuild(touched, songs, albums, artists))
