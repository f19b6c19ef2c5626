"""Line deduplication that can be taken back.

An index over the lines of documents has three parts: which document holds which line
key (`refs`), how many documents hold each key and the first of them (`counts`, exact),
and a cuckoo filter per shard of keys (`filters`). A batch is inserted by asking the
filters first: a key they do not know is new and needs no look at the exact table; only
the others are merged with it. Deleting a document lowers the counts, takes keys that
reach zero out of the filters, and gives a line whose first holder has gone to the next.
So inserting and deleting a document leaves the index as it was.

A key is the line, stripped of white space and with A-Z lower-cased, as a 128-bit hash.
Batches are reduced to a row per key before they reach a shard, so a line that a third
of all documents share is one row there; shards are many enough to stay small.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm import words
from layercake.llm.common import staged

# What a line is stripped of, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS = 10
SHARD_KEYS = 200_000
LEAST_SHARDS = 64
FILTERED_ROWS = 256  # texts that are Python objects at a time
RETURNED = 64  # one in so many documents is taken back and comes again in ``load``
SLOTS = 4
KICKS = 500


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; the entries of a bucket stay together."""

    def __init__(self, buckets):
        self.table = np.zeros((max(1, 1 << (int(buckets) - 1).bit_length()), SLOTS), np.uint16)

    @classmethod
    def sized(cls, keys):
        return cls(max(1, keys // 2))  # half full

    @classmethod
    def of(cls, blob):
        out = cls(1)
        out.table = np.frombuffer(blob, np.uint16).reshape(-1, SLOTS).copy()
        return out

    def blob(self):
        return self.table.tobytes()

    def capacity(self):
        return int(self.table.size * 0.85)

    def _places(self, hashes):
        mask = np.uint64(len(self.table) - 1)
        print_ = np.maximum(hashes >> np.uint64(48), np.uint64(1))
        first = hashes & mask
        return print_.astype(np.uint16), first.astype(np.int64), self._other(first.astype(np.int64), print_)

    def _other(self, bucket, print_):
        mask = np.uint64(len(self.table) - 1)
        return bucket ^ (words.mix(np.asarray(print_, np.uint64)) & mask).astype(np.int64)

    def contains(self, hashes):
        print_, first, second = self._places(hashes)
        print_ = print_[:, None]
        return (self.table[first] == print_).any(axis=1) | (self.table[second] == print_).any(axis=1)

    def _place(self, bucket, print_):
        """Enter what finds room in its bucket; returns which did."""
        order = np.argsort(bucket, kind="stable")
        own = bucket[order]
        rank = np.arange(len(own)) - np.searchsorted(own, own)
        slot = (self.table[own] != 0).sum(axis=1) + rank
        fits = slot < SLOTS
        self.table[own[fits], slot[fits]] = print_[order[fits]]
        done = np.zeros(len(bucket), bool)
        done[order[fits]] = True
        return done

    def insert(self, hashes):
        """Enter each hash once; False if the filter is too full, which then has to be made anew."""
        print_, first, second = self._places(hashes)
        rest = ~self._place(first, print_)
        again = np.flatnonzero(rest)
        rest[again] = ~self._place(second[again], print_[again])
        turn = 0
        for i in np.flatnonzero(rest):
            entry, bucket = print_[i], int(first[i])
            for _ in range(KICKS):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = entry
                    break
                turn = (turn + 1) % SLOTS
                entry, self.table[bucket, turn] = self.table[bucket, turn], entry
                bucket = int(self._other(np.array([bucket]), np.array([entry], np.uint64))[0])
            else:
                return False
        return True

    def delete(self, hashes):
        """Take out one fingerprint per hash; the hashes must have been entered."""
        for print_, *buckets in zip(*self._places(hashes)):
            for bucket in buckets:
                at = np.flatnonzero(self.table[bucket] == print_)
                if len(at):
                    last = np.flatnonzero(self.table[bucket])[-1]
                    self.table[bucket, at[0]] = self.table[bucket, last]
                    self.table[bucket, last] = 0
                    break


def hash_of(keys):
    """64 bits of each 128-bit key."""
    return np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2)[:, 0].astype(np.uint64)


@dataclass
class Index:
    """refs (key, doc), counts (shard, key, refs, owner), filters (shard, filter, n)."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int


def _lowered(text):
    """A-Z lower-cased; ``translate`` goes through a text by character, so plain ASCII is spared it."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def key_of(line):
    clean = F.btrim(line, F.lit(BLANKS))
    return F.when(F.char_length(clean) >= LEAST_CHARS, F.unhex(F.md5(_lowered(clean))))


def edges(docs, id_col="doc_id", text_col="text"):
    """(key, doc): every line key of every document once. Rows without an id hold no key."""
    lines = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.explode(F.split(text_col, "\n", -1)).alias("line")
    )
    # By length, as Spark would compute the keys twice to see which are null.
    long = lines.where(F.char_length(F.btrim("line", F.lit(BLANKS))) >= LEAST_CHARS)
    return long.select(key_of(F.col("line")).alias("key"), "doc").distinct()


def _shard(shards):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def _filter_schema():
    return "shard int, filter binary, n long"


def _build(pdf):
    made = CuckooFilter.sized(max(1024, len(pdf)))
    while not made.insert(hash_of(pdf["key"])):
        made = CuckooFilter(2 * len(made.table))
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "filter": [made.blob()], "n": [len(pdf)]})


def build_filters(counts):
    """The filters of all shards, made from the exact table."""
    return counts.select("shard", "key").groupBy("shard").applyInPandas(_build, _filter_schema())


def _probe(keys, filters):
    """Which keys the filter of their shard may know, and that filter with all of them in it."""
    hashes = hash_of(keys["key"])
    held = CuckooFilter.of(filters["filter"].iloc[0]) if len(filters) else CuckooFilter.sized(max(1024, len(keys)))
    n = int(filters["n"].iloc[0]) if len(filters) else 0
    seen = held.contains(hashes) if len(keys) else np.zeros(0, bool)
    full = n + int((~seen).sum()) > held.capacity() or not held.insert(hashes[~seen])
    shard = keys["shard"].iloc[0] if len(keys) else filters["shard"].iloc[0]
    out = keys.assign(seen=seen, filter=None, n=None)
    extra = {"shard": [shard], "filter": [None if full else held.blob()], "n": [n + int((~seen).sum())]}
    return pd.concat([out, pd.DataFrame(extra)])[["shard", "key", "refs", "owner", "seen", "filter", "n"]]


def empty(spark, id_type, shards):
    """An index without documents, for about ``SHARD_KEYS`` keys in each shard."""
    refs = spark.createDataFrame([], T.StructType([T.StructField("key", T.BinaryType()), T.StructField("doc", id_type)]))
    counts = spark.createDataFrame(
        [],
        T.StructType(
            [
                T.StructField("shard", T.IntegerType()),
                T.StructField("key", T.BinaryType()),
                T.StructField("refs", T.LongType()),
                T.StructField("owner", id_type),
            ]
        ),
    )
    return Index(refs, counts, spark.createDataFrame([], _filter_schema()), shards)


def insert(index, docs, id_col="doc_id", text_col="text"):
    """The index with ``docs`` in it; lines of a document that is in it already are added to it.

    ``index`` may be None: the number of shards then follows the number of keys of ``docs``. It
    doubles when the shards have grown to twice ``SHARD_KEYS``.
    """
    spark = docs.sparkSession
    new = staged(edges(docs, id_col, text_col), "line-refs")
    first = index is None
    if first:
        index = empty(spark, docs.schema[id_col].dataType, max(LEAST_SHARDS, -(-new.count() // SHARD_KEYS)))
    else:
        # Only documents that come again can have a pair that is there already.
        ids = new.select("doc").distinct().join(index.refs.select("doc").distinct(), "doc", "left_semi")
        again = staged(ids, "line-again")
        if not again.isEmpty():
            known = index.refs.join(again, "doc", "left_semi").select("key", "doc")
            new = staged(new.join(known, ["key", "doc"], "left_anti"), "line-refs")
    # One row per key, made before and after the shuffle by key.
    batch = new.groupBy("key").agg(F.count("*").alias("refs"), F.min("doc").alias("owner"))
    batch = batch.select(_shard(index.shards), "key", "refs", "owner")
    kind = dict(new.dtypes)["doc"]
    probed = (
        batch.groupBy("shard")
        .cogroup(index.filters.groupBy("shard"))
        .applyInPandas(
            _probe, f"shard int, key binary, refs long, owner {kind}, seen boolean, filter binary, n long"
        )
    )
    probed = staged(probed, "line-probed")
    rows = probed.where("key is not null")
    fresh = rows.where("not seen").select("shard", "key", "refs", "owner")
    known = rows.where("seen").select("shard", "key", "refs", "owner")
    filters = probed.where("key is null").select("shard", "filter", "n")
    if first:  # a shard without a filter has seen nothing
        counts = fresh
    else:
        merged = index.counts.unionByName(known).groupBy("shard", "key")
        counts = merged.agg(F.sum("refs").alias("refs"), F.min("owner").alias("owner")).unionByName(fresh)
        counts = staged(counts, "line-counts")
        # A key that a filter took for known without reason is not in it yet.
        wrong = known.join(index.counts, "key", "left_anti")
        filters = staged(_change(filters, wrong, "insert"), "line-filters")
    index = Index(index.refs.unionByName(new) if not first else new, counts, filters, index.shards)
    return _grown(_repaired(index))


def _repaired(index):
    """The index with the filters that had no room made anew from the exact table."""
    broken = index.filters.where("filter is null").select("shard")
    if broken.isEmpty():
        return index
    made = build_filters(index.counts.join(broken, "shard", "left_semi"))
    index.filters = staged(index.filters.where("filter is not null").unionByName(made), "line-filters")
    return index


def _grown(index):
    """The index with more shards, if they have become large."""
    total, shards = index.filters.agg(F.sum("n")).first()[0] or 0, index.shards
    while total > 2 * SHARD_KEYS * shards:
        shards *= 2
    if shards == index.shards:
        return index
    counts = staged(index.counts.select(_shard(shards), "key", "refs", "owner"), "line-counts")
    return Index(index.refs, counts, staged(build_filters(counts), "line-filters"), shards)


def _change(filters, keys, what):
    """Filters with the keys entered or taken out; null for one that has no room for them."""

    def change(own, held):
        if not len(own) or held["filter"].iloc[0] is None:
            return held.assign(n=held["n"] + (len(own) if what == "insert" else 0))
        made = CuckooFilter.of(held["filter"].iloc[0])
        # An insertion that fails has moved other entries already, so nothing of it can be kept.
        done = getattr(made, what)(hash_of(own["key"]))
        return held.assign(
            filter=[None if done is False else made.blob()], n=held["n"] + (len(own) if what == "insert" else -len(own))
        )

    # New names for the columns, as both sides may come from one table.
    own = keys.select(F.col("shard").alias("s"), F.col("key").alias("key"))
    return (
        own.groupBy("s").cogroup(filters.groupBy("shard"))
        .applyInPandas(change, _filter_schema())
    )


def load(docs, batches, id_col="doc_id", text_col="text"):
    """The index of ``docs``, which come in ``batches`` by the hash of their id.

    As in use, the first batch finds empty filters and the later ones ask them; and the documents of a
    further, small batch come, are taken back and come again.
    """
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(batches))
    index = None
    for i in range(batches):
        index = insert(index, docs.where(part == i), id_col, text_col)
    late = docs.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(2)), F.lit(RETURNED)) == 0)
    return insert(delete(index, late, id_col), late, id_col, text_col)


def delete(index, ids, id_col="doc_id"):
    """The index without the documents whose ids are in ``ids``; ids it does not have do nothing."""
    gone = ids.select(F.col(id_col).alias("doc")).where("doc is not null").distinct()
    out = staged(index.refs.join(gone, "doc", "left_semi").select("key", "doc"), "line-gone")
    refs = staged(index.refs.join(gone, "doc", "left_anti").select("key", "doc"), "line-refs")
    touched = out.groupBy("key").agg(F.count("*").alias("less"))
    left = refs.join(touched, "key", "left_semi").groupBy("key").agg(F.min("doc").alias("next"))
    changed = index.counts.join(touched, "key").join(left, "key", "left")
    changed = staged(
        changed.select("shard", "key", (F.col("refs") - F.col("less")).alias("refs"), F.col("next").alias("owner")),
        "line-changed",
    )
    counts = index.counts.join(changed, "key", "left_anti").select("shard", "key", "refs", "owner")
    counts = staged(counts.unionByName(changed.where("refs > 0")), "line-counts")
    filters = staged(_change(index.filters, changed.where("refs = 0"), "delete"), "line-filters")
    return _repaired(Index(refs, counts, filters, index.shards))


def _key(line):
    clean = line.strip(BLANKS).translate(_TO_LOWER)
    return hashlib.md5(clean.encode(), usedforsecurity=False).digest() if len(clean) >= LEAST_CHARS else None


_TO_LOWER = str.maketrans(UPPER, LOWER)


def _filtering(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, FILTERED_ROWS):
            yield _filtered(batch.slice(at, FILTERED_ROWS))


def _filtered(batch):
    lines, dropped, texts = [], [], []
    for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
        own = (text or "").split("\n")
        lines.append(len(own))
        if gone:
            away = set(gone)
            own = [x for x in own if _key(x) not in away]
            text = "\n".join(own)
        dropped.append(lines[-1] - len(own))
        texts.append(text)
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(c) for c in batch.schema.names if c not in ("text", "gone")),
            pa.array(texts, pa.string()),
            pa.array(lines, pa.int64()),
            pa.array(dropped, pa.int64()),
        ],
        [*(c for c in batch.schema.names if c not in ("text", "gone")), "text", "lines", "dropped"],
    )


def repeated(index):
    """(doc, gone): the keys that each document loses to one with a smaller id."""
    shared = index.counts.where("refs > 1").select("key", "owner")
    lost = index.refs.join(shared, "key").where("doc <> owner")
    return lost.groupBy("doc").agg(F.collect_list("key").alias("gone"))  # no more than the document has


def apply(index, docs, id_col="doc_id", text_col="text"):
    """``docs`` with ``text`` reduced, and ``n_lines`` and ``n_dropped`` as new last columns.

    Lines whose key two or more documents of the index hold stay only in the one with the
    smallest id, there as often as they occur. Null texts and texts without a dropped line
    are left as they are; a null or empty text is one empty line. Rows with the same id are
    one document, rows with a null id none: they lose nothing. Other columns are kept, but
    those called ``n_lines`` and ``n_dropped`` are replaced. Texts may be of any length; an empty
    table gives an empty result.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col, "n_lines", "n_dropped")]
    inner = docs.select(
        *(F.col(f"`{c}`").alias(a) for c, a in ((id_col, "id"), (text_col, "text"))),
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)),
    )
    gone = repeated(index)
    joined = inner.join(gone, inner["id"] == gone["doc"], "left").drop("doc")
    fields = [f for f in joined.schema if f.name not in ("text", "gone")]
    schema = T.StructType(
        [
            *(T.StructField(f.name, f.dataType) for f in fields),
            T.StructField("text", T.StringType()),
            T.StructField("lines", T.LongType()),
            T.StructField("dropped", T.LongType()),
        ]
    )
    out = joined.mapInArrow(_filtering, schema)
    names = {id_col: "id", text_col: "text"} | {c: f"c{i}" for i, c in enumerate(rest)}
    kept = [c for c in docs.columns if c in names]
    return out.select(
        *(F.col(names[c]).alias(c) for c in kept),
        F.col("lines").alias("n_lines"),
        F.col("dropped").alias("n_dropped"),
    )
