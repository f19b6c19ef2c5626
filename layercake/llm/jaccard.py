"""Exact Jaccard join of documents on word n-grams, as a blocked sparse matrix product.

The incidence matrix has a row per document and a column per n-gram; the product with
its transpose holds the overlaps. Size bounds keep it small:

* Two rows of sizes ``a <= b`` can only be similar if ``4a >= 3b``, and need an overlap of at
  least ``3(a + b) / 7`` (for a similarity of 0.75).
* With columns in one order for all rows, rare ones first, two similar rows share a column
  among the first quarter of each (their heads), and the closer their sizes the earlier.
  Only heads are multiplied, in blocks of columns, and overlap counts are added up by pair;
  a pair whose count cannot reach the bound with all that comes later is discarded.
* Pairs that remain are multiplied in full, block of columns by block, and are given up
  as soon as the count so far and the rest of the smaller row stay below the bound.

Rows with equal sets are one row from the start. Groups of near copies would still give a
pair for each two members. So a few rounds multiply each column with one of its rows only
(its pivot); rows that turn out linked need no more pairs among themselves, and the last
round, which is exact, only has pairs of rows that are not yet known to be connected.

What is left of columns with many rows is multiplied in blocks: the rows of a column are dealt into
blocks of bounded size, each two blocks meet in one task, which adds up the overlaps of their rows
as dense products over blocks of columns, and only pairs that reach the bound leave it.
"""

from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm import words
from layercake.llm.common import release, staged

SHINGLE = 5
SIMILARITY = Fraction(3, 4)
ROUNDS = 2
LOCAL_COUNT = 2  # a column this frequent in a chunk of a task is counted as possibly frequent
FREQUENT = 8
MOST_FREQUENT = 1 << 19  # bounds the broadcast of frequent columns: 8 MB
SHARED = 8  # columns that a pair has to share among the first ones, if its heads are long enough
CHUNK = 4_000_000
BLOCKS = 8
HEAVY = 32  # rows from which on a column is multiplied in blocks of rows
BLOCK_ROWS = 1024  # rows of a block, and the places they fill together
BLOCK_CELLS = 1 << 18
BLOCK_COLUMNS = 2048
CHUNK_LINKS = 1_000_000
LINK_TASKS = 64


_MARKS = [T.StructField("n", T.LongType()), T.StructField("marks", T.ArrayType(T.LongType()))]


def shingles(hashes, size=SHINGLE):
    """Sorted distinct columns of a text; one for the whole text if it is shorter."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    return np.unique(words.mix(words.windows(hashes, size) + np.uint64(size)))


def sets(column, size=SHINGLE):
    """(row, columns) of every text of an Arrow column."""
    for at, end, data, offsets in words.slices(column):
        data = words.LOWER[data]
        starts, ends, first = words.spans(data, offsets, ~words.SPACES)
        hashes = words.span_hashes(data, starts, ends)
        for i in range(end - at):
            yield at + i, shingles(hashes[first[i] : first[i + 1]], size)


def needed(a, b, t=SIMILARITY):
    """Least overlap of similar rows with ``a`` and ``b`` columns."""
    return -(-(t.numerator * (a + b)) // (t.numerator + t.denominator))


def head_size(n, t=SIMILARITY):
    """How many first columns of a row of ``n`` have one in common with any similar row's."""
    return n + (t.numerator * n // -t.denominator) + 1


def _sketching(size, t):
    def frequent(held):
        if not held:
            return pa.array([], pa.int64()), pa.array([], pa.int64())
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= LOCAL_COUNT
        return pa.array(values[often].view(np.int64)), pa.array(counts[often].astype(np.int64))

    def run(batches):
        held, total, seen, schema = [], 0, set(), None
        for batch in batches:
            sizes, nodes = np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows
            for row, own in sets(batch.column("text"), size):
                sizes[row] = len(own)
                nodes[row] = blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None
                # Copies and near copies count once: they mostly share their least column. Only
                # columns that may come into a head are counted.
                if len(own) and own[0] not in seen:
                    seen.add(own[0])
                    held.append(own[: 2 * head_size(len(own), t)])
                    total += len(held[-1])
            n, id_type = batch.num_rows, batch.column("id").type
            schema = pa.schema([("id", id_type), ("n", pa.int64()), ("node", pa.binary()), ("col", pa.int64()), ("hits", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes), pa.array(nodes, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                schema=schema,
            )
            if total > CHUNK:
                yield _columns(*frequent(held), schema)
                held, total, seen = [], 0, set()
        if held:
            yield _columns(*frequent(held), schema)

    return run


def _columns(values, counts, schema):
    n = len(values)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, schema.field("id").type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), values, counts], schema=schema
    )


def _heading(held, size, t):
    def run(batches):
        often, rank = held.value
        for batch in batches:
            rows, cols, sizes, places, common = [], [], [], [], []
            for row, own in sets(batch.column("text"), size):
                if not len(own):
                    continue
                k = head_size(len(own), t)
                order = np.full(len(own), -1, np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    order = np.where(often[at] == own, rank[at], -1)
                first = np.flatnonzero(order < 0)[:k]
                if len(first) < k:
                    later = np.flatnonzero(order >= 0)
                    later = later[np.argsort(order[later], kind="stable")][: k - len(first)]
                    first = np.concatenate([first, later])
                rows.append(np.full(len(first), row))
                cols.append(own[first].view(np.int64))
                sizes.append(np.full(len(first), len(own)))
                places.append(np.arange(1, len(first) + 1))
                common.append(order[first] >= 0)
            take = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(join(cols, np.int64)),
                    batch.column("id").take(take),
                    pa.array(join(sizes, np.int64).astype(np.int32)),
                    pa.array(join(places, np.int64).astype(np.int32)),
                    pa.array(join(common, bool)),
                ],
                ["col", "doc", "n", "pos", "often"],
            )

    return run


def overlap(a, b, least, blocks=BLOCKS):
    """Number of common columns, or -1 as soon as it cannot reach ``least``."""
    if len(a) > len(b):
        a, b = b, a
    count, edges = 0, np.linspace(0, len(a), blocks + 1).astype(int)
    low = 0
    for begin, end in zip(edges[:-1], edges[1:]):
        if begin < end:
            high = int(np.searchsorted(b, a[end - 1], "right"))
            at = np.searchsorted(b[low:high], a[begin:end])
            inside = at < high - low
            count += int((b[low:high][at[inside]] == a[begin:end][inside]).sum())
            low = high
        if count + len(a) - end < least:
            return -1
    return count


def _multiplying(size, t):
    def run(batches):
        for batch in batches:
            both = [dict(sets(batch.column(c), size)) for c in ("ta", "tb")]
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = both[0][i], both[1][i]
                least = needed(len(a), len(b), t)
                keep[i] = len(a) > 0 and len(b) > 0 and overlap(a, b, least) >= least
            yield batch.select(["a", "b", "ca", "cb"]).filter(pa.array(keep))

    return run


def overlaps(a, b):
    """For each row of ``a`` and of ``b`` (lists of fingerprints) a bound of their overlap from above.

    The sparse rows become dense a block of columns at a time, and the products are added up.
    """
    lengths = [[len(x) for x in rows] for rows in (a, b)]
    values = np.concatenate([*a, *b]) if a or b else np.zeros(0, np.int32)
    own, columns = np.unique(values, return_inverse=True)
    row = np.concatenate([np.repeat(np.arange(len(n)), n) for n in lengths]).astype(np.int64)
    first = int(sum(lengths[0]))
    # Only columns of both sides count.
    both = np.zeros((2, len(own)), bool)
    both[0, columns[:first]] = both[1, columns[first:]] = True
    number = np.cumsum(both.all(axis=0)) - 1
    kept = both.all(axis=0)[columns]
    total = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, BLOCK_COLUMNS):
        dense = []
        for side, rows in ((slice(0, first), a), (slice(first, None), b)):
            column = number[columns[side]] - at
            here = kept[side] & (column >= 0) & (column < BLOCK_COLUMNS)
            # Fingerprints of a row that are equal count together, so the bound stays one from above.
            cells = np.bincount(row[side][here] * BLOCK_COLUMNS + column[here], minlength=len(rows) * BLOCK_COLUMNS)
            dense.append(cells.reshape(len(rows), BLOCK_COLUMNS).astype(np.float32))
        total += dense[0] @ dense[1].T
    return total


def _block_pairs(t):
    """Pairs of rows from two blocks (or one) that may be similar and are not of one part."""

    def run(table):
        side = table.column("c").to_numpy()
        low = int(table.column("i")[0].as_py())
        alone = table.column("i")[0] == table.column("j")[0]
        a = np.flatnonzero(side == low)
        b = a if alone else np.flatnonzero(side != low)
        flat = table.column("fp").combine_chunks()
        offsets, data = flat.offsets.to_numpy(), flat.values.to_numpy(zero_copy_only=False)
        rows = [data[offsets[k] : offsets[k + 1]] for k in range(len(flat))]
        n = table.column("n").to_numpy().astype(np.int64)
        part = table.column("part").combine_chunks().dictionary_encode().indices.to_numpy()
        total = overlaps([rows[k] for k in a], [rows[k] for k in b])
        keep = total >= needed(n[a][:, None], n[b][None, :], t)
        keep &= part[a][:, None] != part[b][None, :]
        if alone:
            keep = np.triu(keep, 1)
        x, y = np.nonzero(keep)
        x, y = pa.array(a[x]), pa.array(b[y])
        doc, own = table.column("doc").combine_chunks(), table.column("part").combine_chunks()
        return pa.Table.from_arrays([doc.take(x), doc.take(y), own.take(x), own.take(y)], ["a", "b", "ca", "cb"])

    return run


def _fingerprinting(size):
    def run(batches):
        for batch in batches:
            found = [(own >> np.uint64(32)).astype(np.uint32).view(np.int32) for _, own in sets(batch.column("text"), size)]
            lengths = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = np.concatenate(found) if found else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.ListArray.from_arrays(pa.array(lengths), pa.array(values))], ["doc", "fp"]
            )

    return run


def _blocked(heavy, texts, size, t):
    """Pairs that may be similar (a, b, ca, cb) among the rows of each heavy column, and the tables they are read from.

    Columns with the same least row are multiplied together, which near copies share. Each row
    goes to as many tasks as its group has blocks, as a number of four bytes per column.
    """
    kind = dict(heavy.dtypes)["doc"]
    owners = staged(heavy.groupBy("col").agg(F.min("doc").alias("owner")), "jaccard-owners")
    members = staged(heavy.join(owners, "col").select("owner", "doc", "n", "part").distinct(), "jaccard-members")
    groups = members.groupBy("owner").agg(
        F.min("part").alias("lo"),
        F.max("part").alias("hi"),
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_CELLS)).cast("int").alias("blocks"),
    )
    groups = staged(groups.where("lo <> hi").select("owner", "blocks"), "jaccard-groups")
    ids = members.select(F.col("doc").alias("id")).distinct()
    prints = texts.join(ids, texts["doc"] == ids["id"], "left_semi").select("doc", "text")
    prints = staged(prints.mapInArrow(_fingerprinting(size), f"doc {kind}, fp array<int>"), "jaccard-prints")
    placed = members.join(groups, "owner").withColumn("c", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    copies = placed.join(prints, "doc").select(
        "owner", "doc", "n", "part", "fp", "c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("d")
    )
    copies = copies.select("owner", F.least("c", "d").alias("i"), F.greatest("c", "d").alias("j"), "c", "doc", "n", "part", "fp")
    pairs = copies.groupBy("owner", "i", "j").applyInArrow(_block_pairs(t), f"a {kind}, b {kind}, ca {kind}, cb {kind}")
    return pairs, (owners, members, groups, prints)


def _frequent(sketch):
    """Frequent columns, sorted, and the rank of each by frequency: the most frequent ones, if many."""
    found = staged(
        sketch.where("col is not null").groupBy("col").agg(F.sum("hits").alias("hits")).where(F.col("hits") >= FREQUENT),
        "jaccard-frequent",
    )
    by_count = found.groupBy(F.floor(F.log2("hits") * 8).alias("k")).agg(F.count("*").alias("n"), F.min("hits").alias("h"))
    least, total = 1 << 62, 0
    for row in sorted(by_count.collect(), key=lambda r: -r["k"]):  # a few hundred rows
        total += row["n"]
        if total > MOST_FREQUENT:
            break
        least = row["h"]
    rows = found.where(F.col("hits") >= least).toPandas()
    cols, hits = rows["col"].to_numpy(np.int64).view(np.uint64), rows["hits"].to_numpy(np.int64)
    release(found)
    order = np.lexsort((cols, hits))
    cols = cols[order]
    by_value = np.argsort(cols)
    return cols[by_value], by_value.astype(np.int64)


def stars(u, v):
    """Links that connect the same numbers, each of them with the least it is connected to."""
    least = np.arange(max(u.max(initial=-1), v.max(initial=-1)) + 1)
    while True:
        # Every number and the one it points to take the least of both ends, then all point on.
        a, b = least[u], least[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            return least
        np.minimum.at(least, high, low)
        while (least[least] != least).any():
            least = least[least]


def _contracting(batches):
    """Links of a task as stars, a chunk of them at a time."""

    def contracted(held):
        held = pa.Table.from_batches(held).combine_chunks()
        both = pa.chunked_array([*held.column("u").chunks, *held.column("v").chunks]).combine_chunks().dictionary_encode()
        ids = both.dictionary.sort()
        at = pc.index_in(both.dictionary, ids).to_numpy(zero_copy_only=False)[both.indices.to_numpy()]
        least = stars(at[: held.num_rows], at[held.num_rows :])
        far = np.flatnonzero(least != np.arange(len(least)))
        return pa.RecordBatch.from_arrays([ids.take(pa.array(far)), ids.take(pa.array(least[far]))], ["u", "v"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK_LINKS:
            yield contracted(held)
            held, rows = [], 0
    if rows:
        yield contracted(held)


def components(links, name="links"):
    """(doc, component): for every document with a link the least one it is connected to."""
    edges = connected(links, name)
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("doc"), F.col("v").alias("component")).distinct()
    )


def connected(links, name="links"):
    """Links (u, v) of every document to the least one it is connected to, which itself is no ``u``.

    Tasks make stars of the links they have, which leaves few; then large-star and small-star
    steps in turn, each written to the shared folder, until the links are stars, with
    the least of each as its centre. What the driver sees is whether they are, once per step.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = edges.mapInArrow(_contracting, edges.schema).distinct()
    edges = staged(edges.coalesce(LINK_TASKS).mapInArrow(_contracting, edges.schema).distinct(), name)
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        # A task has all links of a number to lesser ones here, so its stars join up chains as well.
        small = small.where("u <> v").mapInArrow(_contracting, edges.schema)
        before, edges = edges, staged(small.distinct(), name)
        release(before)
    return edges


def _are_stars(edges):
    """Whether the lesser end of each link has no lesser one itself, and the greater end no other link."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return ends.where("up > 1 OR up = 1 AND n > 1").agg(F.count("*")).first()[0] == 0


def _marking(size):
    """The size of each row and its parity bitmap: 2 to 4 bits a column, at least 64, in long words."""

    def run(batches):
        for batch in batches:
            sizes, marks = [], []
            for _, own in sets(batch.column("text"), size):
                bits = 64 << max(0, (2 * len(own) - 1).bit_length() - 6)
                odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
                marks.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
                sizes.append(len(own))
            ends = np.concatenate([[0], np.cumsum([len(m) for m in marks])]).astype(np.int32)
            flat = np.concatenate(marks) if marks else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc", "n", "marks"],
            )

    return run


def _plausible(pairs, marks, t):
    """Of the pairs (a, b, ca, cb) those that their bitmaps do not rule out.

    Where two bitmaps differ, the rows have a column that is not common; so the overlap is at most half of
    what their sizes exceed the number of such places by. The wider bitmap is folded to the other's width.
    """
    num, den = t.numerator, t.denominator

    def side(name):
        return marks.select(F.col("doc").alias(name), F.col("n").alias(f"n{name}"), F.col("marks").alias(f"m{name}"))

    def folded(x, y):
        half = F.size(y)
        both = F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > half, both).otherwise(x)

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    ma, mb = F.col("ma"), F.col("mb")
    # Similar rows are of like size, and their widths the same or next to each other.
    differ = F.zip_with(folded(ma, mb), folded(mb, ma), lambda p, q: F.bit_count(F.coalesce(p.bitwiseXOR(q), F.lit(0))))
    joined = joined.withColumn("differ", F.aggregate(differ, F.lit(0), lambda s, x: s + x))
    least = F.expr(f"({num} * (na + nb) + {num + den - 1}) div {num + den}")
    sized = den * F.least("na", "nb") >= num * F.greatest("na", "nb")
    return joined.where(sized & (F.col("na") + F.col("nb") - F.col("differ") >= 2 * least)).select("a", "b", "ca", "cb")


def _multiplied(pairs, texts, marks, size, t):
    """Of the pairs (a, b, ca, cb) those that are similar, and the plausible ones, which alone are brought to their texts."""
    plausible = staged(_plausible(pairs, marks, t), "jaccard-plausible")
    a = texts.select(F.col("doc").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("doc").alias("b"), F.col("text").alias("tb"))
    joined = plausible.join(a, "a").join(b, "b").select("a", "b", "ca", "cb", "ta", "tb")
    kind = dict(pairs.dtypes)["a"]
    return joined.mapInArrow(_multiplying(size, t), f"a {kind}, b {kind}, ca {kind}, cb {kind}"), plausible


def links(docs, id_col="doc_id", text_col="text", size=SHINGLE, t=SIMILARITY, rounds=ROUNDS):
    """(sizes, links): the set size of every row of ``docs``, and links that connect all similar ones.

    ``sizes`` has ``id`` and ``n``, a row per row of ``docs``. ``links`` has pairs ``a``, ``b`` of ids;
    two similar documents are connected by them, if not always by a link of their own.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fields = [("id", kind), ("n", T.LongType()), ("node", T.BinaryType()), ("col", T.LongType()), ("hits", T.LongType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    sketch = staged(given.mapInArrow(_sketching(size, t), schema), "jaccard-rows")
    sizes = sketch.where("n is not null").select("id", "n", "node")
    named = sizes.where("id is not null and n > 0")
    reps = named.groupBy("node").agg(F.min("id").alias("rep"))
    reps = staged(reps, "jaccard-classes")  # written, so that a join can split a hot class
    copies = named.join(reps, "node").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    held = spark.sparkContext.broadcast(_frequent(sketch))
    schema = T.StructType(
        [T.StructField("col", T.LongType()), T.StructField("doc", kind), T.StructField("n", T.IntegerType()), T.StructField("pos", T.IntegerType()), T.StructField("often", T.BooleanType())]
    )
    heads = given.where("id is not null").mapInArrow(_heading(held, size, t), schema)
    # A rare column takes part if it has two rows. A frequent one does in any case; its rows are
    # spread instead of counted together. Rows are kept short, as most go no further than this.
    key = F.when(F.col("often"), F.xxhash64("col", "doc")).otherwise(F.col("col"))
    heads = heads.select(
        key.alias("k"), "doc", F.expr("shiftleft(cast(n as long), 32) + pos").alias("places"), F.when(F.col("often"), F.col("col")).alias("col")
    )
    # Of a column with two rows its window has both, and so tells whether they can be similar.
    same = Window.partitionBy("k")
    heads = heads.withColumns(
        {"rows": F.count("*").over(same), "low": F.min("places").over(same), "high": F.max("places").over(same)}
    )
    both = {"n": _size("low"), "pos": _place("low"), "m": _size("high"), "pos_b": _place("high")}
    useful = (F.col("rows") > 2) | ((F.col("rows") == 2) & _possible(t))
    heads = heads.withColumns(both).where(F.col("col").isNotNull() | useful)
    heads = heads.select(
        F.coalesce("col", "k").alias("col"), "doc", _size("places").alias("n"), _place("places").alias("pos")
    )
    every = staged(heads.join(reps, heads["doc"] == reps["rep"], "left_semi"), "jaccard-heads")
    held.destroy()
    shared = every.groupBy("col").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo <> hi").select("col")
    shared = staged(shared, "jaccard-columns")
    heads = staged(every.join(shared, "col", "left_semi"), "jaccard-heads")
    release(every, shared)
    ids = staged(heads.select("doc").distinct(), "jaccard-ids")
    texts = given.join(ids, given["id"] == ids["doc"]).select("doc", "text")
    texts = staged(texts, "jaccard-texts")
    release(ids)
    marks = texts.mapInArrow(_marking(size), T.StructType([T.StructField("doc", kind), *_MARKS]))
    marks = staged(marks, "jaccard-marks")

    known, stored = heads.withColumn("part", F.col("doc")), heads
    for turn in range(rounds):
        # First the row with fewest rarer columns, which of near copies has least of its own; then any.
        rank = [F.col("pos")] if turn == 0 else []
        pivots = known.groupBy("col").agg(
            F.min("part").alias("lo"),
            F.max("part").alias("hi"),
            F.min(F.struct(*(r.alias("r") for r in rank), F.xxhash64("doc", F.lit(turn)).alias("h"), "doc", "n", "pos", "part")).alias("p"),
        )
        pivots = pivots.where("lo <> hi").select(
            "col",
            F.col("p.doc").alias("b"),
            F.col("p.n").alias("m"),
            F.col("p.pos").alias("pos_b"),
            F.col("p.part").alias("cb"),
        )
        pivots = staged(pivots, "jaccard-pivots")  # written, so that a join can split a hot column
        mixed = known.join(pivots, "col")  # columns of one part have no pair left to find
        paired = mixed.where((F.col("part") != F.col("cb")) & _possible(t))
        new, plausible = _multiplied(_candidates(paired, t), texts, marks, size, t)
        merged = connected(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "jaccard-merged")
        release(plausible)
        merged = merged.select(F.col("u").alias("part"), F.col("v").alias("to"))
        known = mixed.drop("b", "m", "pos_b", "cb").join(merged, "part", "left")
        known = known.select("col", "doc", "n", "pos", F.coalesce("to", "part").alias("part"))
        known = staged(known, "jaccard-known")
        release(stored, pivots)
        stored = known
        copies = copies.union(merged.select("part", "to"))
    mixed = known.groupBy("col").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("rows"))
    mixed = staged(mixed.where("lo <> hi").select("col", "rows"), "jaccard-columns")
    known = staged(known.join(mixed, "col"), "jaccard-rest")
    release(stored, mixed)
    # A pair that shares a heavy column is found in its blocks; the others share light columns only, of
    # which no count is missing then.
    light = known.where(F.col("rows") < HEAVY)
    other = light.select(
        "col", F.col("doc").alias("b"), F.col("n").alias("m"), F.col("pos").alias("pos_b"), F.col("part").alias("cb")
    )
    paired = light.join(other, "col")
    paired = paired.where((F.col("part") != F.col("cb")) & (F.col("doc") < F.col("b")) & _possible(t))
    blocked, parts = _blocked(known.where(F.col("rows") >= HEAVY), texts, size, t)
    blocked = blocked.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("ca")).otherwise(F.col("cb")).alias("ca"),
        F.when(F.col("a") < F.col("b"), F.col("cb")).otherwise(F.col("ca")).alias("cb"),
    )
    maybe = staged(_candidates(paired, t).union(blocked).distinct(), "jaccard-maybe")
    release(known, *parts)
    new, _ = _multiplied(maybe, texts, marks, size, t)
    release(maybe, marks)
    # A part is connected by the links that made it, so a link between parts is enough.
    copies = copies.union(new.select(F.least("ca", "cb"), F.greatest("ca", "cb")).distinct())
    return sizes.select("id", "n"), copies


def _size(places):
    return F.expr(f"cast(shiftright({places}, 32) as int)")


def _place(places):
    return F.expr(f"cast({places} & 4294967295 as int)")


def _needed(t):
    """Least overlap of similar rows of ``n`` and ``m`` columns."""
    num, den = t.numerator, t.denominator
    return F.expr(f"({num} * (cast(n as long) + m) + {num + den - 1}) div {num + den}")


def _wanted(t):
    """How many common columns two similar rows have, at least, among the first of both.

    The first `k` beyond those that a row may miss hold `k` of them. Heads bound `k`.
    """
    num, den = t.numerator, t.denominator
    heads = (F.expr(f"{x} - ({num} * cast({x} as long) + {den - 1}) div {den} + 1 - {x}") for x in ("n", "m"))
    return F.least(F.lit(SHARED), *(h + _needed(t) for h in heads))


def _possible(t):
    """Whether a common column can be among the first of a similar pair: by sizes and its places.

    Columns before it that the other row lacks are missed, and neither row can miss more than
    it has above what the two need.
    """
    num, den = t.numerator, t.denominator
    n, m = F.col("n").cast("long"), F.col("m").cast("long")
    sized = den * F.least(n, m) >= num * F.greatest(n, m)
    spare = _wanted(t) - _needed(t)
    return sized & (F.col("pos") <= n + spare) & (F.col("pos_b") <= m + spare)


def _candidates(paired, t):
    """Pairs that may be similar, from a row per common column that ``_possible`` lets pass.

    Overlap counts are added up by pair. Up to the last of these columns the count is complete;
    beyond it the pair has at most what the row that ends first has left.
    """
    counted = paired.groupBy("doc", "n", "b", "m", "part", "cb").agg(
        F.count("*").alias("shared"), F.max("pos").alias("i"), F.max("pos_b").alias("j")
    )
    left = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
    kept = counted.where(F.col("shared") + left >= _needed(t))
    kept = kept.where(F.col("shared") >= _wanted(t))
    return kept.select(F.col("doc").alias("a"), "b", F.col("part").alias("ca"), "cb")


def deduplicate(docs, id_col="doc_id", text_col="text", size=SHINGLE, t=SIMILARITY):
    """``id_col``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    Words are runs of anything but white space, with A-Z lower-cased; a text of fewer than
    ``size`` words is one n-gram, a null or empty one none, and then linked with nothing.
    Two documents are linked if they have at least ``t`` of all their n-grams in common;
    ``component_id`` is the least id that links lead to. Rows with the same id are one
    document, whatever their texts. Rows with a null id are linked with nothing and have no
    component. Other columns are not looked at. An empty table gives an empty result.
    """
    sizes, found = links(docs, id_col, text_col, size, t)
    parts = components(found, "jaccard-components")
    out = sizes.join(parts, sizes["id"] == parts["doc"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )
