"""Benchmark decontamination with suffix arrays of the training text.

Every shard of documents gets a suffix array over its words, and every suffix of
the benchmark is looked up in it by binary search: the neighbours of its place hold
the longest verbatim match, and the suffixes that begin with a whole window are a
range. The array is sparse: a place where not even the first words of a suffix
agree with the benchmark cannot be part of an answer and is left out. Documents
never leave their task; only the benchmark is sent round, in blocks of bounded size that
tasks prepare. Every place of a document is matched once with an item, however often text repeats.
"""

import io
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm import words
from layercake.llm.common import attach, staged

WINDOW = 13
SEED_WORDS = 4
BLOCK_CHARS = 8_000_000
SHARD_BYTES = 4_000_000
BLOCKS_A_PASS = 4  # blocks that are looked up before what was found is written
STEP = 64  # words that are compared at a time

# A match: words [start, start + length) of the document are words [at, at + length)
# of the item.
MATCH = pa.list_(
    pa.struct([("item", pa.string()), ("start", pa.int32()), ("at", pa.int32()), ("length", pa.int32())])
)


def tokens(column, limit=words.SLICE_BYTES):
    """(first row, end row, word hashes, first word of each row) in slices."""
    for at, end, data, offsets in words.slices(column, limit):
        data = words.LOWER[data]
        starts, ends, first = words.spans(data, offsets, words.ALNUM)
        yield at, end, words.span_hashes(data, starts, ends), first


def pack(names, texts):
    """Items as bytes: their names, and the hashes of their words."""
    hashes, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, found, first in tokens(pa.array(texts, pa.string())):
        hashes.append(found)
        lengths.append(np.diff(first))
    named = [np.frombuffer(n.encode(), np.uint8) for n in names]
    out = io.BytesIO()
    np.savez(
        out,
        names=np.concatenate([np.zeros(0, np.uint8), *named]),
        sizes=np.array([len(n) for n in named], np.int64),
        hashes=np.concatenate(hashes),
        lengths=np.concatenate(lengths),
    )
    return out.getvalue()


class Block:
    """Some benchmark items: their words as numbers from 1 on, and what starts a suffix."""

    def __init__(self, packed, window=WINDOW):
        with np.load(io.BytesIO(packed)) as held:
            names, sizes, hashes, lengths = (held[k] for k in ("names", "sizes", "hashes", "lengths"))
        ends = np.cumsum(sizes)
        self.names = [names[e - n : e].tobytes().decode() for n, e in zip(sizes, ends)]
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes) + 1
        self.raw = ids.astype(">u4").tobytes()
        self.ends = np.cumsum(lengths)
        self.longest = int(lengths.max(initial=0))
        # Suffixes to look up: place, item and window. A short item has one, of its own length.
        place = np.arange(len(ids))
        item = np.repeat(np.arange(len(lengths)), lengths)
        left = self.ends[item] - place
        size = np.minimum(lengths[item], window)
        kept = left >= size
        place, item, size = place[kept], item[kept], size[kept]
        seed = np.minimum(size, SEED_WORDS)
        key = np.zeros(len(place), np.uint64)
        for n in np.unique(seed):
            key[seed == n] = seed_hashes(ids, int(n))[place[seed == n]]
        order = np.lexsort((place, key, seed))
        self.suffixes = [x[order] for x in (seed, key, place, item, size)]
        self.seeds = {int(n): np.unique(key[seed == n]) for n in np.unique(seed)}

    def known(self, seed, keys):
        """(place, item, window) of the suffixes that begin with one of some seeds."""
        seeds, own, place, item, size = self.suffixes
        low, high = np.searchsorted(seeds, seed), np.searchsorted(seeds, seed, "right")
        here = np.isin(own[low:high], keys)
        return zip(*(x[low:high][here].tolist() for x in (place, item, size)))


def seed_hashes(ids, size):
    return words.windows(ids.astype(np.uint64), size)


def _member(values, among):
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values


def shard_matches(block, hashes, first):
    """Matches of a shard: (row, item, start, at, length).

    ``hashes`` are the words of the shard and ``first`` each row's first word. Rows are
    kept apart by a number that no benchmark word has.
    """
    rows = len(first) - 1
    if not len(hashes) or not block.seeds:
        return []
    ids = np.searchsorted(block.vocabulary, hashes)
    ids = np.minimum(ids, len(block.vocabulary) - 1)
    ids = np.where(block.vocabulary[ids] == hashes, ids + 1, 0).astype(np.uint64)
    row_of = np.repeat(np.arange(rows), np.diff(first))
    text = np.zeros(len(ids) + rows, np.uint64)
    place = np.arange(len(ids)) + row_of
    text[place] = ids
    picked, seeded = [], {}
    for size, among in block.seeds.items():
        keys = seed_hashes(text, size)
        if not len(keys):
            continue
        known = text[: len(keys)] > 0
        for i in range(1, size):
            known &= text[i : i + len(keys)] > 0
        at = np.flatnonzero(known)
        at = at[_member(keys[at], among)]
        picked.append(at)
        seeded[size] = np.unique(keys[at])
    places = np.unique(np.concatenate(picked)) if picked else np.zeros(0, np.int64)
    if not len(places):
        return []
    # The suffix array. Numbers are written with the high byte first, so that the order of
    # the bytes is the order of the words; a suffix is compared up to the longest item.
    raw = text.astype(">u4").tobytes()
    order = ordered(raw, places.tolist(), block.longest)
    word_at = np.concatenate([np.arange(len(ids)), [len(ids)]])
    doc_word = np.zeros(len(text), np.int64)
    doc_word[place] = word_at[:-1] - first[row_of]
    doc_row = np.zeros(len(text), np.int64)
    doc_row[place] = row_of
    # Equal windows are looked up once, and a place has one longest match with an item.
    heads = {}
    for seed, keys in seeded.items():
        for at, item, size in block.known(seed, keys):
            heads.setdefault(block.raw[4 * at : 4 * (at + size)], {}).setdefault(item, []).append(at)
    found = []
    for head, items in heads.items():
        begin = lambda p, n=len(head): raw[4 * p : 4 * p + n]
        low, high = bisect_left(order, head, key=begin), bisect_right(order, head, key=begin)
        if low == high:
            continue
        for item, ats in items.items():
            end = int(block.ends[item])
            start = end - _length(block, item)
            ats = ordered(block.raw, ats, block.longest, 4 * end)
            for p in order[low:high]:
                at, length = _longest(raw, p, block.raw, ats, end)
                found.append((int(doc_row[p]), item, int(doc_word[p]), at - start, length))
    return found


def _length(block, item):
    return int(block.ends[item] - (block.ends[item - 1] if item else 0))


def ordered(raw, places, most, end=None):
    """Places by the words from there on, at most ``most``; ``end`` is where the bytes end.

    Only places that agree so far are compared any further, so no long copies are held.
    """
    end = len(raw) if end is None else end
    out, rest = [], [(list(places), 0)]
    while rest:
        group, depth = rest.pop()
        if len(group) == 1 or depth >= most:
            out += group
            continue
        keys = {p: raw[4 * (p + depth) : min(4 * (p + min(depth + STEP, most)), end)] for p in group}
        group.sort(key=keys.__getitem__)
        runs, begun = [], 0
        for i in range(1, len(group) + 1):
            if i == len(group) or keys[group[i]] != keys[group[begun]]:
                runs.append((group[begun:i], depth + STEP))
                begun = i
        rest += reversed(runs)
    return out


def _longest(raw, p, items, ats, end):
    """(at, length) of the longest match of what stands at ``p`` with one of some sorted suffixes."""

    def suffix(at):
        return items[4 * at : 4 * end]

    if len(ats) == 1:
        return ats[0], _common(raw[4 * p : 4 * (p + end - ats[0])], suffix(ats[0]))
    # The neighbours in order have it.
    own = raw[4 * p : 4 * (p + end - min(ats))]
    i = bisect_left(ats, own, key=suffix)
    near = [(-_common(own, suffix(at)), at) for at in ats[max(0, i - 1) : i + 1]]
    length, at = min(near)
    return at, -length


def _common(a, b):
    """Number of equal leading words of two byte strings of four bytes a word."""
    n = min(len(a), len(b)) // 4
    if a[: 4 * n] == b[: 4 * n]:
        return n
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        if a[: 4 * mid] == b[: 4 * mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _maximal(found):
    """Of the matches of one document, those that no earlier match with the same item contains."""
    kept, reach = [], {}
    for item, start, at, length in sorted(found, key=lambda m: (m[0], m[1], -m[3], m[2])):
        if start + length > reach.get(item, -1):
            kept.append((item, start, at, length))
            reach[item] = start + length
    return kept


def _found(block, column):
    """Number of words, and matches, of every text of an Arrow column."""
    counts = np.zeros(len(column), np.int64)
    matches = [[] for _ in range(len(column))]
    for at, end, hashes, first in tokens(column, SHARD_BYTES):
        counts[at:end] = np.diff(first)
        for row, *match in shard_matches(block, hashes, first):
            matches[at + row].append(match)
    named = [
        [{"item": block.names[i], "start": s, "at": o, "length": n} for i, s, o, n in _maximal(own)] for own in matches
    ]
    return [pa.array(counts), pa.array(named, MATCH)]


def blocks(benchmark, id_col="item_id", text_col="text", block_chars=BLOCK_CHARS):
    """The benchmark as a table of packed blocks of about ``block_chars`` characters, or one longer item.

    Null texts, ids and items without a word take no part; an id that occurs twice stands for both of its texts.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    items = items.where("i is not null and t is not null")
    chars = items.agg(F.sum(F.char_length("t"))).first()[0] or 0
    block = F.pmod(F.xxhash64("i", "t"), F.lit(chars // block_chars + 1)).cast("int")

    def packed(key, table):
        blob = pack(table.column("i").to_pylist(), table.column("t").to_pylist())
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([blob], pa.binary())], ["block", "blob"])

    made = items.select(block.alias("block"), "i", "t").groupBy("block").applyInArrow(packed, "block int, blob binary")
    return staged(made, "benchmark-blocks")


def _looking_up(held, window):
    made = []

    def values(column):
        if not made:
            made.append(Block(held.value, window))
        return _found(made[0], column)

    return values


def attach_matches(docs, benchmark, text_col="text", item_col="item_id", item_text="text", window=WINDOW,
                   block_chars=BLOCK_CHARS):
    """``docs`` with ``n_words`` and ``matches`` as new last columns.

    A match is a run of words that a document and an item share, at least ``window``
    words long or the whole of a shorter item, and as long as the words agree: ``item``,
    the first word in the document (``start``) and in the item (``at``), and ``length``. From each
    place in a document the longest match with an item counts, unless it lies in an earlier one.
    Null and empty texts have no words. All rows are kept, repeated ones too; other columns
    pass through, but those with the names of new ones are replaced. An empty benchmark
    leaves all documents without a match, an empty table gives an empty result.

    The driver passes on one packed block after the other. After ``BLOCKS_A_PASS`` of them what was
    found so far is written with the documents and their broadcasts are given up.
    """
    spark = docs.sparkSession
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("matches", T.ArrayType(T.StructType([
            T.StructField("item", T.StringType()), T.StructField("start", T.IntegerType()),
            T.StructField("at", T.IntegerType()), T.StructField("length", T.IntegerType()),
        ]))),
    ]
    packed = blocks(benchmark, item_col, item_text, block_chars)
    numbers = sorted(r["block"] for r in packed.select("block").collect()) or [None]
    earlier = "matches before"
    while earlier in docs.columns:
        earlier += " "
    out, held = docs, []
    for k, number in enumerate(numbers):
        if len(held) == BLOCKS_A_PASS:
            out, held = _written(out, held), []
        blob = pack([], []) if number is None else packed.where(F.col("block") == number).first()["blob"]
        held.append(spark.sparkContext.broadcast(bytes(blob)))
        before = out.withColumnRenamed("matches", earlier) if k else out
        out = attach(before, text_col, fields, _looking_up(held[-1], window))
        if k:
            out = out.withColumn("matches", F.concat(F.col(f"`{earlier}`"), "matches")).drop(earlier)
    return out


def _written(out, held):
    out = staged(out, "benchmark-matches")
    for value in held:
        value.destroy()
    return out


def matches(docs, benchmark, id_col="doc_id", text_col="text", **options):
    """``id_col``, ``n_words`` and ``matches`` for every row of ``docs``, as ``attach_matches`` has them."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return attach_matches(own, benchmark, **options).select(F.col("id").alias(id_col), "n_words", "matches")


def verdicts(found, limit=20):
    """``n_hit``, ``n_items``, ``items`` and ``contaminated`` for the rows of ``matches``.

    A word is hit if a match covers it; overlapping matches count a word once. A document
    is contaminated if at least one word in ``limit`` is hit.
    """
    by_start = F.array_sort(F.transform("matches", lambda m: F.struct(
        m["start"].alias("s"), (m["start"] + m["length"]).alias("e"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to"))

    def add(state, span):
        fresh = F.greatest(F.lit(0), span["e"] - F.greatest(span["s"], state["to"]))
        return F.struct((state["n"] + fresh).alias("n"), F.greatest(state["to"], span["e"]).alias("to"))

    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return (
        found.withColumn("n_hit", F.aggregate(by_start, start, add, lambda s: s["n"]).cast("long"))
        .withColumn("items", items)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (limit * F.col("n_hit") >= F.col("n_words")))
    )
