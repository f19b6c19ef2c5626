"""Phrase collocations from weighted acyclic automata.

An automaton maps phrases to counts. It reads labels one by one, the language first and then
words; every state accepts, and the weight of the last arc is the count of what was read. States
with equal arcs (labels, weights and targets) are one state, so endings that
phrases share are stored once.

* A task sorts the n-grams of a chunk of text and builds the automaton of the chunk, depth by
  depth from the ends, with a register of the states there are.
* Automata are cut at boundaries in the order of phrases; a boundary may be within the
  words that follow a hot word. The pieces of a range are united and equal paths add their weights.
  Boundaries come from evenly spaced paths of all automata, so that a range has about
  ``RANGE_ARCS`` arcs before it is united, whatever the text.
* Cutting is done in two steps, or there were as many pieces as chunks times ranges. Chunks are cut into
  about as many blocks of ranges as there are ranges in a block; the pieces of a few chunks in a
  block are united and cut into its ranges.
* The parts of candidates are looked up by composition: all parts that fall into a range walk
  through its automaton at the same time.

Words are compared as text, never by hash, and counts are 64-bit integers, so all is exact.
"""

from bisect import bisect_right
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from layercake.llm import words as w
from layercake.llm.common import release, staged

MOST_WORDS = 3
LEAST_COUNT = 10
TOP = 2000
UNKNOWN = "und"
CHUNK_WORDS = 600_000
RANGE_ARCS = 500_000
MERGED_RANGES = 2  # what is united in the first step has about as many arcs as so many ranges
SAMPLE_ARCS = 8192  # one of so many arcs is a path that boundaries are chosen from
MOST_RANGES = 1 << 20  # bounds what is broadcast; beyond it ranges grow
BOUNDARY_WORD = 32  # characters of a word in a boundary, which need not be a word that there is
SALT = 16

# The characters that end a piece, and those between the words of one.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAPS = np.zeros(256, bool)
GAPS[[0x20, 0x09]] = True


class Paths:
    """Sorted n-grams as a tree: for each depth the parent (a place in the depth above), label and weight.

    Labels are places in ``vocabulary``, a sorted Arrow array.
    """

    def __init__(self, vocabulary, depths):
        self.vocabulary, self.depths = vocabulary, depths

    def arcs(self):
        return sum(len(label) for _, label, _ in self.depths)

    def keys(self, depth):
        """Parent and label of the paths of a depth as one rising integer."""
        parent, label, _ = self.depths[depth]
        return parent * np.int64(len(self.vocabulary)) + label


def _summed(keys, weights):
    """(distinct keys, sums of weights, the distinct key of each)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    sums = np.add.reduceat(weights[order], at) if len(at) else np.zeros(0, np.int64)
    return ordered[at], sums, inverse


def _sorted_vocabulary(strings):
    """(sorted distinct strings, the place of each), by bytes."""
    coded = strings.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]


def tokens(column, langs):
    """(words, piece of each, language of each) of slices of an Arrow column; a piece has one number.

    Words and languages are pairs of codes and the strings they stand for.
    """
    for at, end, data, offsets in w.slices(column):
        data = w.LOWER[data]
        inside = ~(ENDS | GAPS)
        starts, ends, first = w.spans(data, offsets, inside)
        if not len(starts):
            continue
        row = np.repeat(np.arange(end - at, dtype=np.int32), np.diff(first))
        # Both rise: the sum differs if one does.
        piece = np.cumsum(ENDS[data], dtype=np.int32)[starts] + row
        letters = data[inside[data]]
        lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(letters)])
        found, own = found.dictionary_encode(), langs.slice(at, end - at).dictionary_encode()
        yield (
            (found.indices.to_numpy(), found.dictionary),
            piece,
            (own.indices.to_numpy()[row], own.dictionary),
        )


def counted(held, most_words):
    """The paths of (words, pieces, languages) of several slices."""
    shift, pieces = 0, []
    for _, piece, _ in held:
        pieces.append(piece.astype(np.int64) + shift)
        shift = int(pieces[-1][-1]) + 1
    piece = np.concatenate(pieces)
    strings = [d for words, _, langs in held for d in (words[1], langs[1])]
    vocabulary, rank = _sorted_vocabulary(pa.concat_arrays(strings))
    at, label, lang = 0, [], []
    for words, _, langs in held:
        for (codes, own), out in ((words, label), (langs, lang)):
            out.append(rank[at : at + len(own)].astype(np.int32)[codes])
            at += len(own)
    label, lang = np.concatenate(label), np.concatenate(lang)
    size = np.int64(len(vocabulary))
    keys, _, at = _summed(lang.astype(np.int64), np.zeros(len(lang), np.int64))
    depths = [(np.zeros(len(keys), np.int64), keys, np.zeros(len(keys), np.int64))]
    for k in range(most_words):
        n = len(label) - k
        if n <= 0:
            break
        place = np.flatnonzero(piece[:n] == piece[k:])
        keys, sums, inverse = _summed(at[place] * size + label[place + k], np.ones(len(place), np.int64))
        depths.append((keys // size, keys % size, sums))
        at = np.full(len(label), -1, np.int64)
        at[place] = inverse
    return Paths(vocabulary, depths)


def _equal_states(starts, lengths, columns):
    """For each run of arcs the first run that is equal to it in all columns."""
    n = len(starts)
    index = np.repeat(np.arange(n), lengths)
    place = np.arange(len(index)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    arc = np.repeat(starts, lengths) + place
    mixed = place.astype(np.uint64)
    for column in columns:
        mixed = w.mix(mixed * np.uint64(w._BASE) + column[arc].view(np.uint64))
    total = np.zeros(n, np.uint64)
    some = lengths > 0
    if some.any():
        total[some] = np.add.reduceat(mixed, (np.cumsum(lengths) - lengths)[some])
    # The register finds a state by hash; whether it is the same one is seen from its arcs.
    _, first, inverse = np.unique(total, return_index=True, return_inverse=True)
    other = first[inverse]
    same = lengths == lengths[other]
    there = np.repeat(starts[other], lengths) + place
    compared = np.repeat(same, lengths)
    unequal = np.zeros(len(arc), bool)
    for column in columns:
        unequal[compared] |= column[arc[compared]] != column[there[compared]]
    same[index[unequal]] = False
    return np.where(same, other, np.arange(n))


def build(paths):
    """The automaton of paths as bytes: states without two that are equal.

    For each depth it has the arcs of the states that are left (their number by state, labels,
    weights and, but for the last depth, target states).
    """
    depths, target, out = paths.depths, None, []
    for d in range(len(depths) - 1, -1, -1):
        parent, label, weight = depths[d]
        above = len(depths[d - 1][0]) if d else 1
        lengths = np.bincount(parent, minlength=above).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        columns = [label, weight] + ([] if target is None else [target])
        same = _equal_states(starts, lengths, columns)
        kept = np.flatnonzero(same == np.arange(above))
        number = np.full(above, -1, np.int64)
        number[kept] = np.arange(len(kept))
        index = np.repeat(starts[kept], lengths[kept])
        index += np.arange(len(index)) - np.repeat(np.cumsum(lengths[kept]) - lengths[kept], lengths[kept])
        out.append([lengths[kept], *(c[index] for c in columns)])
        target = number[same]
    return _packed(paths.vocabulary, out[::-1])


def _packed(vocabulary, depths):
    offsets = np.frombuffer(vocabulary.buffers()[1], np.int64)[vocabulary.offset : vocabulary.offset + len(vocabulary) + 1]
    sizes, letters = np.diff(offsets), vocabulary.buffers()[2][offsets[0] : offsets[-1]].to_pybytes()
    arrays = [sizes, *(a for columns in depths for a in columns)]
    head = [len(depths), *(len(columns) for columns in depths)]
    arrays = [np.array(head, np.int64), *arrays]
    parts = []
    for a in arrays:
        narrow = np.uint8
        while len(a) and int(a.max()) > np.iinfo(narrow).max:
            narrow = {np.uint8: np.uint16, np.uint16: np.uint32, np.uint32: np.int64}[narrow]
        parts.append(np.array([len(a), np.dtype(narrow).itemsize], np.int64).tobytes() + a.astype(narrow).tobytes())
    data = b"".join([np.array([len(parts)], np.int64).tobytes(), *parts, letters])
    return np.array([len(data)], np.int64).tobytes() + pa.compress(data, "zstd", asbytes=True)


class Automaton:
    """An automaton that ``build`` made."""

    def __init__(self, packed):
        packed = bytes(packed)
        size = int(np.frombuffer(packed, np.int64, 1)[0])
        data = pa.decompress(packed[8:], size, "zstd", asbytes=True)
        at, arrays = 8, []
        for _ in range(int(np.frombuffer(data, np.int64, 1)[0])):
            n, width = (int(v) for v in np.frombuffer(data, np.int64, 2, at))
            kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[width]
            arrays.append(np.frombuffer(data, kind, n, at + 16).astype(np.int64))
            at += 16 + n * width
        head, sizes, *rest = arrays
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.vocabulary = pa.Array.from_buffers(
            pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data[at:])]
        )
        self.depths = []
        for columns in head[1:]:
            self.depths.append(rest[: int(columns)])
            rest = rest[int(columns) :]

    def paths(self):
        """All paths, in order."""
        out, states = [], np.zeros(1, np.int64)
        for lengths, label, weight, *target in self.depths:
            starts = np.cumsum(lengths) - lengths
            many = lengths[states]
            parent = np.repeat(np.arange(len(states)), many)
            arc = np.repeat(starts[states], many) + np.arange(len(parent)) - np.repeat(np.cumsum(many) - many, many)
            out.append((parent, label[arc], weight[arc]))
            if target:
                states = target[0][arc]
        return Paths(self.vocabulary, out)

    def weights(self, phrases):
        """Weights of phrases, given as lists of labels of equal length, side by side; 0 where there is none."""
        rows = len(phrases[0])
        state, there, weight = np.zeros(rows, np.int64), np.ones(rows, bool), np.zeros(rows, np.int64)
        size = np.int64(max(1, len(self.vocabulary)))
        for depth, labels in enumerate(phrases):
            if depth >= len(self.depths):
                return np.zeros(rows, np.int64)
            lengths, label, own, *target = self.depths[depth]
            found = pc.index_in(labels, self.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = np.repeat(np.arange(len(lengths)), lengths) * size + label
            wanted = state * size + found
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            there &= (found >= 0) & (keys[at] == wanted) if len(keys) else False
            weight = np.where(there, own[at], 0) if len(keys) else weight
            state = np.where(there, target[0][at], 0) if target else state
        return np.where(there, weight, 0)


def union(parts):
    """Paths of several automata, with the weights of equal ones added."""
    parts = [Automaton(p).paths() for p in parts]
    vocabulary, rank = _sorted_vocabulary(pa.concat_arrays([p.vocabulary for p in parts]))
    size, at, ranks = np.int64(max(1, len(vocabulary))), 0, []
    for p in parts:
        ranks.append(rank[at : at + len(p.vocabulary)])
        at += len(p.vocabulary)
    depths, above = [], [np.zeros(1, np.int64) for _ in parts]
    for d in range(max(len(p.depths) for p in parts)):
        inside = [i for i, p in enumerate(parts) if d < len(p.depths)]
        keys = [above[i][parts[i].depths[d][0]] * size + ranks[i][parts[i].depths[d][1]] for i in inside]
        keys, sums, inverse = _summed(np.concatenate(keys), np.concatenate([parts[i].depths[d][2] for i in inside]))
        depths.append((keys // size, keys % size, sums))
        at = 0
        for i in inside:
            n = len(parts[i].depths[d][0])
            above[i] = inverse[at : at + n]
            at += n
    return Paths(vocabulary, depths)


def cuts(paths, boundaries):
    """For each depth the place of the first path that is not before each of the boundaries.

    Boundaries are sorted tuples of labels; ``""`` (which is no word) fills those that are short.
    """
    size = np.int64(len(paths.vocabulary))
    rows = len(boundaries)
    position, exact = np.zeros(rows, np.int64), np.ones(rows, bool)
    out = []
    for d in range(len(paths.depths)):
        labels = pa.array([b[d] if d < len(b) else "" for b in boundaries], pa.large_string())
        more = np.array([d + 1 < len(b) and b[d + 1] != "" for b in boundaries], bool)
        known = pc.index_in(labels, paths.vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place = _places(paths.vocabulary, labels)
        keys = paths.keys(d)
        found = np.searchsorted(keys, position * size + np.where(exact, place, 0))
        inside = np.minimum(found, max(0, len(keys) - 1))
        same = exact & (known >= 0) & (keys[inside] == position * size + known) if len(keys) else np.zeros(rows, bool)
        # A path that the boundary goes on from is before it.
        out.append(found + (same & more))
        position, exact = found, same & more
    return out


def _places(vocabulary, labels):
    """How many words of a sorted vocabulary are before each label."""
    both, rank = _sorted_vocabulary(pa.concat_arrays([vocabulary, labels]))
    before = np.zeros(len(both) + 1, np.int64)
    before[1:][rank[: len(vocabulary)]] = 1
    return np.cumsum(before)[rank[len(vocabulary) :]]


def pieces(paths, boundaries):
    """(range, paths of it): ranges between boundaries that have any; paths above come with weight 0."""
    at = cuts(paths, boundaries)
    edges = [np.concatenate([[0], a, [len(p[0])]]) for a, p in zip(at, paths.depths, strict=True)]
    some = np.flatnonzero(np.any([np.diff(e) > 0 for e in edges], axis=0))
    number = np.zeros(len(paths.vocabulary), np.int64)
    for r in some:
        depths, below = [], np.zeros(0, np.int64)
        for d in range(len(paths.depths) - 1, -1, -1):
            low, high = int(edges[d][r]), int(edges[d][r + 1])
            parent, label, weight = paths.depths[d]
            # Parents of what is kept are sorted, and lie before the range or in it.
            above = below[below < low]
            index = np.concatenate([above, np.arange(low, high)])
            own = np.concatenate([np.zeros(len(above), np.int64), weight[low:high]])
            depths.append([index, parent[index], label[index], own])
            below = depths[-1][1]
            below = below[np.diff(below, prepend=-1) > 0]
        depths.reverse()
        for d in range(len(depths) - 1, 0, -1):
            depths[d][1] = np.searchsorted(depths[d - 1][0], depths[d][1])
        while depths and not len(depths[-1][0]):
            depths.pop()
        for _, _, label, _ in depths:
            number[label] = 1
        used = np.flatnonzero(number)
        number[used] = np.arange(len(used))
        kept = [(parent, number[label], own) for _, parent, label, own in depths]
        number[used] = 0
        yield int(r), Paths(paths.vocabulary.take(pa.array(used)), kept)


def _phrases(paths, depth, index):
    """The labels of some paths of a depth, from the first to the last, as Arrow arrays."""
    out = []
    for d in range(depth, -1, -1):
        parent, label, _ = paths.depths[d]
        out.append(paths.vocabulary.take(pa.array(label[index])))
        index = parent[index]
    return out[::-1]


def _building(most_words, chunk_words, step):
    names = ["arcs", "blob", "path"]

    def emit(held):
        paths = counted(held, most_words)
        total, sample = paths.arcs(), []
        for d in range(1, len(paths.depths)):
            n = len(paths.depths[d][0])
            index = np.arange(step // 2, n, step)
            for labels in zip(*(x.to_pylist() for x in _phrases(paths, d, index)), strict=True):
                sample.append([labels[0], *(x[:BOUNDARY_WORD] for x in labels[1:])])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([total] + [None] * len(sample), pa.int64()),
                pa.array([build(paths)] + [None] * len(sample), pa.binary()),
                pa.array([None, *sample], pa.list_(pa.string())),
            ],
            names,
        )

    def run(batches):
        held, total = [], 0
        for batch in batches:
            langs = batch.column("lang").cast(pa.large_string()).fill_null(UNKNOWN)
            for part in tokens(batch.column("text"), langs):
                held.append(part)
                total += len(part[1])
                if total >= chunk_words:
                    yield emit(held)
                    held, total = [], 0
        if held:
            yield emit(held)

    return run


def _block_size(ranges):
    """Ranges of a block, and the parts its chunks are dealt into, which are united one by one."""
    size = isqrt(max(0, ranges - 1)) + 1
    return size, -(-size // MERGED_RANGES)


def _cutting(held):
    """The pieces of each chunk by block of ranges; the part follows the place of the chunk in the table."""

    def run(batches):
        size, parts = _block_size(len(held.value) + 1)
        boundaries, at = held.value[size - 1 :: size], TaskContext.get().partitionId()
        for batch in batches:
            for blob in batch.column("blob"):
                found = [(r, build(p)) for r, p in pieces(Automaton(blob.as_py()).paths(), boundaries)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r for r, _ in found], pa.int32()),
                            pa.array([at % parts] * len(found), pa.int32()),
                            pa.array([b for _, b in found], pa.binary()),
                        ],
                        ["block", "part", "blob"],
                    )
                at += 1

    return run


def _dividing(held):
    """Unites pieces of a block and cuts them into its ranges."""

    def run(key, table):
        size, _ = _block_size(len(held.value) + 1)
        first = key[0].as_py() * size
        paths = union([b.as_py() for b in table.column("blob")])
        found = [(first + r, build(p)) for r, p in pieces(paths, held.value[first : first + size - 1])]
        return pa.Table.from_arrays(
            [pa.array([r for r, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
            ["range", "blob"],
        )

    return run


def _uniting(least_count):
    def run(key, table):
        paths = union([b.as_py() for b in table.column("blob")])
        langs, labels, counts, blobs = [], [], [], []
        langs.append(None), labels.append(None), counts.append(None), blobs.append(build(paths))
        for d in range(1, len(paths.depths)):
            parent, _, weight = paths.depths[d]
            if d == 1:
                # The words of a language in this range.
                total = np.zeros(len(paths.depths[0][0]), np.int64)
                np.add.at(total, parent, weight)
                langs += paths.vocabulary.take(pa.array(paths.depths[0][1])).to_pylist()
                labels += [None] * len(total)
                counts += total.tolist()
                continue
            index = np.flatnonzero(weight >= least_count)
            lang, *own = _phrases(paths, d, index)
            langs += lang.to_pylist()
            labels += [list(x) for x in zip(*(x.to_pylist() for x in own), strict=True)]
            counts += weight[index].tolist()
        blobs += [None] * (len(langs) - 1)
        return pa.Table.from_arrays(
            [
                pa.array([key[0].as_py()] * len(langs), pa.int32()),
                pa.array(langs, pa.string()),
                pa.array(labels, pa.list_(pa.string())),
                pa.array(counts, pa.int64()),
                pa.array(blobs, pa.binary()),
            ],
            ["range", "lang", "phrase", "a", "blob"],
        )

    return run


def _asking(held):
    """The parts of phrases, each once a batch, with the range that has them."""

    def run(batches):
        for batch in batches:
            parts = set()
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
                for k in range(1, len(phrase)):
                    parts |= {(lang, *phrase[:k]), (lang, *phrase[k:])}
            parts = sorted(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bisect_right(held.value, p) for p in parts], pa.int32()),
                    pa.array([p[0] for p in parts], pa.string()),
                    pa.array([list(p[1:]) for p in parts], pa.list_(pa.string())),
                ],
                ["range", "lang", "part"],
            )

    return run


def _composing(key, automata, asked):
    """Weights of the parts that were asked for in a range."""
    found = np.zeros(asked.num_rows, np.int64)
    if asked.num_rows and automata.num_rows:
        automaton = Automaton(automata.column("blob")[0].as_py())
        lists = asked.column("part").combine_chunks()
        langs = asked.column("lang").combine_chunks().cast(pa.large_string())
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        for n in np.unique(lengths):
            rows = pa.array(np.flatnonzero(lengths == n))
            own = lists.take(rows)
            labels = [pc.list_element(own, i).cast(pa.large_string()) for i in range(int(n))]
            found[rows.to_numpy()] = automaton.weights([langs.take(rows), *labels])
    return pa.Table.from_arrays(
        [asked.column("lang").cast(pa.string()), asked.column("part").cast(pa.list_(pa.string())), pa.array(found)],
        ["lang", "part", "f"],
    )


def _boundaries(chunks, range_arcs):
    """Sorted boundaries that cut all automata into ranges of about ``range_arcs`` arcs."""
    total = chunks.agg(F.sum("arcs")).first()[0] or 0
    ranges = min(MOST_RANGES, total // range_arcs)
    if ranges < 1:
        return []
    sample = chunks.where("path IS NOT NULL").select("path")
    sample = sample.repartitionByRange("path").sortWithinPartitions("path")
    # Every so many of the sorted paths of a partition.
    step = max(1, sample.count() // ranges)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = sample.withColumn("place", place).where(F.col("place") % step == step // 2).select("path").collect()
    return sorted({tuple(r["path"]) for r in rows})


def phrases(
    docs,
    text_col="text",
    lang_col="lang",
    most_words=MOST_WORDS,
    least_count=LEAST_COUNT,
    top=TOP,
    chunk_words=CHUNK_WORDS,
    range_arcs=RANGE_ARCS,
    sample_arcs=SAMPLE_ARCS,
):
    """The first ``top`` phrases of each language by how much more often their words stand together than apart.

    Texts have A-Z lower-cased and are cut at ``.,;:!?`` and line ends into pieces, these at
    spaces and tabs into words. Candidates are phrases of 2 to ``most_words`` words with at least
    ``least_count`` occurrences in pieces (``a``). The cut of a phrase into two parts with ``l`` and
    ``r`` occurrences for which ``floor(10**6 * a * a / (l * r))`` is least (of equal ones the first) gives its
    ``score``. A candidate inside a longer one that has at least half as many occurrences
    goes. ``n`` is the number of words of the language. ``rank`` is by score, ``a`` (both falling) and phrase.

    Null texts have no words, a null language is ``und``; a language without candidates
    has no row, nor has an empty table. Repeated rows count as often as they are there. No
    other column is looked at, and no id is needed.
    """
    spark = docs.sparkSession
    given = docs.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    building = _building(most_words, chunk_words, sample_arcs)
    built = given.where("text IS NOT NULL").mapInArrow(building, "arcs long, blob binary, path array<string>")
    built = staged(built, "phrase-chunks")
    held = spark.sparkContext.broadcast(_boundaries(built, range_arcs))
    cut = built.where("blob IS NOT NULL").select("blob").mapInArrow(_cutting(held), "block int, part int, blob binary")
    divided = cut.groupBy("block", "part").applyInArrow(_dividing(held), "range int, blob binary")
    united = divided.groupBy("range").applyInArrow(
        _uniting(least_count), "range int, lang string, phrase array<string>, a long, blob binary"
    )
    united = staged(united, "phrase-ranges")
    release(built)
    automata = united.where("blob IS NOT NULL").select("range", "blob")
    candidates = united.where("phrase IS NOT NULL").select("lang", "phrase", "a")
    totals = united.where("blob IS NULL AND phrase IS NULL").groupBy("lang").agg(F.sum("a").alias("n"))

    asked = candidates.mapInArrow(_asking(held), "range int, lang string, part array<string>").distinct()
    weights = (
        automata.groupBy("range")
        .cogroup(asked.groupBy("range"))
        .applyInArrow(_composing, "lang string, part array<string>, f long")
    )
    weights = staged(weights, "phrase-parts")
    held.unpersist()
    return _ranked(candidates, weights, totals, most_words, top)


def _ranked(candidates, weights, totals, most_words, top):
    cut = candidates.select(
        "lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k")
    ).selectExpr("lang", "phrase", "a", "k", "slice(phrase, 1, k) first", "slice(phrase, k + 1, size(phrase) - k) rest")
    left = weights.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = weights.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    scored = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    # 38 digits hold 10**6 times the product of two counts of up to 10**16.
    score = "cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * cast(1000000 as decimal(7,0)) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"
    scored = scored.withColumn("score", F.expr(score).cast("long"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    kept = best.select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    if most_words > 2:
        inside = candidates.where(F.size("phrase") > 2).select(
            "lang", "a", F.col("phrase").alias("p"), F.explode(F.sequence(F.lit(2), F.size("phrase") - 1)).alias("k")
        )
        inside = inside.select("lang", "a", "p", "k", F.explode(F.sequence(F.lit(1), F.size("p") - F.col("k") + 1)).alias("i"))
        inside = inside.selectExpr("lang", "slice(p, i, k) phrase", "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        kept = kept.join(inside, ["lang", "phrase"], "left")
        kept = kept.where("longer IS NULL OR 100 * cast(longer as decimal(20,0)) < 50 * cast(a as decimal(20,0))").drop("longer")
    kept = kept.withColumn("phrase", F.array_join("phrase", " "))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First the best of each of a few parts of a language, so that no task sorts all of one.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALT))
    kept = kept.withColumn("salt", part)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    kept = kept.where(F.col("rank") <= top).drop("rank", "salt")
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    kept = kept.where(F.col("rank") <= top).join(totals, "lang")
    return kept.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
