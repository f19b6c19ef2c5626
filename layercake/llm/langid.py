"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of some labelled text. A text is cut greedily
into the longest phrases that occur in it; the language that needs the fewest, times
the bits it takes to point into its text, describes the text best.

Texts are read as lower-case letters with one space for all else. They are cut into
pieces that the automata run through side by side, one NumPy step per character of a
piece, so a very long text costs no more per character than many short ones. A phrase may go
on over pieces: those are run through again from the state the piece before ends in, until
a phrase starts where one started the first time; from there on both runs agree.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm import words

TRAIN_ROWS = 64
TRAIN_CHARS = 24_000  # rows of a language are added, each as a whole, until they have as many
TRAIN_PARTS = 16  # evenly spread over a text that is longer than that, and together as long
MOST_LANGUAGES = 256  # the most frequent ones
PIECE = 256  # characters that are run through at a time
UNKNOWN, SPACE = 0, 1
_POINTS = 0x110000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normalised(text):
    """Lower-case letters, each run of other characters as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text):
    """Transitions of the suffix automaton of ``text``, a dict from character to state each."""
    moves, link, length, last = [{}], [-1], [0], 0
    for char in text:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and char not in moves[at]:
            moves[at][char] = new
            at = link[at]
        if at >= 0:
            to = moves[at][char]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(char) == to:
                    moves[at][char] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return moves


@cache
def _letters():
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(_POINTS)])


class Edges:
    """Transitions as a hash table, of a size that follows their number and not the alphabet's."""

    def __init__(self, moves, number, width):
        keys = [state * width + number[c] for state, own in enumerate(moves) for c in own]
        to = [x for own in moves for x in own.values()]
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        keys, to = np.array(keys, np.int64), np.array(to, np.int32)
        slot = self._slot(keys)
        while len(keys):
            at, first = np.unique(slot, return_index=True)
            first = first[self.keys[at] < 0]
            self.keys[slot[first]], self.to[slot[first]] = keys[first], to[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, to, slot = keys[rest], to[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys):
        return ((keys.view(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def follow(self, keys):
        """The state that each edge leads to, -1 where there is none."""
        slot = self._slot(keys)
        found, to = self.keys[slot], self.to[slot].astype(np.int64)
        other = np.flatnonzero(found != keys)
        to[other] = -1
        other = other[found[other] >= 0]
        slot = slot[other]
        while len(other):
            slot = (slot + 1) & self.mask
            found = self.keys[slot]
            hit = found == keys[other]
            to[other[hit]] = self.to[slot[hit]]
            on = ~hit & (found >= 0)
            other, slot = other[on], slot[on]
        return to


class Model:
    """An automaton per language, over the characters that were learned."""

    def __init__(self, texts):
        self.languages = sorted(texts)
        clean = {lang: normalised(texts[lang]) for lang in self.languages}
        self.alphabet = sorted(set("".join(clean.values())) - {" "})
        number = {c: i + 2 for i, c in enumerate(self.alphabet)} | {" ": SPACE}
        self.width = len(self.alphabet) + 3  # the last is padding
        self.bits, self.edges, self.roots = [], [], []
        for lang in self.languages:
            moves = suffix_automaton(clean[lang])
            self.edges.append(Edges(moves, number, self.width))
            root = np.zeros(self.width, np.int64)
            for char, to in moves[0].items():
                root[number[char]] = to
            self.roots.append(root)
            self.bits.append(np.log2(len(clean[lang]) + 2))

    def classes(self):
        """The number of every code point: its letter, an unknown letter, or space."""
        out = np.where(_letters(), UNKNOWN, SPACE).astype(np.int32)
        for i, c in enumerate(self.alphabet):
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1:
                    out[ord(form)] = i + 2
        return out

    def _step(self, k, state, step):
        """The next states, and which rows start a phrase with this character.

        A phrase starts at the root, where a text begins and after an unknown letter,
        and where the last one cannot go on. Padding changes nothing.
        """
        padding = step == self.width - 1
        to = self.edges[k].follow(state * self.width + step)
        missed = to < 0
        begun = (missed | (state == 0)) & ~padding
        to = np.where(missed, self.roots[k][step], to)
        return np.where(padding, state, to), begun

    def phrases(self, pieces, before):
        """Phrases that each language needs for each row of ``pieces``.

        ``before`` has the row that each one goes on from, -1 where a text begins.
        """
        out = np.zeros((len(self.edges), len(pieces)), np.int64)
        steps = np.ascontiguousarray(pieces.T.astype(np.int64))
        for k in range(len(self.edges)):
            state, starts = np.zeros(len(pieces), np.int64), np.zeros(steps.shape, bool)
            for i, step in enumerate(steps):
                state, starts[i] = self._step(k, state, step)
            left = np.cumsum(starts[::-1], axis=0, dtype=np.int32)[::-1]  # phrases from a character on
            alone, end = left[0].astype(np.int64), state
            count, final = alone.copy(), end.copy()
            todo = np.flatnonzero(before >= 0)
            while len(todo):
                # The same pieces from the state they are entered in.
                rows, state = todo, final[before[todo]]
                own, found, changed = np.zeros(len(todo), np.int64), alone[todo].copy(), end[todo].copy()
                place = np.arange(len(todo))
                for i in range(steps.shape[0]):
                    state, begun = self._step(k, state, steps[i, rows])
                    same = begun & starts[i, rows]
                    found[place[same]] = own[place[same]] + left[i, rows[same]]
                    own[place[begun]] += 1
                    rows, state, place = rows[~same], state[~same], place[~same]
                    if not len(rows):
                        break
                found[place], changed[place] = own[place], state
                count[todo] = found
                moved = todo[changed != final[todo]]
                final[todo] = changed
                todo = np.flatnonzero((before >= 0) & np.isin(before, moved)) if len(moved) else moved
            out[k] = count
        return out


def predict(model, classes, column):
    """Best language and score of every text of an Arrow column."""
    n = len(column)
    names, scores = np.full(n, "und", object), np.zeros(n)
    if not model.languages:
        return names, scores
    bits = np.array(model.bits)
    for at, end, data, offsets in words.slices(column):
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        offsets = begun[offsets]
        kinds = classes[points]
        lettered = np.concatenate([[0], np.cumsum(kinds != SPACE)])
        has_letter = lettered[offsets[1:]] > lettered[offsets[:-1]]
        again = np.zeros(len(kinds), bool)
        again[1:] = (kinds[1:] == SPACE) & (kinds[:-1] == SPACE)
        kept = np.concatenate([[0], np.cumsum(~again)])
        kinds, offsets = kinds[~again], kept[offsets]
        sizes = np.diff(offsets)
        parts = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(sizes)), parts)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = offsets[owner] + index * PIECE
        if not len(starts):
            continue
        where = starts[:, None] + np.arange(PIECE)
        inside = where < offsets[owner + 1][:, None]
        pieces = np.where(inside, kinds[np.minimum(where, len(kinds) - 1)], model.width - 1)
        before = np.where(index > 0, np.arange(len(owner)) - 1, -1)
        counts = model.phrases(pieces, before)
        total = np.stack([np.bincount(owner, c, len(sizes)) for c in counts]) * bits[:, None]
        order = np.argsort(total, axis=0, kind="stable")  # ties: the first language by name
        first = np.take_along_axis(total, order[:1], 0)[0]
        if len(total) > 1:
            second = np.take_along_axis(total, order[1:2], 0)[0]
        else:
            second = first * np.inf
        with np.errstate(invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, second / (first + second))
        rows = np.flatnonzero(has_letter)
        names[at + rows] = np.array(model.languages, object)[order[0][rows]]
        scores[at + rows] = score[rows]
    return names, scores


def _predicting(held):
    kinds = []

    def run(batches):
        model = held.value
        if not kinds:
            kinds.append(model.classes())
        for batch in batches:
            names, scores = predict(model, kinds[0], batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"],
            )

    return run


def fit(docs, id_col="doc_id", text_col="text", lang_col="lang", chars=TRAIN_CHARS, rows=TRAIN_ROWS,
        languages=MOST_LANGUAGES):
    """A model from a bounded sample of the labelled rows of ``docs``.

    Of each of the ``languages`` most frequent languages ``rows`` different texts are picked by
    their hash; this is all that the driver sees, however often a text is repeated. They are learned
    as a whole, in this order, until they have ``chars`` characters. A text longer than that stands with
    ``TRAIN_PARTS`` evenly spread parts, which are as long together. Rows with a null id, text or
    language are not used; of equally frequent languages the first by name are learned.
    """
    named = docs.select(F.col(id_col).alias("i"), F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"))
    named = named.where("i is not null and l is not null and t is not null").select("l", F.xxhash64("t").alias("h"), "t")
    known = [r["l"] for r in named.groupBy("l").count().orderBy(F.col("count").desc(), "l").limit(languages).collect()]
    if not known:
        return Model({})
    named = named.where(F.col("l").isin(known))
    # The greatest hash of each language that is picked: copies are one row before the order is made.
    order = Window.partitionBy("l").orderBy("h")
    hashes = named.select("l", "h").distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows)
    last = F.create_map(*(F.lit(x) for r in hashes.groupBy("l").agg(F.max("h").alias("h")).collect() for x in r))
    size, part = F.char_length("t"), chars // TRAIN_PARTS
    spread = F.transform(
        F.sequence(F.lit(0), F.lit(TRAIN_PARTS - 1)),
        lambda k: F.substring(F.col("t"), (1 + F.floor(k * (size - part) / (TRAIN_PARTS - 1))).cast("int"), F.lit(part)),
    )
    text = F.when(size > chars, F.array_join(spread, " ")).otherwise(F.col("t"))
    picked = named.where(F.col("h") <= last[F.col("l")]).groupBy("l", "h").agg(F.min(text).alias("t"))
    texts = {}
    for row in sorted(picked.collect(), key=lambda r: (r.l, r.h)):
        own = texts.setdefault(row.l, "")
        if len(own) < chars:
            texts[row.l] = own + " " + row.t
    return Model({lang: text for lang, text in texts.items() if normalised(text)})


def identify(docs, model, id_col="doc_id", text_col="text"):
    """``id_col``, ``lang_pred`` and ``score`` for every row of ``docs``.

    ``und`` with a score of 0 if the text is null or has no letter, or if the model has no
    language. The score is the share of the runner-up in the two best descriptions: 0.5
    says that both fit alike. Ties go to the first language by name. Repeated rows and null
    ids are kept; other columns are not looked at.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_predicting(held), schema)
    return out.withColumnRenamed("id", id_col)
