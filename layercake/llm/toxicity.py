"""Toxicity as a chain of classifiers.

Categories are predicted one after the other. Each has a linear model over the presence
of hashed words and beginnings of words and over the probabilities of the categories
before it. Later models are trained with probabilities that come from folds in which the
text had no part, so that they learn to trust earlier ones as far as these deserve.

Presence, not frequency, counts: a few words make a long text toxic.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm import words
from layercake.llm.common import weighted_sample
from layercake.llm.quality import pack, unpack

# Words that tell the categories of labelled toxic texts apart; a parameter of `fit`.
SEEDS = {
    "insult": ("idiot", "moron", "stupid", "loser", "clown"),
    "contempt": ("pathetic", "worthless", "trash", "scum", "disgusting"),
}
OTHER, OVERALL = "coded", "toxic"
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6)
TRAIN_ROWS = 10_000
FOLDS = 5
SELECTED = 1_024
LEAST_Z = 5.5
ROUNDS = 150


def features(data, offsets):
    """(row, bucket) of each word and beginning of a word of the texts in a slice."""
    data = words.LOWER[data]
    starts, ends, first = words.spans(data, offsets, words.ALNUM)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    yield row, words.span_hashes(data, starts, ends) % np.uint64(BUCKETS)
    for n in BEGINNINGS:
        long = ends - starts > n
        found = words.span_hashes(data, starts[long], starts[long] + n)
        yield row[long], words.mix(found + np.uint64(n)) % np.uint64(BUCKETS)


def presence(texts):
    """Distinct buckets of each text."""
    out = []
    for _, _, data, offsets in words.slices(pa.array(texts, pa.string())):
        found = list(features(data, offsets))
        row, ids = (np.concatenate(x) for x in zip(*found))
        pairs = np.unique(row.astype(np.uint64) << np.uint64(32) | ids)
        edges = np.searchsorted(pairs >> np.uint64(32), np.arange(len(offsets)).astype(np.uint64))
        ids = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        out += [ids[edges[i] : edges[i + 1]] for i in range(len(offsets) - 1)]
    return out


def select(docs, y):
    """Buckets whose presence speaks most clearly for the category.

    Rows count once each, also where a class is sampled: how clear a difference between two
    samples is depends on the rows there are, not on those they stand for.
    """
    y = y.astype(bool)
    counts = [np.zeros(BUCKETS), np.zeros(BUCKETS)]
    for own, label in zip(docs, y):
        counts[int(label)][own] += 1
    clean, hit = counts
    total, share = hit + clean, y.mean() if len(y) else 0.0
    gain = np.zeros(BUCKETS)  # log-likelihood ratio of presence and category
    for seen, expected in (
        (hit, total * share),
        (clean, total * (1 - share)),
        (y.sum() - hit, (len(y) - total) * share),
        ((~y).sum() - clean, (len(y) - total) * (1 - share)),
    ):
        gain += seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))
    z = np.sqrt(np.maximum(2 * gain, 0)) * np.sign(hit - total * share)
    z[hit < 3] = 0
    best = np.argsort(-z, kind="stable")[:SELECTED]
    chosen = best[z[best] >= LEAST_Z]
    return chosen if len(chosen) >= 8 else best[:64][z[best[:64]] > 0]


class Linear:
    """Logistic regression on the presence of chosen buckets and some dense columns."""

    def __init__(self, chosen, width):
        self.chosen, self.weights = chosen, np.zeros(len(chosen))
        self.dense, self.bias = np.zeros(width), 0.0

    def _sparse(self, docs):
        number = np.full(BUCKETS, -1, np.int32)
        number[self.chosen] = np.arange(len(self.chosen))
        found = [number[own] for own in docs]
        found = [x[x >= 0] for x in found]
        rows = np.repeat(np.arange(len(docs)), [len(x) for x in found])
        return rows, (np.concatenate(found) if found else np.zeros(0, np.int32))

    def _raw(self, rows, cols, dense, n):
        return np.bincount(rows, self.weights[cols], n)[:n] + dense @ self.dense + self.bias

    def fit(self, docs, dense, y, weight=None, decay=3e-4):
        """``weight`` is what each row stands for; only ratios count."""
        rows, cols = self._sparse(docs)
        n, k = len(docs), len(self.chosen)
        weight = np.ones(n) if weight is None else weight * (n / weight.sum())
        hits = (weight * y).sum()
        self.bias = float(np.log((hits + 0.5) / (n - hits + 0.5)))
        state = np.zeros(k + dense.shape[1] + 1)
        speed, power = np.zeros_like(state), np.zeros_like(state)
        state[-1] = self.bias
        for step in range(1, ROUNDS + 1):  # Adam on the whole sample
            self.weights, self.dense, self.bias = state[:k], state[k:-1], float(state[-1])
            p = 1 / (1 + np.exp(-np.clip(self._raw(rows, cols, dense, n), -50, 50)))
            off = weight * (p - y) / n
            slope = np.concatenate([np.bincount(cols, off[rows], k)[:k], off @ dense, [off.sum()]])
            slope[:-1] += decay * state[:-1]
            speed = 0.9 * speed + 0.1 * slope
            power = 0.99 * power + 0.01 * slope**2
            state = state - 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-8)
        self.weights, self.dense, self.bias = state[:k], state[k:-1], float(state[-1])
        return self

    def predict(self, docs, dense):
        rows, cols = self._sparse(docs)
        return 1 / (1 + np.exp(-np.clip(self._raw(rows, cols, dense, len(docs)), -50, 50)))


def chain(docs, labels, folds, weight=None):
    """Fit a model per column of ``labels``; ``folds`` has the fold and ``weight`` the weight of each text."""
    weight = np.ones(len(docs)) if weight is None else weight
    before, models = np.zeros((len(docs), 0)), []
    for column in labels.T:
        out = np.zeros(len(docs))
        for fold in range(FOLDS):
            held = folds == fold
            inside = [d for d, h in zip(docs, held) if not h]
            if held.any() and len(inside):
                model = Linear(select(inside, column[~held]), before.shape[1])
                model.fit(inside, before[~held], column[~held], weight[~held])
                out[held] = model.predict([d for d, h in zip(docs, held) if h], before[held])
        models.append(Linear(select(docs, column), before.shape[1]).fit(docs, before, column, weight))
        before = np.column_stack([before, out])
    return models


def categories(text, toxic, seeds):
    """Labels of a text: one per seed list, one for toxic texts without a seed, and overall."""
    kinds = words.LOWER[np.frombuffer(text.encode(), np.uint8)]
    kinds = np.where(words.ALNUM[kinds], kinds, 32).astype(np.uint8)
    own = set(kinds.tobytes().split())
    found = [bool(toxic) and any(w.encode() in own for w in list_) for list_ in seeds.values()]
    return [*found, bool(toxic) and not any(found), bool(toxic)]


def _training(seeds):
    def run(batches):
        rows = []
        for batch in batches:
            rows += zip(*(batch.column(c).to_pylist() for c in ("i", "t", "y", "weight")))
        rows.sort()
        labels = np.array([categories(t, y, seeds) for _, t, y, _ in rows], float).reshape(len(rows), len(seeds) + 2)
        folds = words.mix(np.array([r[0] for r in rows], np.int64).view(np.uint64)) % np.uint64(FOLDS)
        weight = np.array([r[3] for r in rows], float)
        models = chain(presence([r[1] for r in rows]), labels, folds, weight) if rows else []
        flat = [x for m in models for x in (m.chosen, m.weights, m.dense, np.array([m.bias]))]
        yield pa.RecordBatch.from_arrays([pa.array([pack(flat)], pa.binary())], ["model"])

    return run


def fit(docs, labels, id_col="doc_id", text_col="text", label_col="toxic", seeds=None, rows=TRAIN_ROWS):
    """The chain for ``seeds`` (lists of words by category), ``coded`` and ``toxic``.

    Trained in one task on a sample of at most ``rows`` labelled texts, half of them toxic if
    there are so many. Texts weigh what they stand for among all labels, so that scores are
    probabilities at the ratio of the labels, whatever the size of the table. Which categories
    a labelled toxic text has follows from the seeds it has; the models see words of all
    kinds and so also learn those that go along with them.
    Rows with a null id, text or label are not used. An id is used once for each label it has,
    with the least of its texts and the weight of all its rows.
    Without any labelled row the model scores everything 0.
    """
    seeds = SEEDS if seeds is None else seeds
    y = labels.select(F.xxhash64(id_col).alias("i"), F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("y"))
    y = y.where("k is not null and y in (0, 1)")
    y = weighted_sample(y.where("y = 1"), "k", rows // 2).union(weighted_sample(y.where("y = 0"), "k", rows // 2))
    x = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where("k is not null and t is not null")
    # An id with several texts stands with the least, so `rows` bounds the sample.
    sample = x.join(F.broadcast(y), "k").groupBy("i", "k", "y", "weight").agg(F.min("t").alias("t"))
    sample = sample.select("i", "t", "y", "weight").repartition(1)
    found = sample.mapInArrow(_training(seeds), "model binary").first()
    flat = unpack(found[0]) if found else []
    models = []
    for k in range(0, len(flat), 4):
        model = Linear(flat[k], len(flat[k + 2]))
        model.weights, model.dense, model.bias = flat[k + 1], flat[k + 2], float(flat[k + 3][0])
        models.append(model)
    return [*seeds, OTHER, OVERALL], models


def probabilities(models, column):
    """Probability of each category for each text of an Arrow column."""
    out = np.zeros((len(column), len(models)))
    if not models:
        return out
    union = np.unique(np.concatenate([m.chosen for m in models]))
    number = np.full(BUCKETS, -1, np.int32)
    number[union] = np.arange(len(union))
    weights = np.zeros((len(union), len(models)))
    for k, m in enumerate(models):
        weights[number[m.chosen], k] = m.weights
    for at, end, data, offsets in words.slices(column):
        rows, cols = [], []
        for row, ids in features(data, offsets):
            col = number[ids]
            rows.append(row[col >= 0])
            cols.append(col[col >= 0])
        pairs = np.unique(np.concatenate(rows) * len(union) + np.concatenate(cols)) if len(union) else np.zeros(0, int)
        row, col = (pairs // len(union), pairs % len(union)) if len(union) else (pairs, pairs)
        n = end - at
        for k, m in enumerate(models):
            raw = np.bincount(row, weights[col, k], n)[:n] + out[at:end, :k] @ m.dense + m.bias
            out[at:end, k] = 1 / (1 + np.exp(-np.clip(raw, -50, 50)))
    return out


def _scoring(held):
    def run(batches):
        names, models = held.value
        for batch in batches:
            found = probabilities(models, batch.column("text"))
            if not models:
                found = np.zeros((batch.num_rows, len(names)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(found[:, k].copy()) for k in range(len(names)))],
                ["id", *(f"p_{n}" for n in names)],
            )

    return run


def score(docs, model, id_col="doc_id", text_col="text", threshold=0.5):
    """``id_col``, ``p_<category>`` for each category, ``score`` and ``toxic`` for every row.

    ``score`` is the probability of the last category of the chain; ``toxic`` says whether it
    reaches ``threshold``. Null and empty texts are judged by the bias alone. Repeated rows
    and null ids are kept; other columns are not looked at.
    """
    names, _ = model
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(f"p_{n}", T.DoubleType()) for n in names)]
    )
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_scoring(held), schema)
    return out.select(
        F.col("id").alias(id_col),
        *(f"p_{n}" for n in names),
        F.col(f"p_{names[-1]}").alias("score"),
        (F.col(f"p_{names[-1]}") >= threshold).alias("toxic"),
    )
