"""Quality classifier from supervised subword embeddings.

A text is the mean of learned vectors of its hashed words, pairs of words and character n-grams,
and a softmax layer turns the mean into class probabilities. Vectors and layer are trained
together by stochastic gradient descent in NumPy, in one task, on a bounded sample.
As the layer is linear, a text is scored from one number per bucket, which is all that
leaves the task.
"""

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm import words
from layercake.llm.common import attach, bounded_sample

BUCKETS = 1 << 18
DIM = 16
GRAMS = (3, 5)
TRAIN_ROWS = 5_000
SLICE_BYTES = 500_000  # of texts that are scored at a time; each byte takes about a hundred in memory
EPOCHS = 8
RATE = 0.5
# A vector takes part with its share of the mean, about one in a thousand, which its gradient is times as
# small; so vectors have a rate of their own.
VECTOR_RATE = 50.0


def features(data, offsets, buckets=BUCKETS):
    """Parts (positions, bucket of each) of the texts in a slice: words, pairs, n-grams."""
    starts, ends, first = words.spans(data, offsets, ~words.SPACES)
    hashes = words.span_hashes(data, starts, ends)
    size = np.uint64(buckets)
    yield first, hashes % size
    pairs = words.windows(hashes, 2)
    inside = np.ones(len(pairs), bool)
    edges = first[1:-1]
    inside[edges[(edges > 0) & (edges < len(hashes))] - 1] = False
    kept = np.concatenate([[0], np.cumsum(inside)])
    yield kept[np.minimum(first, len(pairs))], words.mix(pairs[inside] + np.uint64(2)) % size
    # A pair by form: whether a word repeats the one before it, whatever the word is.
    same = np.zeros(len(hashes), np.uint64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < len(hashes)]] = 0
    yield first, words.mix(same + np.uint64(977)) % size
    for n in GRAMS:
        code = np.zeros(max(len(data) - n + 1, 0), np.uint64)
        for i in range(n):
            code = (code << np.uint64(8)) | data[i : i + len(code)]
        code = words.mix(code + np.uint64(n << 56)) % size
        inside = np.ones(len(code), bool)
        for edge in offsets[1:-1]:
            inside[max(edge - n + 1, 0) : edge] = False
        kept = np.concatenate([[0], np.cumsum(inside)])
        yield kept[np.minimum(offsets, len(code))], code[inside]


def _text_features(text):
    """Distinct buckets of one text and the share of each."""
    found = []
    for _, _, data, offsets in words.slices(pa.array([text], pa.string())):
        found = [ids for _, ids in features(data, offsets)]
    ids = np.concatenate(found).astype(np.uint32) if found else np.zeros(0, np.uint32)
    own, counts = np.unique(ids, return_counts=True)
    return own, (counts / max(len(ids), 1)).astype(np.float32)


def train(texts, labels, epochs=EPOCHS, rate=RATE, vector_rate=VECTOR_RATE, seed=1):
    """(vectors, layer, bias) for texts with labels 0 and 1; the same for the same texts."""
    random = np.random.default_rng(seed)
    vectors = ((random.random((BUCKETS, DIM), np.float32) - 0.5) / DIM).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    layer[:] = random.normal(0, 0.1, layer.shape)
    docs = [_text_features(t) for t in texts]
    steps, done = max(epochs * len(docs), 1), 0
    for _ in range(epochs):
        for i in random.permutation(len(docs)):
            own, share = docs[i]
            left = 1 - done / steps
            done += 1
            rows = vectors[own]
            mean = share @ rows
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= rate * left * np.outer(mean, p)
            bias -= 0.1 * rate * left * p
            vectors[own] = rows - vector_rate * left * np.outer(share, back)
    return vectors, layer, bias


def pack(model):
    out = io.BytesIO()
    np.savez_compressed(out, *model)
    return out.getvalue()


def unpack(blob):
    with np.load(io.BytesIO(blob)) as held:
        return tuple(held[k] for k in held.files)


def _training(batches):
    rows = []
    for batch in batches:
        rows += zip(batch.column("i").to_pylist(), batch.column("t").to_pylist(), batch.column("y").to_pylist())
    rows.sort(key=lambda r: (r[0], r[1], r[2]))  # the order in which rows arrive doesn't count
    table, bias = collapse(train([t for _, t, _ in rows], [int(y) for _, _, y in rows]))
    yield pa.RecordBatch.from_arrays([pa.array([pack((table, np.array([bias])))], pa.binary())], ["model"])


def fit(docs, labels, id_col="doc_id", text_col="text", label_col="quality", rows=TRAIN_ROWS):
    """The model of at most ``rows`` labelled texts, as ``collapse`` has it.

    The sample goes by a hash of the id. Rows with a null id, text or label and labels other
    than 0 and 1 are not used. An id is used once for each label it has, with the least of its texts,
    so repeated rows do not make the sample larger. Without any such row the model scores
    everything 0.5.
    """
    y = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
    y = bounded_sample(y.where("i is not null and y in (0, 1)"), "i", rows)
    x = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    sample = x.join(F.broadcast(y), "i").groupBy("i", "y").agg(F.min("t").alias("t"))
    # `rows` bounds the broadcast and the task.
    found = sample.select("i", "t", "y").repartition(1).mapInArrow(_training, "model binary").first()
    if not found:
        return collapse(train([], []))
    table, bias = unpack(found[0])
    return table, float(bias[0])


def collapse(model):
    """One number per bucket and a bias: their mean is the log-odds of label 1."""
    vectors, layer, bias = model
    across = layer[:, 1] - layer[:, 0]
    return (vectors @ across).astype(np.float32), float(bias[1] - bias[0])


def scores(table, bias, column):
    out = np.zeros(len(column))
    for at, end, data, offsets in words.slices(column, SLICE_BYTES):
        total, count = np.zeros(end - at), np.zeros(end - at)
        for first, ids in features(data, offsets, len(table)):
            sums = np.concatenate([[0.0], np.cumsum(table[ids], dtype=np.float64)])
            total += sums[first[1:]] - sums[first[:-1]]
            count += np.diff(first)
        out[at:end] = total / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(out + bias, -500, 500)))


def attach_score(docs, model, text_col="text"):
    """``docs`` with ``score``, the probability of label 1, as a new last column.

    Null and empty texts have no part and get what the bias says. All rows are kept, repeated
    ones too; other columns pass through, but one called ``score`` is replaced. An empty
    table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def values(column):
        return [pa.array(scores(*held.value, column))]

    return attach(docs, text_col, [T.StructField("score", T.DoubleType())], values)


def score(docs, model, id_col="doc_id", text_col="text"):
    """``id_col`` and ``score`` for every row of ``docs``, as ``attach_score`` has them."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return attach_score(own, model).select(F.col("id").alias(id_col), "score")
