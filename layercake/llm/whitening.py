"""Whitening of embeddings from an exact scatter matrix of bit planes.

Entries become integers, shifted so that the least of each dimension of a block of rows is 0.
Bit ``p`` of dimension ``d`` over the rows is a plane, packed into 64-bit words. The sum of
products of two dimensions is the sum over their planes ``p``, ``q`` of ``2**(p + q)`` times
the number of rows that have both bits, an AND and a popcount. The shift is taken back
and blocks are added up as integers of any size; so the cross products, the sums and the number of
rows (a plane of ones) are exact, and the scatter matrix is centred as integers. Only
then it becomes a matrix of doubles, for ``eigh``.
"""

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm.common import staged

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
BLOCK = 8192  # rows whose planes are in memory at a time
MOST = 1 << 48  # integers are cut to this range: entries beyond 2**38 have no exact place in it
LEAST_SHARE = 1e-13  # of the trace; components below have no variance beyond rounding
_LONG = (1 << 63) - 1


def integers(column, dimension):
    """(rows, x): the rows of an Arrow column of lists that are usable, and their integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), dimension), False).to_numpy(False))
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan)
    values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), dimension)
    finite = np.isfinite(values).all(axis=1)
    x = np.clip(np.floor(SCALE * values[finite]), -MOST, MOST).astype(np.int64) + SHIFT
    return rows[finite], x


def planes(y):
    """(words, dimensions, places): the bit planes of non-negative integers, by rising place.

    Planes without a bit are left out.
    """
    words = -(-len(y) // 64)
    out, dims, places = [], [], []
    for p in range(int(y.max(initial=0)).bit_length()):
        packed = np.zeros((y.shape[1], words * 8), np.uint8)
        bits = np.packbits((y >> np.uint64(p)).astype(np.uint8).T & 1, axis=1)
        packed[:, : bits.shape[1]] = bits
        some = np.flatnonzero(bits.any(axis=1))
        out.append(packed[some].view(np.uint64))
        dims.append(some)
        places.append(np.full(len(some), p))
    if not out:
        return np.zeros((0, words), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(dims), np.concatenate(places)


def scatter(x):
    """Exact sums of products of every two columns of ``x`` and a column of ones, as Python integers."""
    d = x.shape[1]
    low = x.min(axis=0)
    y = np.ones((len(x), d + 1), np.uint64)
    y[:, :d] = (x - low).astype(np.uint64)
    words, dims, places = planes(y)
    top = int(places.max()) + 1
    # By p + q, so that no weight is applied before the counts are added up.
    sums = np.zeros((2 * top - 1, d + 1, d + 1), np.int64)
    for i in range(len(words)):
        both = np.bitwise_count(words[i] & words[i:]).sum(axis=1, dtype=np.int64)
        at = places[i] + places[i:]
        sums[at, dims[i], dims[i:]] += both
        sums[at[1:], dims[i + 1 :], dims[i]] += both[1:]
    total = np.zeros((d + 1, d + 1), object)
    for s in range(2 * top - 1):
        total += sums[s].astype(object) << s
    # x = y + low: take the shift back.
    shift, ysum = np.append(low, 0).astype(object), total[d]
    ones = np.outer(shift, ysum)
    return total + ones + ones.T + ysum[d] * np.outer(shift, shift)


def _scattering(dimension):
    def run(batches):
        total, held, rows = None, [], 0

        def add(x, total):
            own = scatter(x)
            return own if total is None else total + own

        for batch in batches:
            held.append(integers(batch.column(0), dimension)[1])
            rows += len(held[-1])
            while rows >= BLOCK:
                x = np.concatenate(held)
                total, held, rows = add(x[:BLOCK], total), [x[BLOCK:]], rows - BLOCK
        if rows:
            total = add(np.concatenate(held), total)
        if total is not None:
            a, b = np.triu_indices(dimension + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(a.astype(np.int32)),
                    pa.array(b.astype(np.int32)),
                    pa.array([Decimal(v) for v in total[a, b]], pa.decimal128(38, 0)),
                ],
                ["a", "b", "v"],
            )

    return run


def fit(table, vector_col="embedding", components=COMPONENTS):
    """The model of the usable vectors of ``table``: exact sums, and the directions and variances.

    ``n`` rows, ``sums`` (Python integers), ``values`` and ``vectors`` of the first components,
    and the ``trace``. None if there is no usable vector.
    """
    vectors = table.select(F.col(f"`{vector_col}`").alias("v"))
    # Vectors are as long as most are.
    longest = vectors.where("v IS NOT NULL").groupBy(F.size("v").alias("d")).count()
    longest = longest.orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if longest is None or longest["d"] == 0:
        return None
    d = longest["d"]
    parts = vectors.mapInArrow(_scattering(d), "a int, b int, v decimal(38,0)")
    cross = np.zeros((d + 1, d + 1), object)
    found = parts.groupBy("a", "b").agg(F.sum("v").alias("v")).collect()  # a row for two dimensions
    if not found:
        return None
    for r in found:
        cross[r["a"], r["b"]] = cross[r["b"], r["a"]] = int(r["v"])
    n, sums = cross[d, d], cross[d, :d]
    centred = n * cross[:d, :d] - np.outer(sums, sums)
    covariance = (centred / (n * n)).astype(np.float64)  # quotients of integers are rounded once
    values, directions = np.linalg.eigh(covariance)
    top = np.argsort(-values, kind="stable")[:components]
    return {
        "dimension": d,
        "n": n,
        "sums": [int(s) for s in sums],
        "values": np.maximum(values[top], 0.0),
        "vectors": directions[:, top],
        "trace": float(np.trace(covariance)),
    }


def _deviations(y, n, rest):
    """Sums of squares of ``n * y - rest``: exact, None beyond 64 bits."""
    if not len(y):
        return []
    off = y.astype(np.float64) * n - np.array(rest, np.float64)
    small = (off**2).sum(axis=1) < 2.0**62
    out = np.empty(len(y), object)
    out[small] = ((y[small] * n - np.array(rest, np.int64)) ** 2).sum(axis=1) if small.any() else 0
    for i in np.flatnonzero(~small):
        exact = sum((n * int(v) - r) ** 2 for v, r in zip(y[i], rest, strict=True))
        out[i] = exact if exact <= _LONG else None
    return out.tolist()


def _whitening(model):
    n, d = model["n"], model["dimension"]
    whole = np.array([s // n for s in model["sums"]], np.int64)
    rest = [s % n for s in model["sums"]]
    fraction = np.array([r / n for r in rest])
    some = model["values"] > LEAST_SHARE * model["trace"]
    scale = np.where(some, 1 / np.sqrt(np.where(some, model["values"], 1.0)), np.nan)

    def run(batches):
        for batch in batches:
            rows, x = integers(batch.column("v"), d)
            y = x - whole
            z = ((y - fraction) @ model["vectors"]) * scale
            lists = pa.FixedSizeListArray.from_arrays(pa.array(z.ravel(), from_pandas=True), z.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows)),
                    pa.array(_deviations(y, n, rest), pa.int64()),
                    lists.cast(pa.list_(pa.float64())),
                ],
                ["id", "deviation", "z"],
            )

    return run


def whiten(table, id_col="vec_id", vector_col="embedding", components=COMPONENTS):
    """(rows, model): ``id_col``, ``deviation`` and ``whitened``, an array, for every usable vector.

    Vectors that are null, hold nulls or values that are not finite, or are not as long as most are left out.
    Null ids and repeated rows are kept as they are. ``deviation`` is null where it does not
    fit into 64 bits, and a component is null throughout if its variance is 0 but for rounding.
    ``model["error"]`` is the largest entry of the covariance of ``whitened`` minus the identity, taken
    over the rows that were written; None if no component has a variance. Without any
    usable vector the result is empty and the model None. Other columns are not looked at.
    """
    spark = table.sparkSession
    kind = table.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("deviation", T.LongType()),
            T.StructField("z", T.ArrayType(T.DoubleType())),
        ]
    )
    model = fit(table, vector_col, components)
    if model is None:
        rows = spark.createDataFrame([], schema)
    else:
        given = table.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
        rows = staged(given.mapInArrow(_whitening(model), schema), "whitened")
        # covar_pop centres before it multiplies, and leaves out nulls.
        k = len(model["values"])
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        row = rows.agg(*(F.covar_pop(F.col("z")[i], F.col("z")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
        found = [abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs if row[f"c{i}_{j}"] is not None]
        model["error"] = max(found) if found else None
    return rows.select(F.col("id").alias(id_col), "deviation", F.col("z").alias("whitened")), model


def by_component(rows, model, id_col="vec_id"):
    """A row for each row of ``whiten`` and component, with what the model says about it."""
    shares = [] if model is None or not model["trace"] else [float(v / model["trace"]) for v in model["values"]]
    long = rows.select(id_col, "deviation", F.posexplode("whitened").alias("i", "whitened"))
    explained = F.try_element_at(F.array(*(F.lit(s) for s in shares)).cast("array<double>"), F.col("i") + 1)
    return long.select(
        id_col,
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(None if model is None else model["n"]).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(None if model is None else model["error"]).cast("double").alias("identity_error"),
    )
