"""Deduplication with a defined survivor.

``dropDuplicates`` leaves open which row of a key stays, so a retried task may
pick another one. Here the survivor is the least row by the remaining columns,
NULLs last. Spark turns ``row_number() == 1`` into a WindowGroupLimit that runs
before the shuffle, so each map task sends at most one row per key and a key
that holds a third of the input costs no more than any other.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

_RANK = "__rank"
_ROW = "__row"
_SPREAD = "__spread"


def _survivors(df, keys, order, for_join):
    partition = list(keys)
    if for_join:
        # Same groups, but the result is not laid out by the keys alone. A join
        # on the keys then brings its own exchange, and only a join fed directly
        # by an exchange on both sides is split by AQE when the other side is hot.
        df = df.withColumn(_SPREAD, F.xxhash64(*keys))
        partition.append(_SPREAD)
    window = Window.partitionBy(*partition).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        df.withColumn(_ROW, F.row_number().over(window))
        .filter(F.col(_ROW) == 1)
        .drop(_ROW, _SPREAD)
    )


def keep_least(df, keys, for_join=False):
    """One row per key (NULL keys form one group): the least by the other columns."""
    order = [c for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(list(keys))
    return _survivors(df, keys, order, for_join)


def keep_first(frames, keys, for_join=False):
    """One row per key over several frames: an earlier frame beats a later one.

    Frames are aligned by column name; a column a frame lacks is NULL.
    """
    ranked = [f.withColumn(_RANK, F.lit(i)) for i, f in enumerate(frames)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    order = [_RANK] + [c for c in union.columns if c not in keys and c != _RANK]
    return _survivors(union, keys, order, for_join).drop(_RANK)


def distinct_keys(df, keys):
    """Distinct key values, combined before the shuffle and ready for a skewed join."""
    return df.select(*keys, F.xxhash64(*keys).alias(_SPREAD)).distinct().drop(_SPREAD)
