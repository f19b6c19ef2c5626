"""Upserts as functions from (stored rows, batch rows) to the new table.

Both sides are shuffled on the key; where one is small, Spark itself turns the join
into a broadcast of it. What is known to be unique is neither deduplicated nor read twice.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.operators.dedup import keep_least

_SEEN = "__seen"
_MASK = "__mask"
# Column that tells how a row of an upsert came about; see ``upsert_non_null``.
CHANGE = "__change"


def _all(conditions):
    return reduce(lambda a, b: a & b, conditions)


def _renamed(df, prefix):
    return df.withColumnsRenamed({c: prefix + c for c in df.columns})


def _newest(column):
    """The batch's value if it has one, else the stored value."""
    return f"coalesce(`__n_{column}`, `{column}`)"


def _equal(keys, prefix, null_safe=False):
    """Key equality between plain columns and their prefixed counterparts."""
    pairs = [(F.col(k), F.col(prefix + k)) for k in keys]
    return _all([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _shaped_like(df, target):
    """Columns of ``target`` in its order and types; a column ``df`` lacks is NULL."""
    have = dict(df.dtypes)
    return df.select(
        *[
            (
                F.col(f.name)
                if have.get(f.name) == f.dataType.simpleString()
                else F.col(f.name).cast(f.dataType).alias(f.name)
                if f.name in have
                else F.lit(None).cast(f.dataType).alias(f.name)
            )
            for f in target.schema.fields
        ]
    )


def _absent(batch, target, keys, null_safe, target_unique=False):
    """Rows of ``batch`` whose key no row of ``target`` has."""
    stored = _renamed(target.select(*keys), "__t_")
    if not target_unique:
        # Combined before the shuffle, so that a hot key is sent once per task.
        stored = stored.distinct()
    # A merge: Spark goes by the size of compressed files, and would send the keys of a whole table
    # through the driver.
    return batch.join(stored.hint("merge"), _equal(keys, "__t_", null_safe), "left_anti")


def check_columns(df, names, what):
    """Raise ``ValueError`` if ``df`` lacks one of the named columns."""
    unknown = [n for n in dict.fromkeys(names) if n not in df.columns]
    if unknown:
        raise ValueError(f"no such column of the {what}: {', '.join(unknown)}")


def missing(old, new, keys):
    """One row for each key of ``new`` that ``old`` lacks; ``old`` is unique, NULL keys are equal."""
    return _absent(keep_least(new, keys), old, keys, null_safe=True, target_unique=True)


def insert_missing(old, new, keys):
    """``keep_first([old, new], keys)`` for an ``old`` that is already unique.

    Stored rows pass through untouched; only the batch is deduplicated.
    """
    return old.unionByName(missing(old, new, keys), allowMissingColumns=True)


def _with_plain_keys(df, keys):
    """Keys without NULLs, plus a bit mask of those that were NULL.

    Equality on these columns treats NULL keys as equal, and unlike ``<=>`` it
    lets the join use the layout and order the deduplication left behind.
    """
    # The stand-ins for a NULL; the mask tells them from real keys.
    stand_in = {f.name: "''" if isinstance(f.dataType, T.StringType) else "0" for f in df.schema}
    mask = " + ".join(f"if(`{k}` IS NULL, {1 << i}, 0)" for i, k in enumerate(keys))
    return df.selectExpr(
        f"{mask} AS {_MASK}",
        *[
            f"coalesce(`{c}`, {stand_in[c]}) AS `{c}`" if c in keys else f"`{c}`"
            for c in df.columns
        ],
    )


def upsert_non_null(old, new, keys, old_unique=False, changes=False):
    """Upsert where a non-NULL batch value replaces the stored one, column by column.

    Both sides are reduced to one row per key first. A key with a NULL in it
    matches nothing; one row is kept per such key and the stored one wins. The
    result has one row per key, so it can be passed back with ``old_unique=True``.

    ``changes`` adds a column ``CHANGE``, NULL where the row is the stored one as it was:
    else a struct of ``kind`` (``inserted`` or ``updated``) and the stored values, by column.
    It comes from the same join, so knowing what changed costs no further pass.
    """
    new = _shaped_like(new, old)
    # Both sides are unique once deduplicated, so a hot key cannot skew the join,
    # and it needs no exchange beyond the two of the deduplication.
    plain = [*keys, _MASK]
    stored = _with_plain_keys(old, keys)
    if not old_unique:
        stored = keep_least(stored, plain)
    batch = _renamed(keep_least(_with_plain_keys(new, keys), plain), "__n_")
    joined = stored.join(batch, _equal(plain, "__n_"), "full_outer")
    stored_wins = f"{_MASK} > 0 AND __n_{_MASK} IS NOT NULL"
    values = [
        f"if({_newest(_MASK)} & {1 << keys.index(c)} = 0, {_newest(c)}, NULL) AS `{c}`"
        if c in keys
        else f"if({stored_wins}, `{c}`, {_newest(c)}) AS `{c}`"
        for c in old.columns
    ]
    if changes:
        rest = [c for c in old.columns if c not in keys]
        differs = " OR ".join(f"NOT ({_newest(c)} <=> `{c}`)" for c in rest) or "false"
        before = "".join(f", '{c}', `{c}`" for c in rest)
        values.append(
            f"CASE WHEN {_MASK} IS NULL THEN named_struct('kind', 'inserted'{before})"
            f" WHEN {_MASK} = 0 AND ({differs}) THEN named_struct('kind', 'updated'{before}) END AS {CHANGE}"
        )
    return joined.selectExpr(*values)


def merge_into(
    target,
    source,
    keys,
    update_columns,
    insert_columns=None,
    source_unique=False,
    target_unique=False,
):
    """MERGE: set ``update_columns`` on matched rows, insert the other source rows.

    A NULL in the source overwrites. Every target row of a key is updated; the
    source is reduced to one row per key. Columns not inserted are NULL. Keys and
    columns must be columns of the target, and of the source, or ``ValueError`` is raised.

    If the target is known to be unique on the keys, no key can be hot, and one full
    outer join reads each side once. Else a left join and an anti join, which can be
    split when a target key is hot, read both twice: pass stored tables then.
    """
    insert_columns = update_columns if insert_columns is None else insert_columns
    for df, what in ((target, "target"), (source, "source")):
        check_columns(df, [*keys, *update_columns, *insert_columns], what)
    # Rows with a NULL key match nothing and are inserted as they are. Set apart,
    # they leave both joins the same source, whose shuffle Spark then does once.
    no_null = _all([F.col(k).isNotNull() for k in keys])
    types = dict((f.name, f.dataType) for f in target.schema.fields)
    if target_unique:
        if not source_unique:
            source = keep_least(source, keys)
        stored = target.withColumn("__there", F.lit(True))
        marked = _renamed(source, "__s_").withColumn(_SEEN, F.lit(True))
        joined = stored.join(marked, _equal(keys, "__s_"), "full_outer")
        there, seen = F.col("__there").isNotNull(), F.col(_SEEN).isNotNull()

        def value(c):
            new = F.col("__s_" + c).cast(types[c]) if c in source.columns else F.lit(None).cast(types[c])
            old = F.when(there & ~seen, F.col(c))
            updated = new if c in update_columns else F.col(c)
            inserted = new if c in insert_columns else F.lit(None).cast(types[c])
            return old.when(there, updated).otherwise(inserted).alias(c)

        return joined.select(*[value(c) for c in target.columns])
    loose, source = source.filter(~no_null), source.filter(no_null)
    if not source_unique:
        loose, source = keep_least(loose, keys), keep_least(source, keys, for_join=True)
    marked = _renamed(source, "__s_").withColumn(_SEEN, F.lit(True))
    matched = F.col(_SEEN).isNotNull()
    updated = target.join(marked, _equal(keys, "__s_"), "left").select(
        *[
            F.when(matched, F.col("__s_" + c).cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in update_columns
            else F.col(c)
            for c in target.columns
        ]
    )
    absent = _absent(source, target, keys, null_safe=False)
    inserted = absent.unionByName(loose).select(
        *[
            (F.col(c) if c in insert_columns else F.lit(None)).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(inserted)


def update_where(df, condition, assignments):
    """UPDATE: set columns where ``condition`` is true; a NULL condition changes nothing.

    ``condition`` and the assigned values are Columns or SQL expressions, all
    evaluated on the row as it was before the update. Assigning to a column that
    ``df`` lacks raises ``ValueError``.
    """
    check_columns(df, assignments, "table")
    hit = F.expr(condition) if isinstance(condition, str) else condition
    hit = F.coalesce(hit, F.lit(False))
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    values = {c: F.expr(v) if isinstance(v, str) else v for c, v in assignments.items()}
    return df.select(
        *[
            F.when(hit, values[c].cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in df.columns
        ]
    )
