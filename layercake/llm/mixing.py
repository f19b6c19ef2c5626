"""Mixing sources, languages and topics to target weights.

Token counts by source, language and topic are raked to the target shares by iterative
proportional fitting: each axis in turn is scaled to its targets, with no cell above the
tokens it has. Documents are then drawn with the probability of their cell, by a hash of
the id, so a document is drawn or not however the work is split and repeated.

Values without a target of their own are one cell per axis, so the number of cells follows
the targets and not the data. Targets that sum to 1 say nothing of them: they then keep the
share of the tokens that they have, and the targets share the others.
"""

import numpy as np
from pyspark.sql import functions as F

REST = "(rest)"
ROUNDS = 200
SALT = "mix"
NOTHING = 1e-9  # what targets leave to 1 by rounding only


def topic_of(text):
    """A plain topic by form, from what a text has in it: a column of a few fixed values."""
    clean = F.coalesce(text, F.lit(""))
    symbols = F.length(clean) - F.length(F.translate(clean, "#*$%&|<>{}=", ""))
    return (
        F.when(clean.rlike("(?i)licen[cs]e"), "licence")
        .when(symbols * 50 > F.length(clean), "markup")
        .when(F.length(clean) < 1000, "short")
        .otherwise("prose")
    )


def rake(tokens, targets, budget, rounds=ROUNDS, tolerance=1e-9):
    """Tokens to draw from each cell: an array of the shape of ``tokens``.

    ``targets`` has an array of shares per axis, which are scaled to what the cells with
    tokens leave possible. The result is never above ``tokens``; where cells run out the
    others make up for them as far as their targets on the other axes allow. Axes are
    raked until no cell moves by more than ``tolerance`` of the budget.
    """
    tokens = np.asarray(tokens, float)
    budget = min(float(budget), tokens.sum())
    if budget <= 0:
        return np.zeros_like(tokens)
    drawn = tokens * (budget / tokens.sum())
    shares = []
    for axis, target in enumerate(targets):
        others = tuple(a for a in range(tokens.ndim) if a != axis)
        share = np.where(tokens.sum(axis=others) > 0, np.asarray(target, float), 0)
        shares.append(share / share.sum() if share.sum() > 0 else share)
    for _ in range(rounds):
        before = drawn.copy()
        for axis, share in enumerate(shares):
            others = tuple(a for a in range(tokens.ndim) if a != axis)
            shape = [-1 if a == axis else 1 for a in range(tokens.ndim)]
            now = drawn.sum(axis=others)
            factor = np.divide(share * budget, now, out=np.zeros_like(now), where=now > 0)
            drawn = np.minimum(drawn * factor.reshape(shape), tokens)
        if np.abs(drawn - before).max() <= tolerance * budget:
            break
    return drawn


def _cells(frame, axes, targets, weight):
    """``frame`` with the target value of each axis, and its tokens (no less than 0)."""
    columns = {}
    for i, axis in enumerate(axes):
        named = [v for v in targets[axis] if v != REST]
        value = axes[axis].cast("string")
        columns[f"a{i}"] = F.when(value.isin(named), value).otherwise(F.lit(REST)) if named else F.lit(REST)
    return frame.withColumns(columns).withColumn("tokens", F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0)).cast("long"))


def _shares(target, own, tokens):
    """Shares of the values ``own`` of an axis with ``tokens``, the last of them ``REST``."""
    named = np.array([target[v] for v in own[:-1]], float)
    left = 1 - named.sum()
    if REST in target:
        return [*named, target[REST]]
    if left > NOTHING:
        return [*named, left]
    kept = tokens[-1] / tokens.sum() if tokens.sum() > 0 else 0.0
    named = np.where(tokens[:-1] > 0, named, 0)
    return [*(named * (1 - kept) / max(named.sum(), NOTHING)), kept]


def plan(cells, axes, targets, fraction):
    """Rows (value per axis, tokens, drawn, p) for every cell that has a document."""
    seen = cells.groupBy(*(f"a{i}" for i in range(len(axes)))).agg(F.sum("tokens").alias("tokens"))
    rows = seen.collect()  # at most the product of the numbers of targets, each and one
    values = [[*(v for v in targets[axis] if v != REST), REST] for axis in axes]
    tokens = np.zeros([len(v) for v in values])
    index = [{v: i for i, v in enumerate(own)} for own in values]
    for row in rows:
        tokens[tuple(index[i][row[f"a{i}"]] for i in range(len(axes)))] = row["tokens"]
    wanted = []
    for i, (axis, own) in enumerate(zip(axes, values)):
        others = tuple(a for a in range(tokens.ndim) if a != i)
        wanted.append(_shares(targets[axis], own, tokens.sum(axis=others)))
    drawn = rake(tokens, wanted, fraction * tokens.sum())
    out = []
    for row in rows:
        at = tuple(index[i][row[f"a{i}"]] for i in range(len(axes)))
        p = float(drawn[at] / tokens[at]) if tokens[at] else 0.0
        out.append((*(row[f"a{i}"] for i in range(len(axes))), int(tokens[at]), float(drawn[at]), p))
    return out


def uniform(key, salt=SALT):
    """A number from 0 to 1 that depends on the key only."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs, targets, fraction, id_col="doc_id", text_col="text", axes=None, weight=None):
    """``docs`` with ``cell``, ``probability`` and ``sampled``, for every row.

    ``targets`` maps each axis to shares by value; what they leave to 1 goes to values
    without a share (also null), as one. If they leave nothing, such values keep their share
    of the tokens; a share of 0 for ``REST`` leaves them out. ``axes`` maps axes to columns: by default source, language and
    the topic of ``topic_of``. A row weighs ``weight`` tokens, by default its words; rows
    of weight 0, such as empty texts, are never drawn. ``fraction`` is the share of all tokens
    to draw. Rows with the same id are drawn together or not at all, rows with a null id
    likewise. Columns of ``docs`` with the names of new ones are replaced. An empty table
    gives an empty result.
    """
    text = F.col(text_col)
    axes = axes or {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(text)}
    if set(axes) != set(targets):
        raise ValueError(f"targets for {sorted(targets)}, axes {sorted(axes)}")
    if weight is None:
        weight = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    new = {"cell", "probability", "sampled"}
    kept = [c for c in docs.columns if c not in new]
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(id_col).alias("key"), *(c.alias(f"v{i}") for i, c in enumerate(axes.values())), weight.alias("w"))
    values = {axis: F.col(f"v{i}") for i, axis in enumerate(axes)}
    planned = plan(_cells(inner.select("w", *(f"v{i}" for i in range(len(axes)))), values, targets, F.col("w")), axes, targets, fraction)
    cells = _cells(inner, values, targets, F.col("w"))
    name = F.concat_ws("/", *(f"a{i}" for i in range(len(axes))))
    pairs = [F.lit(x) for *own, _, _, p in planned for x in ("/".join(own), p)]
    chance = F.create_map(*pairs)[F.col("cell")] if pairs else F.lit(0.0)
    found = cells.withColumn("cell", name).withColumn("probability", F.coalesce(chance, F.lit(0.0)))
    found = found.withColumn("sampled", (uniform(F.col("key")) < F.col("probability")) & (F.col("tokens") > 0))
    return found.select("row.*", "cell", "probability", "sampled")
