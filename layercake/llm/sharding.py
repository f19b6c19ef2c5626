"""Shards of nearly equal bytes, by histogram sort.

Rows are ordered by the hash of their group, then of their id; shards are runs of this
order, so rows of a group lie side by side and a large group is cut like anything else.
The cuts come from exact histograms: the bytes (and rows) below a set of candidate
boundaries are counted over all partitions, boundaries that are near enough to the
wanted share of the bytes are taken, and only the cells between the others are counted
again with finer candidates. Then every row is exchanged once, by cell.

A cell is all keys with the same first bits. The key has three parts: the hash of the
group, of the id, and of the place of the row in the written table, which tells repeated
rows apart. A cell is split at the first bits in which its keys differ, so one that holds
a single large group goes on to the ids at once. Cells with many rows are split too,
which bounds what a task sorts; the place of a row in its shard is the number of rows in
the cells before its own, which the histograms know, plus its place in the cell.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm.common import staged

SHARDS = 16
TOLERANCE = 0.001  # of the bytes of a shard, how far a cut may be from its place
BLOCKS = 512  # no cell has more than this part of the rows, or CELL_ROWS if that is more
CELL_ROWS = 20_000
FIRST_BITS = 12
MORE_BITS = 8
PARTS = 3
PART_BITS = 60


def _low(part, split_part, bits):
    """The least key part of the cell of a row: its first ``bits``, if it is the part that is split."""
    drop = f"({PART_BITS} - {bits})"
    masked = f"shiftleft(shiftright(k{part}, {drop}), {drop})"
    return F.expr(f"CASE WHEN {split_part} > {part} THEN k{part} WHEN {split_part} = {part} THEN {masked} ELSE 0L END")


LOWS = [f"low{p}" for p in range(PARTS)]


def _counted(cells):
    """The histogram: rows, bytes and range of keys of each cell, in the order of keys."""
    found = cells.groupBy(*LOWS).agg(
        F.count("*").alias("n"),
        F.sum("size").alias("size"),
        *(f(f"k{p}").alias(f"{f.__name__}{p}") for p in range(PARTS) for f in (F.min, F.max)),
    )
    return [r.asDict() for r in found.collect()]  # at most as many as there were candidates


def _split(cell):
    """(part, bits) that split a cell, or None if all its keys are equal."""
    for p in range(PARTS):
        differ = cell[f"min{p}"] ^ cell[f"max{p}"]
        if differ:
            return p, min(PART_BITS, PART_BITS - differ.bit_length() + MORE_BITS)
    return None


def _cuts(cells, shards):
    """For every cut between shards the number of cells before it: the boundary next to its place."""
    below = [0]
    for cell in cells:
        below.append(below[-1] + cell["size"])
    cuts, at = [], 0
    for k in range(1, shards):
        while at + 1 < len(below) and abs(shards * below[at + 1] - k * below[-1]) <= abs(shards * below[at] - k * below[-1]):
            at += 1
        cuts.append(at)
    return cuts, below


def _unsettled(cells, shards, tolerance, most_rows):
    """Cells to be split: those around a cut that is too far from its place, and large ones."""
    cuts, below = _cuts(cells, shards)
    total, chosen = below[-1], {i for i, c in enumerate(cells) if c["n"] > most_rows}
    for k, at in enumerate(cuts, 1):
        off = k * total - shards * below[at]
        if abs(off) > tolerance * total:
            chosen.add(at if off > 0 else at - 1)
    return [i for i in sorted(chosen) if 0 <= i < len(cells) and cells[i]["n"] > 1 and _split(cells[i])]


def shard(rows, id_col="doc_id", size_col="size", group_col=None, shards=SHARDS, tolerance=TOLERANCE, blocks=BLOCKS):
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, from 0 without gaps in each shard).

    The sum of ``size_col`` in a shard differs from an equal share by at most ``tolerance`` of it at
    either end, or by the one row there if that is larger. ``group_col`` is what keeps rows side
    by side; without it, every row is its own group. Null ids, groups and sizes are values
    like any other (a null size is 0); repeated rows each get a place of their own. An
    empty table gives an empty result. Other columns pass through, whatever their names; columns that
    are called ``shard`` or ``slot`` are replaced. The order depends on the values of rows
    alone, and for rows of equal id and group on where they were written.
    """
    spark = rows.sparkSession
    names = [c for c in rows.columns if c not in ("shard", "slot")]

    def key(column):
        return F.shiftrightunsigned(F.xxhash64(column), 64 - PART_BITS)

    ids, group = rows[f"`{id_col}`"], rows[f"`{group_col or id_col}`"]
    keyed = rows.select(
        *(rows[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)),
        F.coalesce(rows[f"`{size_col}`"].cast("long"), F.lit(0)).alias("size"),
        key(group).alias("k0"),
        key(ids).alias("k1"),
        key(F.monotonically_increasing_id()).alias("k2"),
    )
    keyed = staged(keyed, "shard-rows")  # fixes k2, and spares the counts the rest of the row

    cells = keyed
    for p in range(PARTS):
        cells = cells.withColumn(LOWS[p], _low(p, "0", str(FIRST_BITS)))
    known = {tuple(c[x] for x in LOWS): c for c in _counted(cells)}
    total = sum(c["n"] for c in known.values())
    most_rows = max(CELL_ROWS, total // blocks)
    schema = T.StructType(
        [
            *(T.StructField(f"at{p}", T.LongType()) for p in range(PARTS)),
            T.StructField("part", T.IntegerType()),
            T.StructField("bits", T.IntegerType()),
        ]
    )
    while True:
        ordered = [known[k] for k in sorted(known)]
        again = _unsettled(ordered, shards, tolerance, most_rows)
        if not again:
            break
        gone = [(tuple(ordered[i][x] for x in LOWS), _split(ordered[i])) for i in again]
        finer = spark.createDataFrame([(*low, *how) for low, how in gone], schema)
        same = [F.col(LOWS[p]) == F.col(f"at{p}") for p in range(PARTS)]

        def refined(how, cells=cells, finer=finer, same=same):
            # The list is as long as there are cuts and large cells: at most shards + blocks.
            joined = cells.join(F.broadcast(finer), same, how)
            lows = [F.when(F.col("part").isNull(), F.col(LOWS[p])).otherwise(_low(p, "part", "bits")) for p in range(PARTS)]
            others = [c for c in cells.columns if c not in LOWS]
            return joined.select(*others, *(low.alias(LOWS[p]) for p, low in enumerate(lows)))

        for low, _ in gone:
            del known[low]
        for c in _counted(refined("inner")):
            known[tuple(c[x] for x in LOWS)] = c
        cells = refined("left")

    cuts, _ = _cuts(ordered, shards)
    plan, own, before = [], 0, 0
    for i, cell in enumerate(ordered):
        while own < len(cuts) and cuts[own] <= i:
            own, before = own + 1, 0
        plan.append((*(cell[x] for x in LOWS), own, before))
        before += cell["n"]
    schema = T.StructType(
        [
            *(T.StructField(f"at{p}", T.LongType()) for p in range(PARTS)),
            T.StructField("shard", T.IntegerType()),
            T.StructField("before", T.LongType()),
        ]
    )
    plan = spark.createDataFrame(plan, schema)
    placed = cells.join(F.broadcast(plan), [F.col(LOWS[p]) == F.col(f"at{p}") for p in range(PARTS)])
    order = Window.partitionBy("shard", *LOWS).orderBy(*(f"k{p}" for p in range(PARTS)))
    slot = F.col("before") + F.row_number().over(order) - 1
    return placed.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "shard", slot.cast("long").alias("slot")
    )


def measured(docs, id_col="doc_id", text_col="text"):
    """``id_col``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32`` and ``group``, the hash of the
    text, of every row. A null text counts as an empty one."""
    text = docs[f"`{text_col}`"]
    data = F.encode(F.coalesce(text, F.lit("")), "utf-8")
    return docs.select(
        docs[f"`{id_col}`"].alias(id_col),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(data).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("group"),
    )


def write(sharded, path, fmt="parquet"):
    """Write a folder ``shard=<n>`` per shard; a file holds runs of rows in the order of ``slot``."""
    sharded.write.partitionBy("shard").format(fmt).save(path)
