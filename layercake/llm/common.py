"""Helpers the operators share."""

import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.sources.files import shuffles_removed
from layercake.sources.workspace import new_folder


def staged(df, name):
    """``df`` written once to the shared folder and read again; null stays null.

    Its shuffle files go with the write, or those of all steps of an operator would add up on the disks.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path, compression="zstd")
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def release(*tables):
    """Replace ``staged`` tables that nothing reads any more by empty ones, which frees their disk."""
    for table in tables:
        empty = table.sparkSession.createDataFrame([], table.schema)
        empty.coalesce(1).write.parquet(table.staged_at, mode="overwrite")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of(column):
    """crc32 of a value as text."""
    return F.crc32(F.col(column).cast("string"))


def bounded_sample(df, key, rows):
    """At most ``rows`` distinct rows of ``df``, the same ones every time; all where there are fewer.

    Those with the least hash of ``key`` are taken.
    """
    return weighted_sample(df, key, rows).drop("weight")


def weighted_sample(df, key, rows):
    """``bounded_sample`` with a column ``weight``: how many rows of ``df`` each stands for."""
    unique = df.groupBy(*df.columns).agg(F.count("*").alias("weight"))
    total = unique.count()
    order = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 31))
    chosen = unique.orderBy(order, *df.columns).limit(rows)  # the first of each task, then of these
    return chosen.withColumn("weight", F.col("weight") * F.lit(max(1.0, total / max(rows, 1))))


def ship(spark):
    """Send this package to the Python workers of the session, once; a job submitted with
    ``--py-files`` has no need of it, but does no harm."""
    context = spark.sparkContext
    if getattr(context, "_layercake_sent", False):
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="layercake-")
    archive = os.path.join(folder, "layercake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "layercake").rglob("*.py")):
            out.write(source, source.relative_to(root).as_posix())
    context.addPyFile(archive)
    context._layercake_sent = True


def attach(docs, text_col, fields, values):
    """``docs`` with new columns that Python makes from its texts, batch by batch.

    ``values(column)`` returns an array for each of ``fields``. Columns of ``docs`` pass
    through under numbered names, so none can clash with another; one that has the name
    of a new column is replaced.
    """
    names = [c for c in docs.columns if c == text_col or c not in {f.name for f in fields}]
    at = f"c{names.index(text_col)}"
    inner = docs.select(*(docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(names)))
    made = [f"n{i}" for i in range(len(fields))]
    schema = T.StructType(
        [*inner.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(made, fields, strict=True))]
    )

    def run(batches):
        for batch in batches:
            arrays = [*batch.columns, *values(batch.column(at))]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *made])

    out = inner.mapInArrow(run, schema)
    return out.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in {f.name for f in fields}),
        *(F.col(n).alias(f.name) for n, f in zip(made, fields, strict=True)),
    )
