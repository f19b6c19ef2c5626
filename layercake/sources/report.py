"""Storage per layer and table previews."""

from functools import reduce

from pyspark.sql import functions as F

from layercake.sources.lake import together

LAYERS = ("bronze", "silver", "gold")
TOTAL = "total"


def storage_report(lake, layers=LAYERS, all_versions=False):
    """Tables, bytes and MiB per layer, then their total, MiB rounded to two places at the end.

    Only the metadata of data files is read. A layer with no table counts as 0.
    Superseded versions are left out unless ``all_versions`` is set.
    """
    spark = lake.spark
    entries = lake.entries()
    counts = [(a, sum(t.startswith(a + "/") for t in entries), 0) for a in layers]
    parts = [spark.createDataFrame(counts, "layer string, tables long, bytes long")]
    for layer in layers:
        tables = {t: e for t, e in entries.items() if t.startswith(layer + "/")}
        paths = [p for t, e in tables.items() for p in ([f"{lake.root}/{t}"] if all_versions else e.paths())]
        if paths:
            files = (
                spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
            )
            parts.append(
                files.select(
                    F.lit(layer).alias("layer"),
                    F.lit(0).cast("long").alias("tables"),
                    F.col("length").alias("bytes"),
                )
            )
    sizes = reduce(lambda a, b: a.unionByName(b), parts)
    return (
        sizes.rollup("layer")
        .agg(F.sum("tables").alias("tables"), F.sum("bytes").alias("bytes"))
        .select(
            F.coalesce("layer", F.lit(TOTAL)).alias("layer"),
            "tables",
            "bytes",
            F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 2).alias("size_mib"),
        )
    )


def preview(df, order_by, n=10):
    """The first ``n`` rows by the given columns (a top-n, never a full sort).

    The other columns decide between equal rows, so the result is always the same.
    """
    columns = [*order_by, *[c for c in df.columns if c not in order_by]]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns]).limit(n)


def inventory(lake, tables):
    """Which of the named tables there are, with their columns and numbers of rows; NULL for a missing one.

    Rows are counted from the metadata of the files, all tables at the same time.
    """
    entries = lake.entries()

    def described(name):
        if name not in entries:
            return name, False, None, None
        table = lake.read(name, entries)
        return name, True, ", ".join(table.columns), table.count()

    rows = together(lake.spark, [lambda n=n: described(n) for n in tables])
    return lake.spark.createDataFrame(rows, "table string, found boolean, columns string, rows long")


def preview_tables(lake, tables, n=13):
    """Print schema and some rows of each table; say so and go on where one is missing."""
    entries = lake.entries()
    for name in tables:
        table = lake.read(name, entries)
        if table is None:
            print(f"{name}: no such table")
            continue
        print(name)
        table.printSchema()
        table.show(n, truncate=False)
