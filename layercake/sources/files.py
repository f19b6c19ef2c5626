"""Reading and writing single tables in a format chosen at run time."""

import threading
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T


CORRUPT = "_corrupt_record"

# Files of a table in folders that a task has open at a time; beyond that it sorts its rows by folder.
OPEN_FILES = 16
# Set while a table is written. Spark removes the shuffle files of the write at its end, and does not
# sort rows, which takes disk where they do not fit memory, if they go to few folders.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
}
_writes = threading.Lock()
_running = {}


@contextmanager
def shuffles_removed(spark):
    """Writes in here leave no shuffle files behind, nor sort rows that go to few folders.

    Spark keeps them until the driver collects garbage, so those of all steps of a job would add up.
    The plan of a write is not run again. The settings of the session are put back after the
    last of several writes at a time, for what callers run is left as it is.
    """
    with _writes:
        running, before = _running.get(spark, (0, None))
        if not running:
            before = {name: spark.conf.get(name, None) for name in _SETTINGS}
            for name, value in _SETTINGS.items():
                spark.conf.set(name, value)
        _running[spark] = running + 1, before
    try:
        yield
    finally:
        with _writes:
            running, before = _running.pop(spark)
            if running > 1:
                _running[spark] = running - 1, before
            else:
                for name, value in before.items():
                    if value is None:
                        spark.conf.unset(name)
                    else:
                        spark.conf.set(name, value)


def read_json(spark, path, schema=None, keep_corrupt=False):
    """JSON lines. A line that is no JSON or does not fit the schema fails the read.

    With ``keep_corrupt`` it gives a row with its text in ``_corrupt_record`` (null in all
    other rows) and nulls for what could not be read. Without a schema Spark infers one,
    at the cost of a second pass.
    """
    reader = spark.read.option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
    if schema is not None:
        if keep_corrupt:
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema)
    found = reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)
    if keep_corrupt and CORRUPT not in found.columns:
        found = found.withColumn(CORRUPT, F.lit(None).cast("string"))
    return found


def with_declared(df, schema):
    """``df`` with the columns of ``schema`` it lacks, as nulls.

    An inferred schema leaves out a column that is null in every line.
    """
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing)


def read_table(spark, path, fmt="parquet", schema=None):
    """A table in any format the session knows (``delta`` needs its connector)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_if_exists(spark, path, fmt="parquet", schema=None):
    """Like :func:`read_table`, but None when nothing is stored at ``path``."""
    try:
        return read_table(spark, path, fmt, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


# Fixed value: how tables in Parquet are compressed; the files say so, and readers need not know.
PACKED = {"parquet": {"compression": "zstd"}}


def write_table(df, path, fmt="parquet", **options):
    """Replace everything at ``path``, which must not be an input of ``df``."""
    options = {**PACKED.get(fmt, {}), **options}
    with shuffles_removed(df.sparkSession):
        df.write.format(fmt).options(**options).mode("overwrite").save(path)


# Fixed value: rows of a file of the export. A compressed file is read by one task.
EXPORTED_ROWS = 1_000_000


def export_json(df, path, compression="gzip"):
    """JSON-lines export. NULL fields are left out: read back with a schema.

    The text repeats the names of all fields in every line, so it is written compressed, to about
    a tenth; readers know the compression by the names of the files.
    """
    write_table(df, path, "json", compression=compression, maxRecordsPerFile=EXPORTED_ROWS)
