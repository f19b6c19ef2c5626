"""Shared folder for intermediate tables."""

import uuid

from layercake.sources.files import read_table, write_table


def _base(spark):
    """``spark.checkpoint.dir``, else a folder of the session's warehouse.

    On a cluster a warehouse in a local folder is refused: executors would each write to their own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.sparkContext.master
    alone = master == "local" or master.startswith("local[")
    if not alone and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "/_work"


def new_folder(spark, name):
    """Path of a fresh folder in the shared place of the session; see ``_base``."""
    return f"{_base(spark)}/{name}-{uuid.uuid4().hex}"


def stage(spark, df, name, path=None):
    """Write ``df`` once and return it as a scan, so later steps do not recompute it.

    ``path`` is a fixed place; what an earlier run left there is replaced.
    """
    path = path or new_folder(spark, name)
    write_table(df, path)
    return read_table(spark, path, schema=df.schema)
