"""A session with the settings the operators are designed around."""

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it splits the hot partitions of
# skewed joins, merges small shuffle partitions before a write, and turns a join
# into a broadcast when the side it measured fits the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app="layercake", master=None, **settings):
    """Return a session; on a cluster leave ``master`` and the sizes to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
