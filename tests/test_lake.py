"""Versioned tables, reports, guarded reads and the shared folder."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from layercake.sources import files
from layercake.sources import (
    Lake,
    export_json,
    new_folder,
    preview,
    preview_tables,
    read_if_exists,
    read_json,
    stage,
    storage_report,
    together,
    write_table,
)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


def test_replace_from_own_content_without_a_shuffle(spark, lake):
    lake.publish({"silver/t": spark.range(5)}, unique_on={"silver/t": ["id"]})
    assert lake.entries()["silver/t"].unique_on == ("id",)
    before = lake.read("silver/t")
    lake.publish({"silver/t": before.select((F.col("id") + 10).alias("id"))})
    assert ids(lake.read("silver/t")) == [10, 11, 12, 13, 14]
    assert lake.entries()["silver/t"].unique_on == ()
    # The earlier version is still there for whoever reads it.
    assert ids(before) == [0, 1, 2, 3, 4]


def test_failed_write_leaves_every_table_as_it_was(spark, lake):
    lake.publish({"silver/a": spark.range(3), "silver/b": spark.range(2)})
    broken = lake.read("silver/b").select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        lake.publish({"silver/a": spark.range(9), "silver/b": broken})
    assert ids(lake.read("silver/a")) == [0, 1, 2] and ids(lake.read("silver/b")) == [0, 1]
    lake.publish({"silver/a": spark.range(1)})
    assert ids(lake.read("silver/a")) == [0] and ids(lake.read("silver/b")) == [0, 1]


def test_format_is_recorded_per_table(spark, lake):
    rows = [(1, None), (2, "b")]
    lake.publish({"silver/j": spark.createDataFrame(rows, "id long, s string")}, "json")
    lake.publish({"silver/p": spark.range(1)}, "parquet")
    assert lake.entries()["silver/j"].format == "json"
    table = lake.read("silver/j")
    assert sorted(tuple(r) for r in table.collect()) == rows and table.columns == ["id", "s"]


def test_json_schema_declared_and_inferred(spark, tmp_path):
    path = str(tmp_path / "j")
    frame = spark.createDataFrame([(1, None, "extra")], "pid long, name string, other string")
    export_json(frame, path)
    assert "name" not in read_json(spark, path).columns
    assert read_json(spark, path, frame.schema).collect() == frame.collect()


def test_missing_table_is_reported_but_other_errors_are_raised(spark, lake, tmp_path, capsys):
    assert read_if_exists(spark, str(tmp_path / "none")) is None
    assert lake.read("silver/none") is None
    with pytest.raises(Exception, match="no-such-format"):
        read_if_exists(spark, str(tmp_path), fmt="no-such-format")
    with pytest.raises(AnalysisException, match="UNABLE_TO_INFER_SCHEMA"):
        read_if_exists(spark, str(tmp_path))
    lake.publish({"silver/t": spark.range(2)})
    preview_tables(lake, ["silver/none", "silver/t"])
    out = capsys.readouterr().out
    assert "silver/none: no such table" in out and "|id |" in out


def test_preview_is_a_top_n(spark):
    frame = spark.range(100).select((F.lit(100) - F.col("id")).alias("id"))
    top = preview(frame, ["id"], 3)
    assert [r["id"] for r in top.collect()] == [1, 2, 3]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_storage_report(spark, lake):
    def sizes(**options):
        return {r["layer"]: r["size_mib"] for r in storage_report(lake, **options).collect()}

    assert sizes() == {"bronze": 0.0, "silver": 0.0, "gold": 0.0, "total": 0.0}
    noise = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 512).alias("x"))
    lake.publish({"silver/t": noise, "gold/t": noise})
    first = sizes()
    assert first["silver"] > 0.5 and first["bronze"] == 0.0
    assert first["total"] == pytest.approx(first["silver"] + first["gold"], abs=0.011)
    lake.publish({"silver/t": noise})
    assert sizes() == first
    assert sizes(all_versions=True)["silver"] == pytest.approx(2 * first["silver"], abs=0.011)


class _Session:
    """A session with the given settings, as far as the workspace looks at it."""

    def __init__(self, master="yarn", **conf):
        self.conf = conf
        self.master = master
        self.sparkContext = self

    def getCheckpointDir(self):
        return None


def test_folders_follow_the_session():
    warehouse = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
    shared = _Session(**warehouse, **{"spark.checkpoint.dir": "hdfs:///tmp/"})
    assert new_folder(shared, "x").startswith("hdfs:///tmp/x-")
    assert new_folder(_Session(**warehouse), "x").startswith("hdfs:///warehouse/_work/x-")
    for local in ("/tmp/warehouse", "file:///tmp/warehouse"):
        own = {"spark.sql.warehouse.dir": local}
        assert new_folder(_Session("local[4]", **own), "x").startswith(local)
        for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                new_folder(_Session(master, **own), "x")


def test_a_fixed_place_is_reused(spark, tmp_path):
    path = str(tmp_path / "fixed")
    assert stage(spark, spark.range(5), "x", path).count() == 5
    assert stage(spark, spark.range(3), "x", path).count() == 3


def test_write_table_replaces(spark, tmp_path):
    for n in (3, 1):
        write_table(spark.range(n), str(tmp_path / "t"))
    assert ids(spark.read.parquet(str(tmp_path / "t"))) == [0]


def test_json_export_is_compressed_and_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "EXPORTED_ROWS", 400)
    frame = spark.range(0, 1000, 1, 1).selectExpr("id", "'track:' || id AS track_uri", "nullif(id, 7) AS pos")
    export_json(frame, str(tmp_path / "j"))
    parts = list((tmp_path / "j").glob("part-*"))
    assert len(parts) == 3 and all(p.name.endswith(".json.gz") for p in parts)
    back = read_json(spark, str(tmp_path / "j"), frame.schema)
    assert sorted(back.collect()) == sorted(frame.collect())


def test_writes_remove_their_shuffles_and_put_the_setting_back(spark, tmp_path):
    def write(n):
        grouped = spark.range(1000).selectExpr(f"id % {n} AS k").groupBy("k").count()
        write_table(grouped, str(tmp_path / f"t{n}"))
        return spark.read.parquet(str(tmp_path / f"t{n}")).count()

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with files.shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
        assert together(spark, [lambda n=n: write(n) for n in (3, 5, 7)]) == [3, 5, 7]
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_tables_are_written_packed(spark, lake, tmp_path):
    table = spark.range(100).repartition(2)
    lake.publish({"silver/numbers": table})
    write_table(table, str(tmp_path / "table"))
    write_table(table, str(tmp_path / "plain"), compression="none")
    for frame in (lake.read("silver/numbers"), spark.read.parquet(str(tmp_path / "table")), stage(spark, table, "numbers")):
        assert all(f.endswith(".zstd.parquet") for f in frame.inputFiles())
        assert ids(frame) == list(range(100))
    assert not any("zstd" in f for f in spark.read.parquet(str(tmp_path / "plain")).inputFiles())
