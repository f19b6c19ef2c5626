"""Registered queries against their SQL, and the pipeline stage by stage."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from layercake.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ROOT = os.path.dirname(os.path.abspath(entry_module.__file__))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = sorted(result.fetchall(), key=repr)
    assert expected and sorted((tuple(r) for r in frame.select(columns).collect()), key=repr) == expected


def test_url_sql_has_the_level_of_suffixes(spark, tmp_path):
    """Pages of domains without outcomes, under a bad suffix and a good one, in both."""
    pages, labels = [], []
    for host, bad in [(f"w.evil{i}.bad", 1) for i in range(30)] + [(f"w.fine{i}.com", 0) for i in range(30)]:
        for _ in range(6):
            labels.append((len(pages), 1 - bad, 0))
            pages.append((len(pages), f"http://{host}/{len(pages)}"))
    for host in ("w.new.bad", "new.com", "x.other", "sub.w.evil1.bad"):
        pages.append((len(pages), f"https://{host}/"))
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    connection = duckdb.connect()
    for table in ("pages", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    frame = QUERIES["op6_url_filter"](spark, str(tmp_path))
    result = connection.execute(ORACLES["op6_url_filter"])
    columns = [d[0] for d in result.description]
    rows = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r) for r in frame.select(columns).collect()), key=repr) == rows
    assert {r["host"]: r["verdict"] for r in frame.collect()}["w.new.bad"] == "block"


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    """Each stage against what its operator says about the stage's own input."""
    from tests.llm.test_decontaminate import brute as contaminated
    from tests.llm.test_jaccard import brute as grouped
    from tests.llm.test_lines import brute as deduplicated

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, docs, sf).schema)
        after = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        kept[name] = after
        assert docs.columns[:5] == corpus_pipeline.COLUMNS
        if name == "line_dedup":
            assert after == sorted((i, t) for i, t, _, _ in deduplicated(before))
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        elif name == "jaccard_join":
            first = {i for i, _, component in grouped(before) if i == component}
            assert after == sorted((i, t) for i, t in before if i in first)
        elif name == "decontamination":
            clean = {i for i, _, _, _, bad in contaminated(before, bench) if not bad}
            assert after == sorted((i, t) for i, t in before if i in clean)
        else:
            assert set(after) <= set(before)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    through = {i for i, _ in kept["quality_classifier"]}
    assert sum(i in through for i in good) / len(good) > 0.97


def test_rest_works_without_the_subpackage(tmp_path):
    """The entry point with the two optional parts missing has the other queries."""
    code = (
        "import sys; sys.path.insert(0, sys.argv[1]); sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') for n in q), q"
    )
    subprocess.run([sys.executable, "-c", code, ROOT], check=True, cwd=tmp_path, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "layercake")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    assert "llm" not in open(os.path.join(folder, name)).read()
