"""Line deduplication: SQL, brute force, and taking insertions back."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from layercake.llm import lines
from tests.llm.conftest import lower, words

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows):
    holders = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            key = lower(x.strip(BLANKS))
            if i is not None and t is not None and len(key) >= 10:
                holders[key].add(i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if i is None or len(h := holders[lower(x.strip(BLANKS))]) < 2 or min(h) == i]
        out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def found(index, docs):
    rows = lines.apply(index, docs).select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted(((r[0], r[1] or "", r[2], r[3]) for r in rows), key=repr)


def some_rows(odd_rows):
    shared = [words(4, i) for i in range(6)]
    rows = [
        (50 - i, "\n".join([f"  {shared[i % 6].upper()}\t", words(5, i), shared[(i + 1) % 6], shared[(i + 1) % 6], "short"]))
        for i in range(30)
    ]
    return rows + odd_rows + [(90, "exactly 10"), (91, "Exactly 10"), (92, "only nine"), (93, "only nine")]


def test_equals_brute_force(make_docs, odd_rows):
    rows = some_rows(odd_rows)
    docs = make_docs(rows)
    out = lines.apply(lines.insert(None, docs), docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert found(lines.insert(None, docs), docs) == brute(rows)


def contents(index):
    counts = sorted((bytes(r["key"]), r["refs"], r["owner"]) for r in index.counts.collect())
    refs = sorted((bytes(r["key"]), r["doc"]) for r in index.refs.collect())
    held = {r["shard"]: (lines.CuckooFilter.of(r["filter"]), r["n"]) for r in index.filters.collect()}
    for r in index.counts.collect():
        assert held[r["shard"]][0].contains(lines.hash_of([r["key"]])).all()
    assert sum(n for _, n in held.values()) == len(counts)
    assert sum(int((f.table != 0).sum()) for f, _ in held.values()) == len(counts)
    return counts, refs


def test_batches_and_deletion_leave_what_one_insertion_gives(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(lines, "LEAST_SHARDS", 3)
    rows = [r for r in some_rows(odd_rows) if r[0] != 5]
    first, second = [r for r in rows if (r[0] or 0) % 2], [r for r in rows if not (r[0] or 0) % 2]
    whole = lines.insert(None, make_docs(rows))
    half = lines.insert(None, make_docs(first))
    both = lines.insert(half, make_docs(second))
    assert contents(both) == contents(whole)
    docs = make_docs(rows)
    assert found(both, docs) == brute(rows)
    # Documents of the index that come again change nothing.
    assert contents(lines.insert(both, make_docs(second))) == contents(whole)
    # Taking the second half out again gives the first; ids that are not there do nothing.
    back = lines.delete(both, make_docs([*second, (12345, "x"), (None, None)]))
    assert contents(back) == contents(half)
    assert found(back, make_docs(first)) == brute(first)
    # And in again.
    assert contents(lines.insert(back, make_docs(second))) == contents(whole)


def test_full_filters_are_made_anew(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "LEAST_SHARDS", 1)
    small = [(1, "\n".join(f"line number {i}" for i in range(10)))]
    more = [(2, "\n".join(f"line number {i}" for i in range(5, 4000)))]
    index = lines.insert(lines.insert(None, make_docs(small)), make_docs(more))
    assert contents(index) == contents(lines.insert(None, make_docs(small + more)))


def test_a_crowded_filter_is_made_anew_within_an_insertion(make_docs, monkeypatch):
    """Keys that a filter takes for known and cannot enter: the shard is made anew from the exact table."""
    monkeypatch.setattr(lines, "LEAST_SHARDS", 1)
    index = lines.insert(None, make_docs([(1, "\n".join(f"line number {i}" for i in range(10)))]))
    crowded = lines.CuckooFilter(2)
    spark = index.counts.sparkSession
    keys = [bytes(r["key"]) for r in index.counts.collect()]
    crowded.table[:] = 1 + np.arange(crowded.table.size).reshape(crowded.table.shape)
    filters = spark.createDataFrame([(0, crowded.blob(), 10)], lines._filter_schema())
    own = spark.createDataFrame([(0, k) for k in keys], "shard int, key binary")
    (row,) = lines._change(filters, own, "insert").collect()
    assert row["filter"] is None and row["n"] == 20
    index.filters = spark.createDataFrame([(0, None, 10)], lines._filter_schema())
    contents(lines._repaired(index))


def test_shards_grow(make_docs, monkeypatch):
    monkeypatch.setattr(lines, "LEAST_SHARDS", 1)
    monkeypatch.setattr(lines, "SHARD_KEYS", 100)
    small = [(1, "\n".join(f"line number {i}" for i in range(10)))]
    more = [(2, "\n".join(f"line number {i}" for i in range(5, 1000)))]
    index = lines.insert(lines.insert(None, make_docs(small)), make_docs(more))
    assert index.shards == 8 and index.counts.select("shard").distinct().count() == 8
    assert contents(index)[0] == contents(lines.insert(None, make_docs(small + more)))[0]


def test_load_in_batches(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(lines, "RETURNED", 3)
    docs = make_docs(some_rows(odd_rows))
    for batches in (1, 3):
        index = lines.load(docs, batches)
        assert contents(index)[0] == contents(lines.insert(None, docs))[0]
        assert found(index, docs) == brute(some_rows(odd_rows))


def test_names_with_dots(make_docs):
    docs = make_docs([(1, "a line of text\nb"), (2, "a line of text")]).withColumnRenamed("gone", "go.ne")
    out = lines.apply(lines.insert(None, docs), docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"] and out.count() == 2


def test_empty_table(make_docs):
    docs = make_docs([])
    assert found(lines.insert(None, docs), docs) == []


@pytest.mark.parametrize("keys", [1, 700, 5000])
def test_cuckoo_filter(keys):
    pick = np.random.default_rng(keys)
    hashes = pick.integers(0, 1 << 63, keys, dtype=np.uint64) * 2 + 1
    made = lines.CuckooFilter.sized(keys)
    assert made.insert(hashes)
    assert made.contains(hashes).all()
    again = lines.CuckooFilter.of(made.blob())
    others = pick.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert again.contains(others).mean() < 0.01
    half = len(hashes) // 2
    again.delete(hashes[:half])
    assert again.contains(hashes[half:]).all()
    assert int((again.table != 0).sum()) == keys - half
    again.delete(hashes[half:])
    assert not again.table.any()


def test_crowded_filter_says_so():
    made = lines.CuckooFilter(2)
    hashes = np.arange(1, 40, dtype=np.uint64) << np.uint64(50)
    assert not made.insert(hashes)


def test_counter_is_exact(make_docs):
    rows = [(i, "the same line here") for i in range(200)]
    (row,) = lines.insert(None, make_docs(rows)).counts.collect()
    assert (row["refs"], row["owner"]) == (200, 0)
    assert Counter(r[3] for r in found(lines.insert(None, make_docs(rows)), make_docs(rows))) == {1: 199, 0: 1}


def test_keys_are_computed_once_and_lower_only_a_to_z(spark):
    texts = ["  ABCDEFGHIJ\t\n\u00c0BCDEFGHIJK\nshort", "\u0130STANBUL IS A TOWN\nabcdefghij", "K\u212a" * 6, None, "\u00a0ABCDEFGHI"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = lines.edges(docs)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    wanted = {(n, lines._key(x)) for n, text in enumerate(texts) for x in (text or "").split("\n") if lines._key(x)}
    assert len(wanted) == 6
    assert {(r["doc"], bytes(r["key"])) for r in frame.collect()} == wanted


def test_few_texts_are_python_objects_at_a_time():
    many = 3 * lines.FILTERED_ROWS + 1
    batch = pa.RecordBatch.from_pydict(
        {"id": list(range(many)), "text": ["a line of text\nb"] * many, "gone": [[lines._key("a line of text")], None] * (many // 2) + [None]}
    )
    out = list(lines._filtering([batch]))
    assert [b.num_rows for b in out] == [lines.FILTERED_ROWS] * 3 + [1]
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["id"] for r in rows] == list(range(many))
    assert rows[0] == {"id": 0, "text": "b", "lines": 2, "dropped": 1} and rows[1]["dropped"] == 0
