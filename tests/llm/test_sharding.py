from collections import Counter, defaultdict
from zlib import crc32

import pytest

from layercake.llm import sharding
from tests.llm.conftest import words


def checked(rows, texts, shards, tolerance):
    """What holds for any sharding by bytes; ``rows`` are (doc_id, size, crc, shard, slot)."""
    assert Counter((i, s, c) for i, s, c, _, _ in rows) == Counter(
        (i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in texts
    )
    held, order = defaultdict(int), defaultdict(list)
    for i, size, crc, shard, slot in rows:
        held[shard] += size
        order[shard].append(slot)
    assert set(held) <= set(range(shards))
    assert all(sorted(slots) == list(range(len(slots))) for slots in order.values())
    total, largest = sum(held.values()), max(s for _, s, _, _, _ in rows)
    before = 0
    for k in range(1, shards):
        before += held[k - 1]
        assert abs(before - k * total / shards) <= max(tolerance * total / shards, largest)
    # Equal texts lie side by side.
    seen, last = set(), None
    for _, size, crc, _, _ in sorted(rows, key=lambda r: (r[3], r[4])):
        if (size, crc) != last:
            assert (size, crc) not in seen
            last = (size, crc)
            seen.add(last)


def found(docs, shards, **how):
    out = sharding.shard(sharding.measured(docs), group_col="group", shards=shards, **how)
    return [tuple(r) for r in out.select("doc_id", "size", "text_crc32", "shard", "slot").collect()]


def test_hot_group_is_cut(make_docs):
    """A third of the rows are copies; they fill shards like all others."""
    texts = [(i, "copy of a text" if i % 3 == 0 else words(3 + i % 40, i)) for i in range(6000)]
    rows = found(make_docs(texts), 16)
    checked(rows, texts, 16, sharding.TOLERANCE)
    assert len({r[3] for r in rows if r[2] == crc32(b"copy of a text")}) > 1
    assert rows and sorted(rows) == sorted(found(make_docs(texts[::-1]).repartition(5), 16))


def test_small_cells(make_docs, monkeypatch):
    """Cells are split until they are small; the place in the shard goes on over them."""
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    texts = [(i % 1500, "copy" if i % 2 else words(4, i)) for i in range(3000)]
    checked(found(make_docs(texts), 7, blocks=60), texts, 7, sharding.TOLERANCE)


def test_odd_rows(make_docs, odd_rows):
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 1000]
    checked(found(make_docs(rows), 3), rows, 3, sharding.TOLERANCE)
    assert len(found(make_docs(odd_rows), 16)) == len(odd_rows)
    assert found(make_docs([]), 16) == []
    same = [(1, "same")] * 300
    checked(found(make_docs(same), 4), same, 4, sharding.TOLERANCE)


@pytest.mark.parametrize("shards", [1, 40])
def test_number_of_shards(make_docs, shards):
    texts = [(i, words(5 + i % 9, i)) for i in range(400)]
    checked(found(make_docs(texts), shards), texts, shards, sharding.TOLERANCE)


def test_columns_and_files(spark, make_docs, tmp_path):
    docs = make_docs([(i, words(8, i)) for i in range(200)])
    for name in ("size", "k0", "low0", "at0", "before", "n", "part", "a.b"):
        docs = docs.selectExpr("*", f"doc_id AS `{name}`")
    out = sharding.shard(docs.selectExpr("*", "5 AS shard"), size_col="n_chars", shards=4)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert all(r["low0"] == r["doc_id"] == r["a.b"] for r in out.collect())
    sharding.write(out, str(tmp_path / "shards"))
    again = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r["doc_id"] for r in again.collect()) == list(range(200))
    assert {r["shard"] for r in again.collect()} == {0, 1, 2, 3}
