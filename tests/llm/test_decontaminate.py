"""Decontamination against brute force over all windows."""

import hashlib
import random
import re

import pytest

from layercake.llm import decontaminate
from layercake.llm.queries import QUERIES
from tests.llm.conftest import lower, words


def tokens(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def brute(rows, items, window=13):
    wanted = {}
    for name, text in items:
        own = tokens(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            wanted.setdefault(tuple(own[i : i + size]), set()).add(str(name))
    out = []
    for i, text in rows:
        own, hit, names = tokens(text), set(), set()
        for size in {len(w) for w in wanted}:
            for at in range(len(own) - size + 1):
                if own_items := wanted.get(tuple(own[at : at + size])):
                    hit.update(range(at, at + size))
                    names |= own_items
        out.append((i, len(own), len(hit), sorted(names), len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def found(docs, bench, **options):
    out = decontaminate.verdicts(decontaminate.attach_matches(docs, bench, **options))
    rows = out.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted(((r[0], r[1], r[2], list(r[3]), r[4]) for r in rows), key=repr)


@pytest.fixture(scope="module")
def case(spark, odd_rows):
    items = [
        (1, words(40, 11)), (2, words(13, 12)), (3, words(12, 13)), (4, "Solo"), (5, "a b. C"), (6, None),
        (7, ""), (8, "!!"), (None, words(20, 14)), (9, "ab " * 40), (10, words(40, 11)), (10, words(20, 15)),
    ]
    pick = random.Random(3)
    rows = list(odd_rows)
    for i in range(120):
        text = words(pick.randrange(5, 90), 500 + i).split()
        for _ in range(pick.randrange(3)):
            own = (pick.choice(items)[1] or "x").split()
            low = pick.randrange(len(own) + 1)
            at = pick.randrange(len(text) + 1)
            text[at:at] = own[low : low + pick.randrange(1, 40)]
        rows.append((1000 + i, pick.choice([" ", "\n", ", "]).join(text)))
    rows += [(3000, "ab " * 100), (3001, words(12, 12)), (3002, words(300, 9) + " " + words(13, 12))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    return rows, [x for x in items if x[0] is not None], bench


def test_equals_brute_force(make_docs, case):
    rows, items, bench = case
    assert found(make_docs(rows), bench) == brute(rows, items)


def test_blocks_of_the_benchmark(make_docs, case):
    rows, items, bench = case
    rows = rows[5:80]
    assert found(make_docs(rows), bench, block_chars=60) == brute(rows, items)


def test_longest_match_and_place(spark, make_docs):
    item = words(50, 21, 10**6).split()
    text = words(10, 22, 10**6).split() + item[5:35] + ["x"]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    (row,) = decontaminate.matches(make_docs([(1, " ".join(text))]), bench).collect()
    (match,) = row["matches"]
    assert tuple(match) == ("7", 10, 5, 30)


def test_empty_tables(spark, make_docs, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r[2] for r in found(make_docs(odd_rows), none)} == {0}
    assert found(make_docs([]), none) == []


def test_other_columns_pass_through(make_docs, case):
    docs = make_docs(case[0][:20])
    out = decontaminate.attach_matches(docs, case[2])
    rest = [c for c in docs.columns if c not in ("matches", "n_words")]
    assert out.columns == [*rest, "n_words", "matches"]
    key = lambda f: sorted((tuple(r) for r in f.select(rest).collect()), key=repr)
    assert key(out) == key(docs)


def test_query_equals_brute_force(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    table = lambda name, i: [tuple(r) for r in spark.read.parquet(f"{sf}/{name}.parquet").select(i, "text").collect()]
    expected = [
        (i, n, hit, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bad)
        for i, n, hit, items, bad in brute(table("documents", "doc_id"), table("benchmark", "item_id"))
    ]
    assert sorted(tuple(r) for r in QUERIES["op8_decontamination"](spark, sf).collect()) == sorted(expected)


def test_repetitive_texts_are_matched_once_a_place():
    import time

    import pyarrow as pa

    begun = time.time()
    block = decontaminate.Block(decontaminate.pack(["r", "s"], ["la " * 5000, "la lu " * 40]))
    counts, matches = decontaminate._found(block, pa.array(["la " * 20_000, "la " * 4000 + "lu", "la lu " * 100]))
    assert counts.to_pylist() == [20_000, 4001, 200] and time.time() - begun < 60
    first, second, third = ([(m["item"], m["start"], m["length"]) for m in own] for own in matches.to_pylist())
    # The item lies at each of the places that have room for it, and at the last ones in part within those.
    assert first == [("r", i, 5000) for i in range(15_001)]
    assert second == [("r", 0, 4000)]
    assert third == [("s", i, 80) for i in range(0, 121, 2)]


def test_order_of_places():
    pick = random.Random(5)
    for most in (1, 70, 300):
        own = [pick.choice([1, 1, 1, 2]) for _ in range(400)] + [1] * 200
        raw = b"".join(x.to_bytes(4, "big") for x in own)
        places = pick.sample(range(600), 300)
        assert [own[p : p + most] for p in decontaminate.ordered(raw, places, most)] == sorted(own[p : p + most] for p in places)
        ended = decontaminate.ordered(raw, places, most, 4 * 590)
        assert [own[p : min(p + most, 590)] for p in ended] == sorted(own[p : min(p + most, 590)] for p in places)


def test_many_blocks_and_clashing_names(make_docs, case):
    rows, items, bench = case
    rows = rows[5:60]
    docs = make_docs(rows).withColumnRenamed("gone", "matches before")
    out = decontaminate.attach_matches(docs, bench, block_chars=25)
    assert out.columns[-2:] == ["n_words", "matches"] and "matches before" in out.columns
    assert found(docs, bench, block_chars=25) == brute(rows, items)
