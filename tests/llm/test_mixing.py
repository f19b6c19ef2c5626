"""Mixing: raking against its definition, and drawn shares against the targets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from layercake.llm import mixing
from layercake.llm.queries import MIX, MIX_FRACTION, QUERIES
from tests.llm.conftest import words


def test_marginals_are_met():
    random = np.random.default_rng(1)
    tokens = random.integers(100, 10_000, (4, 3, 2)).astype(float)
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.6, 0.4])]
    budget = 0.05 * tokens.sum()
    drawn = mixing.rake(tokens, targets, budget)
    for axis, target in enumerate(targets):
        others = tuple(a for a in range(3) if a != axis)
        assert np.allclose(drawn.sum(axis=others) / budget, target, atol=1e-6)
    assert (drawn <= tokens).all()
    # Raking keeps the odds ratios of the cells.
    odds = lambda x: x[0, 0, 0] * x[1, 1, 0] / (x[0, 1, 0] * x[1, 0, 0])
    assert odds(drawn) == pytest.approx(odds(tokens), rel=1e-6)


def test_cells_are_not_drawn_beyond_what_they_have():
    tokens = np.array([[10.0, 1000.0], [1000.0, 1000.0]])
    drawn = mixing.rake(tokens, [[0.5, 0.5], [0.5, 0.5]], 2000)
    assert (drawn <= tokens + 1e-9).all() and drawn[0, 0] == pytest.approx(10)
    assert mixing.rake(tokens, [[1, 0], [1, 0]], 5000).sum() <= 10 + 1e-9
    assert mixing.rake(tokens * 0, [[0.5, 0.5]] * 2, 10).sum() == 0


def test_drawn_shares_follow_the_targets(spark):
    rows = [(i, words(20, i), "en" if i % 4 else "fr", "a" if i % 3 else "b") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": {"a": 0.3, "b": 0.7}, "lang": {"en": 0.5, "fr": 0.5}, "topic": {"short": 1.0}}
    out = mixing.mix(docs, targets, 0.2)
    assert out.count() == 6000
    drawn = out.where("sampled").toPandas()
    assert abs(len(drawn) / 6000 - 0.2) < 0.02
    assert abs((drawn.source == "b").mean() - 0.7) < 0.04 and abs((drawn.lang == "fr").mean() - 0.5) < 0.04
    again = mixing.mix(docs.repartition(7), targets, 0.2).where("sampled").toPandas()
    assert set(again.doc_id) == set(drawn.doc_id)


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, lang=None, source=None)
    out = mixing.mix(docs, MIX, 1.0)
    assert out.columns == [*(c for c in docs.columns if c != "cell"), "cell", "probability", "sampled"]
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    assert not any(r["sampled"] for r in rows if not (r["text"] or "").strip())
    assert all(r["cell"].startswith("(rest)/(rest)/") for r in rows)
    assert mixing.mix(make_docs([]), MIX, 0.5).count() == 0
    with pytest.raises(ValueError, match="axes"):
        mixing.mix(docs, {"source": {}}, 0.5)


def test_null_and_unlisted_values_are_drawn_at_their_share(spark):
    """Targets that sum to 1 leave a new hot source and rows without a language in."""
    source, lang = lambda i: "new" if i % 3 == 0 else f"src{i % 20}", lambda i: None if i % 4 == 0 else "en"
    rows = [(i, words(20, i), lang(i), source(i)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    drawn = mixing.mix(docs, MIX, 0.2).where("sampled").toPandas()
    assert abs(len(drawn) / 6000 - 0.2) < 0.02
    assert abs((drawn.source == "new").mean() - 1 / 3) < 0.04 and abs(drawn.lang.isna().mean() - 1 / 4) < 0.04
    # Nothing but unlisted values, and the way to leave them out.
    other = docs.withColumn("source", F.lit(None).cast("string"))
    assert abs(mixing.mix(other, MIX, 0.2).where("sampled").count() / 6000 - 0.2) < 0.02
    without = {**MIX, "source": {**MIX["source"], mixing.REST: 0.0}}
    assert mixing.mix(docs, without, 0.2).where("sampled and source = 'new'").isEmpty()


def test_query_equals_raking_by_hand(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op5_source_mixing"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    own = docs.withColumn("topic", mixing.topic_of(F.col("text"))).toPandas()
    own["w"] = [len([x for x in (t or "").replace("\x0b", " ").split() if x]) for t in own.text]
    names = {axis: [*MIX[axis], mixing.REST] for axis in MIX}
    tokens = np.zeros([len(n) for n in names.values()])
    place = [tuple(names[a].index(v if v in MIX[a] else mixing.REST) for a, v in zip(names, r)) for r in own[list(names)].itertuples(index=False)]
    np.add.at(tokens, tuple(np.array(place).T), own.w)
    # Plain iterative proportional fitting, one cell at a time.
    budget = MIX_FRACTION * tokens.sum()
    x = tokens * MIX_FRACTION
    for _ in range(mixing.ROUNDS):
        for axis, name in enumerate(names):
            shares = [MIX[name].get(v, max(0.0, 1 - sum(MIX[name].values()))) for v in names[name]]
            there = [s if tokens.take(i, axis).sum() > 0 else 0 for i, s in enumerate(shares)]
            for i, s in enumerate(there):
                part = [slice(None)] * 3
                part[axis] = i
                now = x[tuple(part)].sum()
                if now > 0:
                    x[tuple(part)] = np.minimum(x[tuple(part)] * (s / sum(there) * budget / now), tokens[tuple(part)])
    expected = {i: x[p] / tokens[p] if tokens[p] else 0 for i, p in zip(own.doc_id, place)}
    for r in found.itertuples():
        assert r.probability == pytest.approx(expected[r.doc_id], abs=1e-6)
