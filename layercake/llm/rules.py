"""Quality rules as weak supervision.

Every rule votes for or against a text or abstains. Expectation-maximisation over
the votes of all texts estimates how often each rule is right about good and about
bad texts, and a text is judged by the posterior probability that it is good.
The texts are measured in one narrow pass; what leaves it for the estimate is the
number of texts per pattern of votes, of which there are at most ``3 ** rules``.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.llm import words
from layercake.llm.common import staged

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?"]] = True
WINDOW = 8

# Where the estimate starts: on bad and on good texts, how often a rule votes bad, abstains and
# votes good. The first is for rules that only look for a fault.
FAULT_START = np.array([[0.3, 0.69, 0.01], [0.005, 0.985, 0.01]])
VOTE_START = np.array([[0.4, 0.35, 0.25], [0.05, 0.25, 0.7]])

STATS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_distinct", "n_same_next", "n_upper", "n_letters", "n_ends", "n_symbol_words",
]


def _repeat_words(hashes):
    """Number of words inside windows that occur twice or more."""
    keys = words.windows(hashes, WINDOW)
    if len(keys) < 2:
        return 0
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    if not len(again):
        return 0
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _dup_lines(text):
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measure(column):
    """The counts named in ``STATS`` for every text of an Arrow column."""
    out = {name: np.zeros(len(column), np.int64) for name in STATS}
    for at, end, data, offsets in words.slices(column):
        starts, ends, first = words.spans(data, offsets, ~words.SPACES)
        hashes = words.span_hashes(data, starts, ends)

        def per_row(flags):
            total = np.concatenate([[0], np.cumsum(flags)])
            return total[offsets[1:]] - total[offsets[:-1]]

        rows = slice(at, end)
        out["n_words"][rows] = np.diff(first)
        out["word_chars"][rows] = per_row(~words.SPACES[data] & ((data & 0xC0) != 0x80))
        for name, kind in (("n_symbols", SYMBOLS), ("n_upper", UPPER), ("n_ends", ENDS)):
            out[name][rows] = per_row(kind[data])
        out["n_letters"][rows] = per_row(LETTERS[data] & ((data & 0xC0) != 0x80))
        marked = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
        marked = np.concatenate([[0], np.cumsum(marked[ends] > marked[starts])])
        out["n_symbol_words"][rows] = np.diff(marked[first])
        for i in range(end - at):
            own = hashes[first[i] : first[i + 1]]
            out["n_repeat_words"][at + i] = _repeat_words(own)
            out["n_distinct"][at + i] = len(np.unique(own))
            out["n_same_next"][at + i] = int((own[1:] == own[:-1]).sum())
    values = words.texts_of(column)
    many = np.flatnonzero(pc.match_substring(values, "\n").to_numpy(zero_copy_only=False))
    for i in many:
        out["n_dup_lines"][i] = _dup_lines(values[i].as_py())
    return out


def _measured(batches):
    for batch in batches:
        found = measure(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(found[s]) for s in STATS)], ["id", *STATS]
        )


def base_failed():
    """The rule that no vote can overrule: too few words, or too many repeated ones."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def votes():
    """The rules: name and an expression of 1 (good), -1 (bad) or 0 (abstains).

    A rule that looks for one fault abstains where it finds none: the lack of one fault
    says little about the others. Each abstains too where its count says little, as on very
    short texts. None has a null result: empty texts have counts of zero.
    """
    n = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("n_letters"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    enough = F.col("n_words") >= 20

    def vote(good, bad, says=F.lit(True)):
        return F.when(~says, 0).when(good, 1).when(bad, -1).otherwise(0)

    never = F.lit(False)
    mean = F.col("word_chars") / n
    return {
        "word_length": vote(never, (mean < 2) | (mean > 15), F.col("n_words") > 0),
        "symbols": vote(never, F.col("n_symbols") / n > 0.1, F.col("n_words") >= 5),
        "marked_words": vote(never, F.col("n_symbol_words") / n > 0.1, F.col("n_words") >= 5),
        "capitals": vote(never, F.col("n_upper") / letters > 0.35, enough),
        "same_word": vote(never, F.col("n_same_next") / n > 0.1, enough),
        "variety": vote(never, F.col("n_distinct") / F.sqrt(n) < 1.5, enough),
        "letters": vote(never, F.col("n_letters") / chars < 0.85, F.col("n_words") > 0),
        "repeats": vote(never, F.col("n_repeat_words") / n > 0.3, F.col("n_words") >= 16),
        "sentences": vote(
            (F.col("n_ends") / n > 0.02) & (F.col("n_ends") / n < 0.35),
            (F.col("n_ends") == 0) | (F.col("n_ends") / n > 0.6),
            enough,
        ),
    }


def estimate(patterns, counts, rounds=200, prior=0.8):
    """Expectation-maximisation for independent rules that may abstain.

    ``patterns`` has a row of votes per pattern, ``counts`` the texts that show it.
    Returns the posterior of each pattern, the share of good texts, and for each
    rule the estimated rates of voting (bad, none, good) on bad and on good texts.
    Rules start as mostly right, and good texts as hardly ever at fault, so "good" keeps
    its meaning. A small pseudo-count
    keeps rates off 0 and 1. Without patterns there is nothing to estimate.
    """
    patterns, counts = np.asarray(patterns, np.int64), np.asarray(counts, float)
    rules = patterns.shape[1]
    faults = ~(patterns == 1).any(axis=0) if len(counts) else np.zeros(rules, bool)
    rates = np.where(faults[None, :, None], FAULT_START[:, None, :], VOTE_START[:, None, :])
    share, post = prior, np.zeros(len(counts))
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds if len(counts) else 0):
        log = np.tensordot(onehot, np.log(rates), axes=([1, 2], [1, 2]))
        odds = log[:, 1] - log[:, 0] + np.log(share) - np.log1p(-share)
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        weight = np.stack([counts * (1 - new), counts * new])
        rates = np.einsum("cp,prv->crv", weight, onehot) + 0.5
        rates /= rates.sum(axis=2, keepdims=True)
        share = float(np.clip(weight[1].sum() / max(counts.sum(), 1), 0.01, 0.99))
        done, post = np.abs(new - post).max() < 1e-9, new
        if done:
            break
    return post, share, rates


def judge(docs, id_col="doc_id", text_col="text", threshold=0.5):
    """Counts, votes, posterior and verdict for every row of ``docs``.

    Returns ``id_col``, the counts of ``STATS``, ``vote_<rule>``, ``quality``
    (posterior that the text is good), ``base_failed`` and ``kept``. Null and empty
    texts have counts of zero and fail the base rule. Repeated rows are judged
    alike and all returned; a null id is kept as it is. Other columns of ``docs``
    are not looked at and not returned. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(s, T.LongType()) for s in STATS)])
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_measured, schema)
    found = staged(found, "rule-counts")  # read twice below, made from the texts once
    rules = votes()
    voted = found.withColumns({f"vote_{r}": e.cast("int") for r, e in rules.items()})
    voted = voted.withColumn("base_failed", base_failed())
    names = [f"vote_{r}" for r in rules]
    # At most 3 ** len(rules) rows. Texts that fail the base rule are out whatever the votes
    # say, and would only teach the rules to find those texts again.
    weight = F.count_if(~F.col("base_failed")).alias("weight")
    seen = voted.groupBy(*names).agg(weight).toPandas()
    post, _, _ = estimate(seen[names].to_numpy(), seen["weight"].to_numpy())
    # A pattern is a number in base 3, its posterior an entry of one array literal.
    codes = ((seen[names].to_numpy(dtype=np.int64) + 1) * 3 ** np.arange(len(names))).sum(axis=1)
    by_code = pd.DataFrame({"code": codes.astype(np.int64), "quality": post})
    known = spark.createDataFrame(by_code, "code long, quality double")
    code = sum(((F.col(c) + 1).cast("long") * 3**i for i, c in enumerate(names)), F.lit(0).cast("long"))
    judged = voted.withColumn("code", code).join(F.broadcast(known), "code", "left")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).select(
        F.col("id").alias(id_col), *STATS, *names, "quality", "base_failed", "kept"
    )
