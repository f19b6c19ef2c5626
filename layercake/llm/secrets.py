"""Secret scan: patterns, and a battery of randomness tests for what no pattern names.

Long tokens get the smallest alphabet that has their characters; so do the parts of a token
with separators in it, of which the longest that passes counts. Three tests ask whether a token
could be random text of that encoding: chi-squared for an even use of the alphabet, runs of
its lower and upper half, and correlation of neighbours. Their p-values are combined, and
among tokens of like length the Benjamini-Hochberg procedure finds those that are not random.

What is left could be random, but short plain words could be, too. So tokens are also tested
against ordinary text: pairs of neighbouring characters are counted in the different short words of the
whole table, and a token is compared with those words by how unlikely its pairs are. The p-value is
the share of words that are as unlikely, and the same procedure, again by length, picks the tokens that
are reported: its bound is on the share of ordinary words among them. DataFrame operations
only; texts are never moved.
"""

import math

from pyspark.sql import functions as F

from layercake.llm.common import staged

# The patterns, their kinds in order, and the least length of a match.
# The length of the first is that of its second group.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# AKIA[A-Z0-9]+ and [0-9a-f]+ with their least lengths in the pattern. That finds the same: a
# match that is too short reaches to the end of its run, where nothing longer can begin.
ACCESS_LONG, HEX_LONG = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
# Parts of a token that may be a key in a path: between / and +, between - and _, between all four.
PARTS = (r"[A-Za-z0-9_-]{16,}", r"[A-Za-z0-9+/]{16,}", r"[A-Za-z0-9]{16,}")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets, smallest first, and what tells them; the first that has all characters counts. A key may
# lack characters of its encoding by chance: the number is the letters of the smallest encoding
# around the alphabet, by which the bits of a token are counted.
ENCODINGS = (
    ("digits", DIGITS, 16, r"^[0-9]+$"),
    ("hex", DIGITS + "abcdef", 16, r"^[0-9a-f]+$"),
    ("HEX", DIGITS + "ABCDEF", 16, r"^[0-9A-F]+$"),
    ("lower", LOWER, 36, r"^[a-z]+$"),
    ("UPPER", UPPER, 32, r"^[A-Z]+$"),
    ("base32", UPPER + "234567", 32, r"^[A-Z2-7]+$"),
    ("base36", DIGITS + LOWER, 36, r"^[0-9a-z]+$"),
    ("BASE36", DIGITS + UPPER, 36, r"^[0-9A-Z]+$"),
    ("letters", UPPER + LOWER, 64, r"^[A-Za-z]+$"),
    ("base64", UPPER + LOWER + DIGITS + "+/", 64, r"^[A-Za-z0-9+/]+$"),
    ("base64url", UPPER + LOWER + DIGITS + "-_", 64, r"^[A-Za-z0-9_-]+$"),
    ("mixed", UPPER + LOWER + DIGITS + "+/-_", 66, r"^[A-Za-z0-9+/_-]+$"),
)
LETTERS = UPPER + LOWER + DIGITS + "+/-_"
# Words that ordinary text is learned from, and the least length of those that tokens are compared with.
WORD = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{2,15}(?![A-Za-z0-9+/_-])"
WORD_CHARS = 8
Z_STEP = 0.25
Z_STEPS = 400
LEAST_BITS = 80
FALSE_SHARE = 0.05  # of random tokens among those that are left out as not random
WORD_SHARE = 0.01  # of ordinary words among what is reported
STEPS = 20  # p-values are counted in steps of 1/20 of a power of ten


def _found(text, pattern, groups=None):
    """Matches of a pattern: array of (start, end, size), in code points, end exclusive.

    ``size`` is the length of group ``groups``, or of the match.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.split(text, pattern, -1)
    sizes = F.transform(hits, lambda h: F.char_length(h))
    inner = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(groups)), lambda h: F.char_length(h)) if groups else sizes
    gaps = F.transform(parts, lambda p: F.char_length(p))
    steps = F.arrays_zip(gaps.alias("gap"), sizes.alias("len"), inner.alias("size"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int,size:int>>)").alias("out"))

    def add(state, step):
        begin = state["at"] + step["gap"]
        end = begin + step["len"]
        one = F.struct(begin.alias("start"), end.alias("end"), step["size"].alias("size"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    real = F.filter(steps, lambda s: s["len"].isNotNull())
    spans = F.aggregate(real, start, add, lambda s: s["out"])
    return F.when(text.rlike(pattern), spans).otherwise(start["out"])


def _spans(text, kind, pattern, groups=None):
    long = F.filter(_found(text, pattern, groups), lambda s: s["size"] >= LEAST[kind])
    rank = KINDS.index(kind)
    return F.transform(long, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _two_sided(z):
    """P(|Z| > z), by the rational approximation of Abramowitz and Stegun (26.2.17)."""

    def tail(t):
        poly = F.lit(0.0)
        for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
            poly = (poly + c) * t
        return F.exp(-z * z / 2) * math.sqrt(2 / math.pi) * poly

    return F.greatest(F.least(_let(1 / (1 + 0.2316419 * z), tail), F.lit(1.0)), F.lit(1e-30))


def _let(value, body):
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _z_uniform(codes, n, k):
    """Wilson and Hilferty's normal deviate of chi-squared for an even use of ``k`` letters."""
    counts = F.transform(F.array_distinct(codes), lambda c: F.size(F.filter(codes, lambda x: x == c)))
    squares = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c.cast("double") * c)
    free = k - 1.0
    return (F.pow((squares * k / n - n) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))


def _z_runs(codes, n, k):
    """Deviate of the number of runs of the lower and the upper half of the alphabet."""

    def of(high):
        behind, ahead = F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high) - 1)
        changes = F.zip_with(behind, ahead, lambda a, b: (a != b).cast("int"))
        counted = F.struct(
            F.aggregate(high, F.lit(0), lambda s, x: s + x).cast("double").alias("ones"),
            (F.aggregate(changes, F.lit(0), lambda s, x: s + x) + 1).alias("runs"),
        )

        def deviate(c):
            mean = 2 * c["ones"] * (n - c["ones"]) / n
            return (c["runs"] - 1 - mean) / F.sqrt(F.greatest(mean * (mean - 1) / (n - 1), F.lit(1e-6)))

        return _let(counted, deviate)

    return _let(F.transform(codes, lambda c: (c >= k / 2).cast("int")), of)


def _z_serial(codes, n):
    """Deviate of the correlation of neighbours; one letter throughout counts as correlated."""

    def of(off):
        behind, ahead = F.slice(off, 1, F.size(off) - 1), F.slice(off, 2, F.size(off) - 1)
        along = F.aggregate(F.zip_with(behind, ahead, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        total = F.aggregate(off, F.lit(0.0), lambda s, x: s + x * x)
        return (F.when(total > 0, along / total).otherwise(1.0) + 1 / n) * F.sqrt(n)

    middle = F.aggregate(codes, F.lit(0.0), lambda s, c: s + c) / n
    return _let(middle, lambda m: _let(F.transform(codes, lambda c: c - m), of))


def randomness(codes, k):
    """Combined p-value of the tests for numbers 0 to ``k - 1``; small if they are not random."""
    n = F.size(codes).cast("double")
    along = F.greatest(F.abs(_z_runs(codes, n, k)), F.abs(_z_serial(codes, n)))
    # Runs and correlation both look at neighbours and agree often, so of these two the clearer
    # one counts, at twice its value; Fisher's method takes that and chi-squared as independent.
    neighbours = F.least(F.lit(1.0), 2 * _let(along, _two_sided))
    half = -F.ln(_let(F.abs(_z_uniform(codes, n, k)), _two_sided)) - F.ln(neighbours)
    return _let(half, lambda h: F.exp(-h) * (1 + h))  # chi-squared with four degrees


def _pairs(text):
    """Numbers of the pairs of neighbouring characters of a text of ``LETTERS``."""

    def of(codes):
        ahead = F.slice(codes, 2, F.size(codes) - 1)
        return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), ahead, lambda a, b: a * len(LETTERS) + b)

    return _let(F.transform(F.split(text, ""), lambda c: F.instr(F.lit(LETTERS), c) - 1), of)


def _unlikely(text, plain):
    """How many standard deviations the pairs of a text are less likely than those of ordinary text, in steps."""
    costs = F.array(*(F.lit(c) for c in plain["costs"]))

    def of(pairs):
        n = F.size(pairs).cast("double")
        total = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.element_at(costs, p + 1))
        z = (total - n * plain["mean"]) / (F.sqrt(F.greatest(n, F.lit(1.0))) * plain["spread"])
        return F.greatest(F.lit(0), F.least(F.lit(Z_STEPS), F.floor(z / Z_STEP))).cast("int")

    return _let(_pairs(text), of)


def ordinary(text):
    """What ordinary text is like, from the different short words of a column of texts; None without any.

    ``costs`` has the bits of each pair of characters, ``mean`` and ``spread`` those of the pairs there
    are, ``tail`` for each step of ``_unlikely`` how many words reach it.
    """
    words = staged(text.select(F.explode(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))).alias("w")).distinct(), "secret-words")
    size = len(LETTERS)
    counts = [0.0] * (size * size)
    for row in words.select(F.explode(_pairs(F.col("w"))).alias("p")).groupBy("p").count().collect():  # at most 66 * 66
        counts[row["p"]] = float(row["count"])
    total = sum(counts)
    if not total:
        return None
    costs = []
    for a in range(size):
        own = counts[a * size : (a + 1) * size]
        costs += [-math.log2((c + 0.5) / (sum(own) + 0.5 * size)) for c in own]
    mean = sum(n * c for n, c in zip(counts, costs, strict=True)) / total
    spread = math.sqrt(sum(n * (c - mean) ** 2 for n, c in zip(counts, costs, strict=True)) / total)
    plain = {"costs": costs, "mean": mean, "spread": max(spread, 0.1)}
    long = words.where(F.char_length("w") >= WORD_CHARS).groupBy(_unlikely(F.col("w"), plain).alias("z")).count()
    tail = [0] * (Z_STEPS + 2)
    for row in long.collect():
        tail[row["z"]] = row["count"]
    for z in range(Z_STEPS, -1, -1):
        tail[z] += tail[z + 1]
    return {**plain, "tail": tail}


def _tokens(text, plain):
    """Long tokens and their parts: array of (start, end, encoding, p, z)."""

    def read(s):
        token = F.rtrim(F.substring(text, s["start"] + 1, s["end"] - s["start"]), F.lit("="))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), token.alias("token"))

    def parts(s):
        size = F.char_length(s["token"])
        inner = F.array_distinct(F.concat(*(_found(s["token"], pattern) for pattern in PARTS)))
        inner = F.filter(inner, lambda i: i["size"] < size)
        inner = F.transform(inner, lambda i: F.struct(
            (s["start"] + i["start"]).alias("start"), (s["start"] + i["end"]).alias("end"),
            F.substring(s["token"], i["start"] + 1, i["size"]).alias("token")))
        return F.when(s["token"].rlike("[+/_-]"), F.concat(F.array(s), inner)).otherwise(F.array(s))

    def infer(s):
        kind = None
        for name, alphabet, around, shape in ENCODINGS:
            own = F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("letters"), F.lit(around).alias("around"))
            kind = F.when(s["token"].rlike(shape), own) if kind is None else kind.when(s["token"].rlike(shape), own)
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["token"].alias("token"), kind.alias("kind")
        )

    def enough(s):
        return F.char_length(s["token"]) * F.log2(s["kind"]["around"].cast("double")) >= LEAST_BITS

    def test(s):
        k = F.char_length(s["kind"]["letters"]).cast("double")
        codes = F.transform(F.split(s["token"], ""), lambda c: F.instr(s["kind"]["letters"], c) - 1)
        p = _let(codes, lambda x: randomness(x, k))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"]["name"].alias("encoding"), p.alias("p"),
            (_unlikely(s["token"], plain) if plain else F.lit(0)).alias("z"),
        )

    tokens = F.flatten(F.transform(F.transform(_found(text, TOKEN), read), parts))
    inferred = F.transform(tokens, infer)
    return F.transform(F.filter(inferred, enough), test)


def _step(p):
    return F.least(F.lit(400), F.floor(-F.log10(F.greatest(p, F.lit(1e-20))) * STEPS).cast("int"))


def _band(s):
    """Length band: tests of longer tokens find more, so lengths are not mixed."""
    return F.floor(F.log2((s["end"] - s["start"]).cast("double")) * 2).cast("int")


def _limits(found, share):
    """For each length band the step of p from which tokens count as not random."""
    each = found.select(F.explode("tokens").alias("t"))
    counted = each.groupBy(_band(F.col("t")).alias("band"), _step(F.col("t.p")).alias("step")).count()
    limits = {}
    rows = {}
    for row in counted.collect():  # at most 401 steps for each of a few bands
        rows.setdefault(row["band"], []).append((row["step"], row["count"]))
    for band, steps in rows.items():
        total, below, limit = sum(c for _, c in steps), 0, None
        for step, count in sorted(steps, reverse=True):
            below += count
            if 10 ** (-step / STEPS) <= share * below / total:
                limit = step
        if limit is not None:
            limits[band] = limit
    return limits


def _reported(found, plain, share):
    """For each length band the step of ``z`` from which tokens count as no ordinary words."""
    each = found.select(F.explode("tokens").alias("t"))
    counted = each.groupBy(_band(F.col("t")).alias("band"), F.col("t.z").alias("z")).count()
    rows, limits = {}, {}
    for row in counted.collect():  # at most 401 steps for each of a few bands
        rows.setdefault(row["band"], []).append((row["z"], row["count"]))
    for band, steps in rows.items():
        total, reached = sum(c for _, c in steps), 0
        for z, count in sorted(steps, reverse=True):
            reached += count
            if (1 + plain["tail"][z]) / (1 + plain["tail"][0]) <= share * reached / total:
                limits[band] = z
    return limits


def scan(docs, id_col="doc_id", text_col="text", share=FALSE_SHARE, word_share=WORD_SHARE):
    """``id_col``, ``base`` and ``spans`` for every row of ``docs``.

    Both are arrays of (start, rank, end, kind), sorted: ``base`` has what the patterns find,
    ``spans`` that and the kind ``random``, which does not overlap it. Positions are code
    points, the end exclusive. Null and empty texts have none. Repeated rows and null ids
    are kept; other columns are not looked at. An empty table gives an empty result. Where no text
    has an ordinary word of ``WORD_CHARS`` characters there is nothing to compare with, and only the patterns count.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = ordinary(docs.select(text.alias("text")))
    base = F.array_sort(
        F.concat(_spans(text, "assign", ASSIGN, 2), _spans(text, "access", ACCESS_LONG), _spans(text, "hex", HEX_LONG))
    )
    found = staged(docs.select(F.col(id_col).alias("id"), base.alias("base"), _tokens(text, plain).alias("tokens")), "secret-spans")
    limits = _limits(found, share)
    least = _reported(found, plain, word_share) if plain else {}

    def of_band(limits, t):
        """The limit of the band of a token; null without one."""
        return F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))[_band(t)] if limits else F.lit(None).cast("int")

    def random(t):
        passed = F.coalesce(_step(t["p"]) < of_band(limits, t), F.lit(True))
        passed &= F.coalesce(t["z"] >= of_band(least, t), F.lit(False))
        free = ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        return passed & free

    def outermost(t):
        size, over = t["end"] - t["start"], lambda u: (u["start"] < t["end"]) & (t["start"] < u["end"])
        longer = lambda u: (u["end"] - u["start"] > size) | ((u["end"] - u["start"] == size) & (u["start"] < t["start"]))
        return ~F.exists("passed", lambda u: over(u) & longer(u))

    found = found.withColumn("passed", F.filter("tokens", random))
    extra = F.transform(F.filter("passed", outermost), lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"), F.lit("random").alias("kind")))
    return found.select(F.col("id").alias(id_col), "base", F.array_sort(F.concat("base", extra)).alias("spans"))


def listed(spans):
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
