"""Secret scan: base spans against Python's regular expressions, and the test battery."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from layercake.llm import secrets
from tests.llm.conftest import words

PATTERNS = {
    "assign": re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            size = len(m[2] if kind == "assign" else m[0])
            if size >= secrets.LEAST[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def found(docs):
    rows = secrets.scan(docs).select("doc_id", "base", "spans").collect()
    return [(r[0], [tuple(s) for s in r[1]], [tuple(s) for s in r[2]]) for r in rows]


def test_base_spans_equal_brute_force(make_docs, odd_rows):
    pick = random.Random(1)
    parts = [
        "password", "PassWD", "secret", "token", "api_key", "apikey", "API_KEY", '"', "'", " ", "  ", ":", "=", "\t",
        "abc", "abcdef", "hunter2.x", "\U0001f600", "é", "AKIA", "AKIA" + "Q7" * 9, "AKIAAKIA" + "X" * 15, "f" * 24,
        "0123456789abcdef" * 2, "a" * 23, "\n", "K", "ſecret", ",", "secret: token: abcdef12", "token=token=abcdefg",
    ]
    rows = [(i, "".join(pick.choice(parts) for _ in range(pick.randrange(1, 40)))) for i in range(300)] + odd_rows
    expected = sorted(((i, brute(t)) for i, t in rows), key=repr)
    assert sorted(((i, base) for i, base, _ in found(make_docs(rows))), key=repr) == expected


def prose(n, seed):
    """Ordinary text: invented words of syllables, some of them as long as a key."""
    pick = random.Random(seed)
    parts = "an bel co dar en fi gor he in ka lo men nu or pal qua ri sto ti un ver wi xa yo zen the ing tion".split()
    made = ["".join(pick.choice(parts) for _ in range(pick.choice((1, 2, 2, 3, 4, 5, 8)))) for _ in range(n)]
    return " ".join(w.capitalize() if pick.random() < 0.1 else w for w in made)


def texts(real):
    """Each key in some ordinary text, and more such text."""
    rows = [(i, f"{prose(30, i)} {t} {prose(9, i + 0.5)}") for i, t in enumerate(real)]
    return rows + [(9000 + i, prose(400, -i)) for i in range(40)]


def keys(kind, n, size):
    pick = random.Random(f"{kind}{size}")
    letters = {"base64": string.ascii_letters + string.digits + "+/", "base36": string.digits + string.ascii_lowercase}[kind]
    out = []
    while len(out) < n:
        one = "".join(pick.choice(letters) for _ in range(size))
        if re.search("[0-9]", one) and re.search("[a-z]", one) and (kind == "base36" or re.search("[A-Z]", one)):
            out.append(one)
    return out


def test_random_keys_are_found_and_regular_tokens_are_not(make_docs):
    real = keys("base64", 60, 40) + keys("base36", 60, 32)
    odd = [c * 30 + "1" for c in "qwz"] + ["abcabcabc123" * 3, "Version1" * 5, "xyz1" * 9, "AbAbAbAbAbAbAbAbAbAb12"] * 5
    rows = [*texts(real + odd), (9100, "tiontiantindtionbleofthe " * 20)]
    by_id = {i: [s for s in spans if s[3] == "random"] for i, _, spans in found(make_docs(rows))}
    hits = [bool(by_id[i]) for i in range(len(real))]
    assert sum(hits) / len(hits) > 0.9
    assert not any(by_id[i] for i in range(len(real), len(real) + len(odd)))
    assert not any(spans for i, spans in by_id.items() if i >= 9000)
    for i, spans in by_id.items():
        for start, _, end, _ in spans:
            assert rows[i][1][start:end] == (real + odd)[i]


def test_keys_that_lack_digits_or_cases_and_keys_in_paths_are_found(make_docs):
    pick, letters = random.Random(11), string.ascii_letters
    kinds = {
        "letters": (letters, 32), "lower": (string.ascii_lowercase, 16), "base32": (string.ascii_uppercase + "234567", 16),
        "base64": (letters + string.digits + "+/", 16), "base64url": (letters + string.digits + "-_", 20),
        "mixed": (letters + string.digits + "+/-_", 40),
    }
    real = [("".join(pick.choices(own, k=size)), kind) for kind, (own, size) in kinds.items() for _ in range(40)]
    rows = texts([t for t, _ in real])
    path = "com/user_data/k9Xv2QmT7bLpZr4WnYc8Hd3F"
    far = "srv/application_data/configuration_data/production_data/k9Xv2QmT7bLpZr4WnYc8Hd3F"
    rows += [(900, path), (901, far), (902, "-" * 40), (903, "a_name_that_is_made_of_several_plain_words_and_is_long")]
    by_id = {i: [s for s in spans if s[3] == "random"] for i, _, spans in found(make_docs(rows))}
    for kind in kinds:
        hits = [any(s[0] <= rows[i][1].index(t) and s[2] >= rows[i][1].index(t) + len(t) for s in by_id[i]) for i, (t, k) in enumerate(real) if k == kind]
        assert sum(hits) / len(hits) > 0.85, kind
    for i, text in ((900, path), (901, far)):
        assert any(s[0] <= text.index("k9Xv") and s[2] == len(text) for s in by_id[i])
    assert not by_id[902] and not by_id[903]
    for spans in by_id.values():
        assert all(a[2] <= b[0] for a, b in zip(spans, spans[1:]))


def test_added_spans_leave_base_spans_alone(make_docs):
    key = keys("base64", 1, 40)[0]
    text = f"\U0001f600 token={key} and {key}"
    by_id = {i: (base, spans) for i, base, spans in found(make_docs([*texts([]), (1, text)]))}
    base, spans = by_id[1]
    assert [s[3] for s in base] == ["assign"] and base[0][:1] == (2,)
    assert [s[3] for s in spans] == ["assign", "random"]
    # Alone there is no ordinary text that the token could differ from.
    ((_, base, spans),) = found(make_docs([(1, text)]))
    assert spans == base and len(base) == 1


def test_ordinary_words_are_not_reported(make_docs):
    """Long words of plain text are left alone while keys of every alphabet among them are found."""
    pick = random.Random(12)
    kinds = [string.ascii_lowercase, string.ascii_letters, string.ascii_letters + string.digits, string.digits + "abcdef"]
    real = ["".join(pick.choices(k, k=n)) for k in kinds for n in (20, 24, 32) for _ in range(12)]
    rows = texts(real)
    long = sum(len(w) >= 16 for _, t in rows for w in t.split())
    assert long > 800
    spans = {i: [s[:3:2] for s in own] for i, _, own in found(make_docs(rows))}
    hits = sum(any(t[a:b] == key for a, b in spans[i]) for (i, t), key in zip(rows, real))
    reported = sum(len(own) for own in spans.values())
    assert hits / len(real) > 0.9 and (reported - hits) / reported < 0.05


def test_unlikely_steps_equal_brute_force(spark):
    """The model of ordinary text and the steps of tokens, counted again in Python."""
    import math

    rows = [(prose(50, i),) for i in range(6)] + [("a1 b2-c3/d4+e5 été averyveryverylongword",)]
    model = secrets.ordinary(spark.createDataFrame(rows, "text string"))
    short = {w for (t,) in rows for w in re.findall("[A-Za-z0-9+/_-]+", t) if 2 <= len(w) <= 15}
    letters = secrets.LETTERS
    count, first = {}, {}
    for w in short:
        for a, b in zip(w, w[1:]):
            count[a, b] = count.get((a, b), 0) + 1
            first[a] = first.get(a, 0) + 1
    cost = lambda a, b: -math.log2((count.get((a, b), 0) + 0.5) / (first.get(a, 0) + 33))
    n = sum(count.values())
    mean = sum(c * cost(*p) for p, c in count.items()) / n
    spread = math.sqrt(sum(c * (cost(*p) - mean) ** 2 for p, c in count.items()) / n)
    assert model["mean"] == pytest.approx(mean) and model["spread"] == pytest.approx(spread)

    def step(w):
        own = [cost(a, b) for a, b in zip(w, w[1:])]
        return max(0, min(400, math.floor((sum(own) - len(own) * mean) / (math.sqrt(len(own)) * spread) / 0.25)))

    tokens = [*sorted(short), "Zq0Zq0Zq0Zq0Zq0Zq0", "a" * 30, letters]
    frame = spark.createDataFrame([(w,) for w in tokens], "w string")
    got = [tuple(r) for r in frame.select("w", secrets._unlikely(F.col("w"), model)).collect()]
    assert got == [(w, step(w)) for w in tokens]
    long = [step(w) for w in short if len(w) >= 8]
    assert model["tail"][:20] == [sum(z >= k for z in long) for k in range(20)]


@pytest.mark.parametrize("k", [16, 36, 64])
def test_p_values_of_random_text_keep_their_level(spark, k):
    pick = random.Random(k)
    rows = [([pick.randrange(k) for _ in range(80)],) for _ in range(1500)]
    codes = spark.createDataFrame(rows, "codes array<int>")
    p = [r[0] for r in codes.select(secrets.randomness(F.col("codes"), F.lit(float(k)))).collect()]
    # Random text is called regular no more often than the level says, and not much less.
    for at in (0.01, 0.05, 0.2, 0.5):
        assert at / 3 < sum(x < at for x in p) / len(p) < at + 0.02


def test_listed_and_empty(spark, make_docs):
    docs = make_docs([(1, "password=abcdef 0123456789abcdef01234567")])
    (row,) = secrets.scan(docs).select(secrets.listed("spans")).collect()
    assert row[0] == "assign:0:15,hex:16:40"
    assert secrets.scan(make_docs([])).count() == 0
