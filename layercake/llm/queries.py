"""The registered queries of this subpackage: each operator over its whole table."""

from pyspark.sql import functions as F

from layercake.llm import (
    collocation,
    decontaminate,
    jaccard,
    langid,
    lines,
    mixing,
    quality,
    rules,
    secrets,
    sharding,
    toxicity,
    urls,
    whitening,
)
from layercake.llm.common import crc_of, ship, table


def _sha256(text):
    return F.sha2(F.encode(text, "utf-8"), 256)


def op1_toxicity(spark, sf_dir):
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model)


def op2_jaccard_join(spark, sf_dir):
    ship(spark)
    return jaccard.deduplicate(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark, sf_dir):
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lines.apply(lines.load(docs, batches=2), docs)
    kept = F.coalesce("text", F.lit(""))
    return found.select("doc_id", "n_lines", "n_dropped", _sha256(kept).alias("kept_sha256"))


def op4_quality_classifier(spark, sf_dir):
    ship(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of("doc_id") % 5 == 0
    model = quality.fit(docs, labels.where(~held_out))
    return quality.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


# Target shares; a value without one shares in what is left.
MIX = {
    "source": {f"src{i}": 0.05 for i in range(20)},
    "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
    "topic": {"prose": 0.8, "short": 0.15, "licence": 0.03, "markup": 0.02},
}
MIX_FRACTION = 0.3


def op5_source_mixing(spark, sf_dir):
    """All documents with the probability of their cell and whether they were drawn."""
    found = mixing.mix(table(spark, sf_dir, "documents"), MIX, MIX_FRACTION)
    return found.select("doc_id", "cell", "probability", "sampled")


# The rules that go before the method.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op6_url_filter(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 0).otherwise(1)
    outcomes = labels.where("quality is not null and toxic is not null").select(
        F.col("doc_id").alias("page_id"), bad.alias("bad")
    )
    found = urls.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op7_secret_scan(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(number(k) for k in secrets.KINDS),
        _sha256(secrets.listed("base")).alias("base_sha256"),
        secrets.listed("spans").alias("spans"),
    )


def op8_decontamination(spark, sf_dir):
    ship(spark)
    found = decontaminate.verdicts(
        decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        _sha256(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


def op9_language_id(spark, sf_dir):
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of("doc_id") % 4 == 2
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_quality_rules(spark, sf_dir):
    ship(spark)
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def op11_embedding_whitening(spark, sf_dir):
    ship(spark)
    rows, model = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitening.by_component(rows, model)


def op12_phrase_collocation(spark, sf_dir):
    ship(spark)
    return collocation.phrases(table(spark, sf_dir, "documents"))


def op13_sharding(spark, sf_dir):
    rows = sharding.measured(table(spark, sf_dir, "documents"))
    return sharding.shard(rows, group_col="group").select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_source_mixing": op5_source_mixing,
    "op6_url_filter": op6_url_filter,
    "op7_secret_scan": op7_secret_scan,
    "op9_language_id": op9_language_id,
    "op8_decontamination": op8_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_phrase_collocation": op12_phrase_collocation,
    "op13_sharding": op13_sharding,
}

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, pos, line,
        translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (
        SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    )
),
owners AS (
    SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 AND doc_id IS NOT NULL
    GROUP BY key HAVING count(DISTINCT doc_id) > 1
),
marked AS (
    SELECT l.doc_id, l.pos, l.line, o.owner IS NOT NULL AND o.owner <> l.doc_id AS gone
    FROM lines l LEFT JOIN owners o ON l.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

URL_FILTER = r"""
WITH split1 AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
split2 AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM split1),
own AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM split2
),
labelled AS (
    SELECT o.host, CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 0 ELSE 1 END AS bad
    FROM own o JOIN labels l ON l.doc_id = o.page_id WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL
),
named AS (
    SELECT *, string_split(bare, '.') AS parts FROM (
        SELECT DISTINCT host, regexp_replace(host, ':[0-9]*$', '') AS bare FROM own
    )
),
two AS (
    SELECT *, array_to_string(parts[-2:], '.') AS last2, array_to_string(parts[-3:], '.') AS last3,
        regexp_matches(bare, '^[0-9.]+$') OR starts_with(bare, '[') OR len(parts) < 2 AS address FROM named
),
levels AS (
    SELECT host,
        CASE WHEN address THEN bare WHEN last2 IN ({suffixes}) THEN last3 ELSE last2 END AS domain,
        CASE WHEN address THEN '' WHEN last2 IN ({suffixes}) THEN last2 ELSE parts[-1] END AS suffix
    FROM two
),
hosts AS (
    SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad
    FROM labelled JOIN levels USING (host) GROUP BY ALL
),
base AS (
    SELECT mean, mean * (1 - mean) / (n + 3) AS var FROM (
        SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean, coalesce(sum(n), 0) AS n FROM hosts)
),
s0 AS (
    SELECT suffix, n, bad, (SELECT mean FROM base) AS mean, (SELECT var FROM base) AS var
    FROM (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix)
),
s1 AS (SELECT {strength} AS s FROM s0),
s2 AS (
    SELECT suffix, m AS mean, m * (1 - m) / (n + s + 1) + (s / (n + s)) * (s / (n + s)) * var AS var
    FROM (SELECT *, (bad + s * mean) / (n + s) AS m FROM s0, s1)
),
d0 AS (
    SELECT domain, n, bad, mean, var FROM (
        SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
    ) JOIN s2 USING (suffix)
),
d1 AS (SELECT {strength} AS s FROM d0),
d2 AS (
    SELECT domain, m AS mean, m * (1 - m) / (n + s + 1) + (s / (n + s)) * (s / (n + s)) * var AS var
    FROM (SELECT *, (bad + s * mean) / (n + s) AS m FROM d0, d1)
),
h0 AS (SELECT host, n, bad, mean, var FROM hosts JOIN d2 USING (domain)),
h1 AS (SELECT {strength} AS s FROM h0),
h2 AS (
    SELECT host, m AS mean, m * (1 - m) / (n + s + 1) + (s / (n + s)) * (s / (n + s)) * var AS var
    FROM (SELECT *, (bad + s * mean) / (n + s) AS m FROM h0, h1)
),
judged AS (
    SELECT page_id, o.host, path,
        CASE WHEN (o.host = 'example.net' OR ends_with(o.host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
             WHEN (o.host = 'example.com' OR ends_with(o.host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
             WHEN (o.host = 'org' OR ends_with(o.host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
             WHEN (o.host = 'net' OR ends_with(o.host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
        coalesce(h2.mean, d2.mean, t.mean, (SELECT mean FROM base)) AS mean,
        sqrt(coalesce(h2.var, d2.var + d2.mean * (1 - d2.mean) / (1 + (SELECT s FROM h1)),
            t.var + t.mean * (1 - t.mean) * (1 / (1 + (SELECT s FROM d1)) + 1 / (1 + (SELECT s FROM h1))),
            (SELECT var + mean * (1 - mean) * (1 / (1 + (SELECT s FROM s1)) + 1 / (1 + (SELECT s FROM d1))
                + 1 / (1 + (SELECT s FROM h1))) FROM base))) AS spread
    FROM own o LEFT JOIN levels v ON v.host = o.host LEFT JOIN h2 ON h2.host = o.host
        LEFT JOIN d2 ON d2.domain = v.domain LEFT JOIN s2 t ON t.suffix = v.suffix
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
         WHEN mean - {z} * spread > {limit} THEN 'block' ELSE 'allow' END AS verdict
FROM judged
""".format(
    suffixes=", ".join(f"'{s}'" for s in urls.SUFFIXES),
    strength="1 / least(0.5::DOUBLE, greatest(0.001::DOUBLE, coalesce(sum((bad - n * mean) ** 2 - n * mean * (1 - mean))"
    " / nullif(sum(n * (n - 1) * mean * (1 - mean)), 0), 0.5::DOUBLE))) - 1",
    z=urls.Z,
    limit=urls.LIMIT,
)

PHRASES = r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^ \t]+') AS words FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\f\r]')) AS piece
        FROM documents WHERE text IS NOT NULL
    )
),
grams AS (
    SELECT lang, words[i:i + size - 1] AS phrase, count(*) AS f FROM (
        SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM pieces, (VALUES (1), (2), (3)) AS sizes(size)
    ) GROUP BY ALL
),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE len(phrase) = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, f AS a FROM grams WHERE len(phrase) > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
        ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, len(phrase))) AS k FROM candidates) c
    JOIN grams l ON l.lang = c.lang AND l.phrase = c.phrase[:k]
    JOIN grams r ON r.lang = c.lang AND r.phrase = c.phrase[k + 1:]
),
best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
    SELECT lang, phrase[i:i + 1] AS phrase, max(a) AS longer
    FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE len(phrase) = 3) GROUP BY ALL
),
ranked AS (
    SELECT b.lang, array_to_string(b.phrase, ' ') AS phrase, b.a, l, r, n, score,
        row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, array_to_string(b.phrase, ' ')) AS rank
    FROM best b JOIN totals USING (lang) LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE longer IS NULL OR 100 * longer < 50 * b.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

ORACLES = {"op3_line_dedup": LINE_DEDUP, "op6_url_filter": URL_FILTER, "op12_phrase_collocation": PHRASES}
