"""A corpus made ready for training, in five stages, each written before the next reads it.

Every stage takes all its predecessor kept and looks at the columns it names only. Rows with a null id
are documents of their own: they lose no line and are no copies. Null and empty texts have no words
and no benchmark passage; the classifier scores them by its bias, and the last stage never draws them.
Repeated rows stay or go together, but for the same id with several texts, of which lines are dropped
each by itself. Texts may be of any length, and an empty table gives an empty one.
"""

from pyspark.sql import functions as F

from layercake.llm import decontaminate, jaccard, lines, mixing, quality
from layercake.llm.common import ship, staged, table
from layercake.llm.queries import MIX, MIX_FRACTION

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3


def good_quality(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject. The model is that of the labels."""
    ship(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.attach_score(docs, model).where(F.col("score") >= LEAST_SCORE).select(*COLUMNS)


def once_per_line(spark, docs, sf_dir):
    """Lines that several documents share stay in the first only; ``n_chars`` follows the text."""
    ship(spark)
    found = lines.apply(lines.insert(None, docs), docs)
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*COLUMNS)


def once_per_group(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the smallest id."""
    ship(spark)
    found = jaccard.deduplicate(docs)
    copies = found.where("doc_id <> component_id").select(F.col("doc_id").alias("copy")).distinct()
    return docs.join(copies, docs["doc_id"] == copies["copy"], "left_anti").select(*COLUMNS)


def without_benchmark(spark, docs, sf_dir):
    """Documents that the benchmark does not contaminate."""
    ship(spark)
    found = decontaminate.attach_matches(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.verdicts(found).where(~F.col("contaminated")).select(*COLUMNS)


def mixed(spark, docs, sf_dir):
    """Documents drawn to the target weights of sources, languages and topics."""
    found = mixing.mix(docs.select(*COLUMNS), MIX, MIX_FRACTION)
    return found.where("sampled").drop("sampled")


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", once_per_line),
    ("jaccard_join", once_per_group),
    ("decontamination", without_benchmark),
    ("source_mixing", mixed),
]

# The first and the last stage fit models, which SQL cannot express; see tests/llm.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
