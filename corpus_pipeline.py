"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import classifier, mixing, ngram_join, packing, secrets
from earshot.llm.common import table
from earshot.llm.queries import MIX_OTHER, MIX_SEED, MIX_WEIGHTS, automata, vocabulary_path
from earshot.session import scratch_path

#: The columns that stages hand on.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored = classifier.score_documents(docs.select(*COLUMNS), model)
    return scored.where(F.col("score") >= classifier.GOOD).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return ngram_join.keep_representatives(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    scanned = secrets.scan_secrets(docs.select(*COLUMNS), automata())
    text = F.coalesce("secrets.redacted", "text")
    changed = F.col("secrets.redacted").isNotNull()
    return scanned.select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(changed, F.length(text)).otherwise(F.col("n_chars")).cast("long").alias("n_chars"),
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by a Poisson count, so that sources get their target weights."""
    mixed = mixing.mix_sources(
        docs.select(*COLUMNS), MIX_WEIGHTS, other_weight=MIX_OTHER, seed=MIX_SEED
    )
    return mixed.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of power-of-two lengths."""
    return packing.digest(packing.pack_documents(docs, vocabulary_path()))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: SQL cannot express the trained stages; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
