"""The registered queries of the subpackage: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import (
    chat_format,
    classifier,
    embedding_links,
    html_text,
    infilling,
    licenses,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    secrets,
    token_counts,
    vector_codes,
)
from earshot.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Target weights of the mixture: all twenty sources alike, whatever their sizes, and all
#: documents of other or no source together like one more.
MIX_WEIGHTS = {f"src{i}": 1.0 for i in range(20)}
MIX_OTHER = 1.0
MIX_SEED = 42
#: The public vocabulary that packing counts in.
VOCABULARY = "byte_bpe_50k.json"
#: The public vocabulary whose tokens are counted.
COUNTED_VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def automata() -> dict[str, secrets.Automaton]:
    return secrets.learn_all(secrets.labelled_examples())


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return ruled.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_stop_words",
        "failed_rules",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).drop("text")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.digest(packing.pack_documents(docs, vocabulary_path()))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings."""
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # Built from literals of one row, so that no Python rows enter the plan.
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat_format.digest(chat_format.format_conversations(rows.unionByName(extra)))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(
        table(spark, sf_dir, "documents"), MIX_WEIGHTS, other_weight=MIX_OTHER, seed=MIX_SEED
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.scan_secrets(docs, automata(), redacted=False))


def op8_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.link_vectors(table(spark, sf_dir, "embeddings"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.score_documents(docs, model).select(
        "doc_id",
        "text_score",
        "meta_score",
        "score",
        (F.col("score") >= classifier.GOOD).alias("kept"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(docs)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary_path(COUNTED_VOCABULARY))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return infilling.digest(infilling.restored(infilling.transform(docs)))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


def queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_license_scan": op2_license_scan,
        "op3_packing": op3_packing,
        "op4_chat_format": op4_chat_format,
        "op5_source_mixing": op5_source_mixing,
        "op6_html_extraction": op6_html_extraction,
        "op7_secret_scan": op7_secret_scan,
        "op8_embedding_links": op8_embedding_links,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_ngram_join": op10_ngram_join,
        "op11_token_counts": op11_token_counts,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_vector_codes": op13_vector_codes,
    }
