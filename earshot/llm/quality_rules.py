"""Quality rules: a threshold table that becomes one Spark projection.

``measure_text`` computes the measures of each text with Spark expressions only,
``apply_rules`` turns the threshold table into one projection that lists the failed
rules and gives the verdict.  No user function and no shuffle: rows are independent, so
hot sources, copies and ties need no care, and a very long text costs as much as its words.

Null or empty text has no words; all measures are zero and the base rule rejects it.
Repeated rows give repeated results.  Further columns are carried along, whatever their names;
those named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import SPACES, words_of

#: Words in a window whose repetition counts.
WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or that the this to was with "
    "auf das der des die ein eine im in ist mit nicht sich und von zu für "
    "dans de des du elle est et la le les par pas pour que qui sur un une avec "
    "al con de del el en la las lo los no para por que se su un una y"
).split()


#: Columns that are added; those of ``docs`` with these names are replaced.
ADDED = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words base_failed "
    "failed_rules kept"
).split()


@dataclass(frozen=True)
class Rule:
    """A text fails if ``measure`` is below ``least`` or above ``most``."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The production thresholds.  The first two are the base rule.
BASE_RULES = (
    Rule("too_few_words", "n_words", least=20),
    Rule("repeated_words", "repeat_percent", most=30),
)
RULES = (
    Rule("word_length", "mean_word_chars", least=2, most=15),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.05),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)


def _paired(hashes: str, step: int) -> Column:
    """Each hash joined with the one ``step`` places further on."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(
        F.slice(hashes, F.lit(1), n),
        F.slice(hashes, F.lit(1 + step), n),
        lambda a, b: F.xxhash64(a, b),
    )


def measure_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures that the rules look at.

    n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_words (long).
    Equal windows are recognised by their 64-bit hashes; the words they cover are the union of
    the windows, i.e. the sum of min(8, distance to the next one) over the sorted positions.
    """
    keep = [c for c in docs.columns if not c.startswith("_q_") and c not in ADDED]
    step = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_q_text"),
    )
    step = step.select(
        "*",
        words_of(F.col("_q_text")).alias("_q_words"),
        F.filter(
            F.split("_q_text", "\n"), lambda line: F.regexp_replace(line, SPACES, "") != ""
        ).alias("_q_lines"),
    )
    # A 64-bit hash of each window of eight words, by doubling: 1, 2, 4, 8 words.  Each level is
    # a column of its own, so that it is computed once.
    step = step.select("*", F.transform("_q_words", lambda w: F.xxhash64(w)).alias("_q_1"))
    step = step.select("*", _paired("_q_1", 1).alias("_q_2"))
    step = step.select("*", _paired("_q_2", 2).alias("_q_4"))
    step = step.select("*", _paired("_q_4", 4).alias("_q_hashes"))
    # The windows in hash order; empty unless some hash occurs twice.
    ordered = F.sort_array(
        F.transform("_q_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    )
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    twice = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    step = step.select("*", F.when(twice, ordered).otherwise(none).alias("_q_sorted"))
    first = F.slice("_q_sorted", F.lit(1), F.greatest(F.size("_q_sorted") - 1, F.lit(0)))
    rest = F.slice("_q_sorted", F.lit(2), F.greatest(F.size("_q_sorted") - 1, F.lit(0)))
    pairs = F.zip_with(
        first, rest, lambda a, b: F.when(a["h"] == b["h"], F.array(a["at"], b["at"]))
    )
    positions = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    step = step.select("*", positions.alias("_q_at"))
    covered = F.zip_with(
        "_q_at",
        F.slice("_q_at", F.lit(2), F.greatest(F.size("_q_at") - 1, F.lit(0))),
        lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return step.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size("_q_words").cast("long").alias("n_words"),
        F.length(F.array_join("_q_words", "")).cast("long").alias("word_chars"),
        (F.length("_q_text") - F.length(F.regexp_replace("_q_text", "[#*$%&|<>]", "")))
        .cast("long")
        .alias("n_symbols"),
        F.size("_q_lines").cast("long").alias("n_lines"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines")))
        .cast("long")
        .alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda acc, x: acc + x).alias(
            "n_repeat_words"
        ),
        F.size(F.filter("_q_words", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS)))))
        .cast("long")
        .alias("n_stop_words"),
    )


def ratios() -> dict[str, Column]:
    """The measures that rules may name besides the counts; zero where there are no words."""

    def per(count: Column, base: str) -> Column:
        return F.coalesce(count / F.nullif(F.col(base), F.lit(0)), F.lit(0.0))

    return {
        "n_words": F.col("n_words").cast("double"),
        "repeat_percent": per(100 * F.col("n_repeat_words"), "n_words"),
        "mean_word_chars": per(F.col("word_chars"), "n_words"),
        "symbols_per_word": per(F.col("n_symbols"), "n_words"),
        "stop_word_ratio": per(F.col("n_stop_words"), "n_words"),
        "dup_line_ratio": per(F.col("n_dup_lines"), "n_lines"),
    }


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The names of the failed rules, as one array expression over the measures."""
    measures = ratios()
    failed = []
    for rule in rules:
        value, bad = measures[rule.measure], F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        failed.append(F.when(bad, F.lit(rule.name)))
    return F.filter(F.array(*failed), lambda name: name.isNotNull())


def apply_rules(
    docs: DataFrame,
    text: str = "text",
    base: tuple[Rule, ...] = BASE_RULES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    measured = measure_text(docs, text)
    return measured.select(
        "*",
        (F.size(compile_rules(base)) > 0).alias("base_failed"),
        F.array_join(compile_rules(rules), ",").alias("failed_rules"),
        (F.size(compile_rules(base + rules)) == 0).alias("kept"),
    )
