"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; neighbours of equal role are
merged into one block; blocks are concatenated.  The template is

    <role:ROLE>first text<and>second text<end>\\n

with one ``<role:...>`` for each block, ``<and>`` between its turns and ``<end>`` behind it.
Inside roles and texts a backslash becomes ``\\s`` and ``<`` becomes ``\\l`` (in roles ``>``
becomes ``\\g``), so a ``<`` in the output always opens a mark of the template and texts can
be read back exactly, whatever they contain.

The output has ``segments`` (text, loss): the formatted string cut into marks and texts, where
``loss`` marks the texts of assistant turns.

Null text or role counts as empty.  Turns are ordered by (turn, role, text), null turns first,
so ties have a defined order and repeated rows stay repeated turns.  Rows with a null
conversation id form one conversation.  Other columns are not read.

A conversation is one output row, so its rows meet in one task.  To keep that small, turns
are first combined per (conversation, range of turns) with the map-side buffers of
``collect_list``; a conversation of a billion turns could not be one string in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turns of one conversation that are collected together first.
CHUNK = 256
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\g"), F.lit(">")))


def collect_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the sorted turns of each conversation."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chunks = rows.groupBy("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk")).agg(
        F.collect_list(turn).alias("part")
    )
    return chunks.groupBy("conv_id").agg(
        F.sort_array(F.flatten(F.collect_list("part"))).alias("turns")
    )


def merge_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, blocks): runs of turns of one role as (role, texts)."""
    steps = turns.select(
        "conv_id",
        "turns",
        F.zip_with(
            F.transform("turns", lambda t: t["role"]),
            F.concat(
                F.array(F.lit(None).cast("string")),
                F.slice(F.transform("turns", lambda t: t["role"]), F.lit(1), F.size("turns") - 1),
            ),
            lambda role, before: ~role.eqNullSafe(before),
        ).alias("opens"),
    )
    # Positions (from one) at which a block opens, and where the next one does.
    starts = F.filter(
        F.transform("opens", lambda o, i: F.when(o, i + 1)), lambda at: at.isNotNull()
    )
    steps = steps.select("conv_id", "turns", starts.alias("starts"))
    spans = F.zip_with(
        "starts",
        F.slice("starts", F.lit(2), F.size("starts")),
        lambda a, b: F.struct(
            a.alias("at"), (F.coalesce(b, F.size("turns") + 1) - a).alias("length")
        ),
    )
    return steps.select(
        "conv_id",
        F.transform(
            spans,
            lambda s: F.struct(
                F.element_at(F.col("turns"), s["at"])["role"].alias("role"),
                F.transform(
                    F.slice(F.col("turns"), s["at"], s["length"]), lambda t: t["text"]
                ).alias("texts"),
            ),
        ).alias("blocks"),
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments): one row for each conversation."""

    def mark(text: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(False).alias("loss"))

    def of_block(block: Column) -> Column:
        pieces = F.flatten(
            F.transform(
                block["texts"],
                lambda t, i: F.array(
                    mark(
                        F.when(
                            i == 0,
                            F.concat(F.lit("<role:"), escape_role(block["role"]), F.lit(">")),
                        ).otherwise(F.lit("<and>"))
                    ),
                    F.struct(escape(t).alias("text"), (block["role"] == LOSS_ROLE).alias("loss")),
                ),
            )
        )
        return F.concat(pieces, F.array(mark(F.lit("<end>\n"))))

    merged = merge_turns(collect_turns(rows))
    cut = merged.select("conv_id", F.flatten(F.transform("blocks", of_block)).alias("segments"))
    return cut.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    blocks = F.filter(F.split(formatted, "<end>\n"), lambda b: b != "")

    def of_block(block: Column) -> Column:
        role = unescape_role(
            F.substring_index(F.substr(block, F.lit(len("<role:") + 1)), ">", 1)
        )
        body = F.substr(block, F.instr(block, ">") + 1)
        return F.transform(
            F.split(body, "<and>"),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, of_block))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )


def digest(formatted: DataFrame) -> DataFrame:
    """What the output of ``format_conversations`` says when it is read back."""
    read = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("segments")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
