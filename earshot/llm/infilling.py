"""Fill-in-the-middle transformation by rotating blocks in place.

A document is cut at two places that its id alone decides, so a task that runs again cuts alike.
Spark expressions choose the form and the cuts, in code points.  The text itself is moved as UTF-8
bytes in one bytearray: the cuts are found by a scan over bytes that begin a code point, the
sentinels are inserted as ``<P>prefix<M>middle<S>suffix``, and two neighbouring blocks change
places by a rotation, which is three reversals in place:

* psm rotates the middle's block with the suffix's: ``<P>prefix<S>suffix<M>middle``;
* spm rotates everything before the suffix with it: ``<S>suffix<P>prefix<M>middle``.

``restore`` finds the sentinels, rotates back by the same steps and removes them, which gives
the very text.  A text that holds a sentinel stays plain, so the marks of an output are never
in doubt; marks begin and end with characters that no other mark shares, so none can arise
where two parts meet.

Null text is empty, and empty texts stay plain.  A null id counts as an empty one.  Long texts are taken
whole; beside the bytearray only blocks of ``BLOCK`` bytes are copied.  Repeated rows are treated
alike, an empty table gives no rows, and further columns are not read.  Rows are
independent: no shuffle, so hot sources need no care.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
SEED = 1
#: Share of texts that are cut, and of those the share in which the suffix comes first.
CUT_PERCENT = 90
SPM_PERCENT = 20
#: Bytes that are copied at a time.
BLOCK = 1 << 16


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Raises unless no sentinel can overlap with itself or another one."""
    for one in sentinels:
        for other in sentinels:
            if any(one[k:] == other[: len(one) - k] for k in range(1, len(one))):
                raise ValueError(f"sentinels {one!r} and {other!r} may overlap")
            if one is not other and one in other:
                raise ValueError(f"sentinel {other!r} holds {one!r}")


def byte_offsets(raw: bytes, *counts: int) -> list[int]:
    """Where the code points of the given numbers, in ascending order, begin."""
    found, seen, wanted = [], 0, list(counts)
    for at in range(0, len(raw), BLOCK):
        part = np.frombuffer(raw, np.uint8, min(BLOCK, len(raw) - at), at)
        begins = (part & 0xC0) != 0x80
        total = int(np.count_nonzero(begins))
        if wanted and wanted[0] < seen + total:
            places = np.flatnonzero(begins)
            while wanted and wanted[0] < seen + total:
                found.append(at + int(places[wanted.pop(0) - seen]))
        seen += total
        if not wanted:
            break
    return found + [len(raw)] * len(wanted)


def reverse(buffer: bytearray, start: int, end: int) -> None:
    """Reverses a range in place, block by block from both ends."""
    while end - start > 1:
        k = min(BLOCK, (end - start) // 2)
        left, right = buffer[start : start + k], buffer[end - k : end]
        left.reverse()
        right.reverse()
        buffer[start : start + k], buffer[end - k : end] = right, left
        start, end = start + k, end - k


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Lets the blocks [start, middle) and [middle, end) change places, by three reversals."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


def interleave(
    raw: bytes, form: str, first: int, second: int, sentinels: tuple[str, str, str] = SENTINELS
) -> bytes:
    """``raw``, cut before the code points ``first`` and ``second``, in the given form."""
    p, s, m = (mark.encode() for mark in sentinels)
    prefix, middle = byte_offsets(raw, first, second)
    buffer = bytearray(raw)
    buffer[middle:middle] = s
    buffer[prefix:prefix] = m
    buffer[0:0] = p
    from_middle = len(p) + prefix
    from_suffix = len(p) + middle + len(m)
    rotate(buffer, 0 if form == "spm" else from_middle, from_suffix, len(buffer))
    return bytes(buffer)


def restore(
    raw: bytes, form: str, sentinels: tuple[str, str, str] = SENTINELS
) -> bytes:
    """The text that ``interleave`` got; a plain one is returned as it is."""
    if form == "plain":
        return raw
    p, s, m = (mark.encode() for mark in sentinels)
    buffer = bytearray(raw)
    if form == "spm":
        rotate(buffer, 0, buffer.index(p), len(buffer))
    else:
        rotate(buffer, buffer.index(s), buffer.index(m), len(buffer))
    for mark in (p, s, m):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def _draw(group: int, doc_id: Column, seed: int) -> Column:
    """One of the 8-digit groups of the hex sha256 of the seed and an id, as a number."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digits, 8 * group - 7, 8), 16, 10).cast("long")



def transform(
    docs: DataFrame,
    seed: int = SEED,
    cut_percent: int = CUT_PERCENT,
    spm_percent: int = SPM_PERCENT,
    sentinels: tuple[str, str, str] = SENTINELS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars (null if plain), output."""
    check_sentinels(sentinels)

    @F.arrow_udf("binary")
    def moved(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, *cuts in columns:
            rows = zip(texts, *(column.to_pylist() for column in cuts), strict=True)
            yield pa.array(
                [f and interleave(t.as_py(), f, a, b, sentinels) for t, f, a, b in rows],
                pa.binary(),
            )

    key, whole = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    held = F.lit(False)
    for mark in sentinels:
        held = held | F.contains("text", F.lit(mark))
    rows = docs.select(
        key.alias("doc_id"),
        whole.alias("text"),
        *(_draw(k, key, seed).alias(f"h{k}") for k in range(1, 5)),
    ).withColumn("n", F.length("text").cast("long"))
    cut = rows.select(
        "doc_id",
        "text",
        "n",
        F.when((F.col("n") == 0) | held | (F.col("h3") % 100 >= cut_percent), "plain")
        .when(F.col("h4") % 100 < spm_percent, "spm")
        .otherwise("psm")
        .alias("form"),
        F.least(F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)).alias("first"),
        F.greatest(F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)).alias("second"),
    )
    # Plain texts stay in the JVM.
    taken = F.col("form") != "plain"
    placed = moved(
        F.when(taken, F.col("text").cast("binary")),
        F.when(taken, F.col("form")),
        F.col("first"),
        F.col("second"),
    )
    return cut.select(
        "doc_id",
        "n",
        "form",
        F.when(taken, F.col("first")).alias("prefix_chars"),
        F.when(taken, F.col("second") - F.col("first")).alias("middle_chars"),
        F.when(taken, placed.cast("string")).otherwise(F.col("text")).alias("output"),
    )


def restored(
    transformed: DataFrame, sentinels: tuple[str, str, str] = SENTINELS
) -> DataFrame:
    """``transformed`` with the text rebuilt from ``output`` and ``form`` as column ``restored``."""

    @F.arrow_udf("binary")
    def rebuilt(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for outputs, forms in columns:
            rows = zip(outputs, forms.to_pylist(), strict=True)
            yield pa.array([f and restore(o.as_py(), f, sentinels) for o, f in rows], pa.binary())

    taken = F.col("form") != "plain"
    text = rebuilt(
        F.when(taken, F.col("output").cast("binary")), F.when(taken, F.col("form"))
    )
    return transformed.withColumn(
        "restored", F.when(taken, text.cast("string")).otherwise(F.col("output"))
    )


def digest(rebuilt: DataFrame) -> DataFrame:
    """``rebuilt`` with checksums in place of the texts."""
    return rebuilt.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )
