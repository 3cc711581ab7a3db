"""Packing by power-of-two decomposition.

A document of n ids is cut into as many pieces of the longest length as fit and then one
piece for each binary digit of the rest, longest first.  A sequence is one piece, so it never
crosses documents, is never padded, and sequences of equal length form one bucket
(column ``bucket``, the exponent of the length); a trainer draws a batch from one bucket.

Rows are independent: no shuffle, so hot sources and copies need no care.  Sequence numbers
come from the partition and the row within it, which a task that runs again repeats.

Null text is empty; each document ends with ``end_id``, so even an empty one has one piece.
Repeated rows (also repeated ids) are packed each on its own.  Further columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm import text_arrays
from earshot.llm.common import lean

LONGEST = 2048
END_ID = 1
#: Bytes of text whose different words are encoded together.
CHUNK_BYTES = 1 << 20

# Fixed value: the pre-tokeniser's pattern of the byte-level vocabularies.
PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)

#: Bytes that are white space, or may begin or end a no-break space.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x09, 0x0A, 0x0D, 0x20, 0xA0, 0xC2]] = True
#: Bytes of characters that are left to the tokeniser itself: controls and what is not Latin.
_OTHER = np.zeros(256, dtype=bool)
_OTHER[[*range(9), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F, *range(0xC9, 256)]] = True


class Encoder:
    """Token ids of many texts, with each different word of a chunk encoded once.

    Byte-level BPE treats each piece of the pre-tokeniser on its own, and a blank before
    something else than white space always begins a piece.  So texts are cut at blanks, the
    different words of a chunk (told apart by 64-bit hashes) are encoded together, and the ids
    are put back in order.  Texts with characters outside Latin, with blanks inside a run of
    white space, or with a special string, which is one id, go to the tokeniser itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {token["content"] for token in spec["added_tokens"]}
        self.special = [content.encode() for content in special]
        byte_of = _byte_letters()
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        # The same vocabulary and order of merges; much faster on many short pieces.
        self.bpe = tiktoken.Encoding(
            "pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.bytes_of = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.bytes_of[rank] = len(token)

    def whole(self, text: str) -> np.ndarray:
        """By the tokeniser alone."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For chunks of rows: the first row, all ids, and where those of each row begin."""
        for texts in text_arrays.chunks(column, CHUNK_BYTES):
            yield texts.first, *self._chunk(texts, end_id)

    def _chunk(self, texts: text_arrays.Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        data, n = texts.data, len(texts.starts)
        odd = self._left_to_tokenizer(texts)
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[np.flatnonzero(data == 0x20)] = True
        filled = texts.starts[texts.starts < texts.ends]
        begins[filled] = True
        first = np.flatnonzero(begins[:-1])
        behind = np.append(first[1:], len(data))
        row = np.searchsorted(texts.ends, first, side="right")
        taken = ~odd[row]
        first, behind, row = first[taken], behind[taken], row[taken]
        hashes = text_arrays.word_hashes(texts, first, behind, text_arrays.EXACT_CODE)
        _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        pool, lengths_of = self._words(data, first[sample], behind[sample])
        pool_at = np.concatenate([[0], np.cumsum(lengths_of)])
        # A last part of each row is its end; rows left to the tokeniser have a part before it.
        extra = [self.whole(bytes(data[texts.starts[r] : texts.ends[r]]).decode()) for r in np.flatnonzero(odd)]
        extra.append(np.array([end_id], np.uint32))
        extra_at = len(pool) + np.concatenate([[0], np.cumsum([len(x) for x in extra])])
        ids = np.concatenate([pool, *extra]).astype(np.uint32)
        odd_rows = np.flatnonzero(odd)
        part_row = np.concatenate([row, odd_rows, np.arange(n)])
        part_at = np.concatenate([pool_at[which], extra_at[:-2], np.full(n, extra_at[-2])])
        part_n = np.concatenate(
            [lengths_of[which], np.diff(extra_at)[:-1], np.ones(n, np.int64)]
        ).astype(np.int64)
        order = np.argsort(part_row, kind="stable")
        part_row, part_at, part_n = part_row[order], part_at[order], part_n[order]
        to = np.cumsum(part_n) - part_n
        out = ids[np.repeat(part_at - to, part_n) + np.arange(int(part_n.sum()))]
        per_row = np.bincount(part_row, weights=part_n, minlength=n).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_row)])

    def _left_to_tokenizer(self, texts: text_arrays.Texts) -> np.ndarray:
        data = texts.data
        odd = np.zeros(len(texts.starts), dtype=bool)
        if not len(data):
            return odd
        bad = _OTHER[data]
        # The controls U+0080 to U+009F.
        bad[1:] |= (data[:-1] == 0xC2) & (data[1:] < 0xA0)
        blank, space = data == 0x20, _SPACE[data]
        before, behind = np.zeros(len(data), bool), np.ones(len(data), bool)
        before[1:], behind[:-1] = space[:-1], space[1:]
        begin, last = texts.starts[texts.starts < texts.ends], texts.ends[texts.starts < texts.ends] - 1
        before[begin], behind[last] = False, True
        bad |= blank & before & behind
        odd[np.searchsorted(texts.ends, np.flatnonzero(bad), side="right")] = True
        raw = data.tobytes()
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                # Across two texts it only sends one more text to the tokeniser.
                odd[np.searchsorted(texts.ends, at, side="right")] = True
                at = raw.find(special, at + 1)
        return odd

    def _words(
        self, data: np.ndarray, first: np.ndarray, behind: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given words one after the other, and how many each has."""
        counts = np.zeros(len(first), dtype=np.int64)
        sizes = behind - first
        second = data[np.minimum(first + 1, len(data) - 1)] if len(data) else data
        together = (data[first] == 0x20) & (sizes > 1) & ~_SPACE[second] if len(first) else sizes > 0
        joined, at = np.flatnonzero(together), np.cumsum(sizes[together])
        raw = data[
            np.repeat(first[joined] - (at - sizes[joined]), sizes[joined]) + np.arange(int(at[-1]) if len(at) else 0)
        ]
        ids = self.bpe.encode_to_numpy(raw.tobytes().decode()) if len(raw) else np.zeros(0, np.uint32)
        ends = np.cumsum(self.bytes_of[ids])
        cuts = np.searchsorted(ends, at, side="left") + 1
        counts[joined] = np.diff(np.concatenate([[0], cuts])) if len(joined) else 0
        alone = {
            int(i): self.bpe.encode_ordinary(data[first[i] : behind[i]].tobytes().decode())
            for i in np.flatnonzero(~together)
        }
        for i, found in alone.items():
            counts[i] = len(found)
        out = np.zeros(int(counts.sum()), dtype=np.uint32)
        at_of = np.cumsum(counts) - counts
        n_joined = counts[joined]
        to = np.repeat(at_of[joined] - (np.cumsum(n_joined) - n_joined), n_joined) + np.arange(len(ids))
        out[to] = ids
        for i, found in alone.items():
            out[at_of[i] : at_of[i] + len(found)] = found
        return out, counts


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and tokeniser."""
    return Encoder(path)


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """The piece lengths of a document of ``n`` ids, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [
        1 << k for k in reversed(range(longest.bit_length())) if rest >> k & 1
    ]


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    longest: int = LONGEST,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset, bucket."""
    if longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    id_type = docs.schema[doc_id].dataType.simpleString()

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            for row, ids, at in encode(batch.column(1), end_id):
                raw, counts = ids.astype("<u4").tobytes(), np.diff(at)
                cuts = [lengths(int(n), longest) for n in counts]
                sizes = np.array([size for doc in cuts for size in doc], np.int64)
                taken = np.repeat(np.arange(len(cuts)), [len(doc) for doc in cuts])
                place = np.cumsum(sizes) - sizes
                pieces = [raw[4 * p : 4 * (p + n)] for p, n in zip(place, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + taken)),
                        pa.array(place - at[taken]),
                        pa.array(sizes),
                        pa.array(pieces, pa.binary()),
                        pa.array(counts[taken]),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    packed = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")
    ).mapInArrow(
        cut, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long"
    )
    return packed.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.round(F.log2("length")).cast("int").alias("bucket"),
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder for each length, so that a batch can be read from sequences of one length."""
    packed.write.partitionBy("bucket").parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    """``packed`` with the checksum of the ids in place of the ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
