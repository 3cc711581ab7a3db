"""Token counts with a shortcut for strings that are one token.

Before any text is read, each string of the vocabulary is merged alone: those that end as
just their own token are the proven ones (``prove``).  A piece of the pre-tokeniser that equals
a proven string counts as one token without a merge; only the other pieces are merged.  The
proven strings are bounded by the vocabulary and are the only thing that is broadcast.

Texts are cut into pieces by the tokeniser's own normaliser and pre-tokeniser.  A run of text
in which every character lies in ``PLAIN`` is cut at white space instead, where each piece ends:
a word that is a proven string counts one, other words are cut by an equal, faster expression.
The tests hold both ways against the tokeniser.  Special strings inside a text count as one token each,
as the tokeniser does by default.

Null text is empty: 0 bytes, 0 tokens.  Long texts are taken whole, in slabs that end
before white space, where no piece and no composed character reaches across; a single word of any
length is one slab.  Repeated rows are counted each on its own, an empty table gives no rows, and
further columns are not read.  Rows are independent: no shuffle, so hot sources need no care.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.packing import _byte_letters

LIMIT = 2048
#: Characters that are cut into pieces at a time.
SLAB = 1 << 18
#: Counted pieces and words that a task remembers of each kind; beyond, it starts over.
REMEMBERED = 1 << 17
#: Longer ones are counted each time.
LONGEST_REMEMBERED = 64

# Fixed value: the normaliser and pre-tokeniser that the fast expression stands for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters that are composed, have lower case of one character, and are of known kinds: ASCII
#: without the four separators, the letters of Latin-1 and Latin Extended-A but for the dotted I,
#: and general punctuation.
PLAIN = "\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-įı-ſ‐-‧"
_LETTERS = "a-z\xdf-\xf6\xf8-\xffā-ſ"
_UNUSUAL = re.compile(f"[^{PLAIN}]")
_PIECES = re.compile(
    rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^{_LETTERS}0-9\x20\x09-\x0d]+"
)
_SPACE = re.compile(r"[\x20\x09-\x0d]")


@lru_cache(maxsize=1)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return {k: spec[k] for k in ("added_tokens", "normalizer", "pre_tokenizer")} | {
        "suffix": spec["model"].get("end_of_word_suffix") or ""
    }


def special_strings(path: str) -> list[str]:
    """Strings that the tokeniser takes out of a text before anything else."""
    found = _spec(path)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in found):
        raise ValueError("added tokens that look at their neighbours are not supported")
    return sorted((t["content"] for t in found), key=len, reverse=True)


def is_plain_rule(path: str) -> bool:
    """Whether the tokeniser cuts texts by the rule that the fast expression stands for."""
    spec = _spec(path)
    steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and spec["normalizer"]["normalizers"][1]["content"] == " "
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": PATTERN}
        and cuts[0]["behavior"] == "Removed"
        and cuts[0]["invert"]
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
    )


def prove(path: str) -> list[str]:
    """Strings, in the vocabulary's byte letters, whose merging ends as one token of their own."""
    coder, suffix = tokenizer(path), _spec(path)["suffix"]
    specials = set(special_strings(path))
    proven = []
    for token, number in coder.get_vocab().items():
        letters = token.removesuffix(suffix) if suffix else token
        if token in specials or not letters or not token.endswith(suffix):
            continue
        if [t.id for t in coder.model.tokenize(letters)] == [number]:
            proven.append(letters)
    return sorted(proven)


class PieceCounts(dict):
    """Tokens of a string: one for proven ones, by ``count`` for all others."""

    def __init__(self, proven: dict[str, int], count: Callable[[str], int]) -> None:
        super().__init__(proven)
        self.proven, self.count = proven, count

    def __missing__(self, piece: str) -> int:
        count = self.count(piece)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= len(self.proven) + REMEMBERED:
                self.clear()
                self.update(self.proven)
            self[piece] = count
        return count


def slabs(text: str, size: int = SLAB) -> Iterator[str]:
    """``text`` in parts of at least ``size`` characters that each end before white space."""
    at = 0
    while len(text) - at > size:
        space = _SPACE.search(text, at + size)
        if not space:
            break
        yield text[at : space.start()]
        at = space.start()
    yield text[at:] if at else text


class Counter:
    """Counts the tokens of texts as the tokeniser at ``path`` encodes them."""

    def __init__(self, path: str, proven: list[str]) -> None:
        self.coder = tokenizer(path)
        specials = special_strings(path)
        self.specials = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.plain_rule = is_plain_rule(path)
        tokenize = self.coder.model.tokenize
        byte_of = _byte_letters()
        letter_of = {b: c for c, b in byte_of.items()}
        table = [letter_of[b] for b in range(256)]
        texts = {}
        for letters in proven:
            try:
                texts[bytes(byte_of[c] for c in letters).decode()] = 1
            except UnicodeDecodeError:
                continue  # part of a character; never a whole piece
        self.by_text = PieceCounts(
            texts, lambda piece: len(tokenize("".join([table[b] for b in piece.encode()])))
        )
        # A proven string may still be cut, as two digits are.
        self.by_word = PieceCounts(
            {t: 1 for t in texts if _PIECES.findall(t) == [t]},
            lambda word: sum(map(self.by_text.__getitem__, _PIECES.findall(word))),
        )
        self.by_letters = PieceCounts(
            dict.fromkeys(proven, 1), lambda letters: len(tokenize(letters))
        )

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.specials is None:
            return self._count_ordinary(text)
        parts = self.specials.split(text)
        return len(parts) - 1 + sum(map(self._count_ordinary, parts))

    def _count_ordinary(self, text: str) -> int:
        total = 0
        for slab in slabs(text):
            if self.plain_rule and not _UNUSUAL.search(slab):
                total += sum(map(self.by_word.__getitem__, slab.lower().split()))
                continue
            if self.coder.normalizer is not None:
                slab = self.coder.normalizer.normalize_str(slab)
            cut = self.coder.pre_tokenizer.pre_tokenize_str(slab)
            total += sum(self.by_letters[letters] for letters, _ in cut)
        return total


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = LIMIT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``)."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    proven = docs.sparkSession.sparkContext.broadcast(prove(tokenizer_path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer_path, proven.value)
        for batch in batches:
            texts = batch.column(1)
            tokens = [counter.count(t.as_py()) for t in texts]
            sizes = pc.binary_length(texts).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(counted, f"doc_id {id_type}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
