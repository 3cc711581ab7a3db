"""Quality classifier by co-training.

Two views of a document have a classifier each: the text view sees how characters and words are
used, the metadata view sees language, source and length.  Over some rounds each one labels
the unlabelled documents it is surest of for the other one's training set.  Both are then
calibrated on labelled documents held back, and a document's score joins the two calibrated
log-odds (less the prior, which both contain).

Fitting uses bounded samples, chosen by a hash of the id: at most ``most_labelled`` labelled and
``most_pool`` unlabelled documents; their features (not their texts) come to the driver.
Scoring covers all documents as a projection without a shuffle; the model has a few hundred
numbers.  So hot sources, copies and long texts need no care.

Null text counts as empty, null language or source as a value of its own, null lengths as
zero.  Labels that are null or not 0 or 1 are not used; of several labels of one id the
smallest counts, and of rows that share an id one is learnt from.  Without labels of both classes each document gets the share of good ones among
the labels there are (1 if there are none).  Repeated rows get equal scores.  Further columns are
carried along; the added columns are ``text_score``, ``meta_score`` and ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm import text_arrays
from earshot.llm.common import lean_rows
from earshot.llm.quality_rules import STOP_WORDS

MOST_LABELLED = 4000
MOST_POOL = 4000
ROUNDS = 4
#: A view labels documents for the other one from this probability on.
CONFIDENT = 0.97
#: ... and at most this share of the pool in one round.
ROUND_SHARE = 0.1
#: Bytes of text looked at together: a byte has some ten numbers of eight bytes in between.
CHUNK_BYTES = 1 << 18
#: Hash buckets of the languages and sources.
BUCKETS = 32
#: A document is rejected below this score, i.e. if it is far more likely bad than good: a clean
#: document lost costs more than a bad one kept.
GOOD = 0.3

# Character classes: other, small letter, capital, digit, blank, newline, sentence mark, symbol,
# byte of a letter beyond ASCII.
_CLASSES = 9
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _bytes, _class in (
    (b"abcdefghijklmnopqrstuvwxyz", 1),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2),
    (b"0123456789", 3),
    (b" \t\r\x0b\x0c", 4),
    (b"\n", 5),
    (b".,;:!?'\"()-", 6),
    (b"#*$%&|<>@^~_=+/\\[]{}`", 7),
    (bytes(range(128, 256)), 8),
):
    _CLASS_OF[list(_bytes)] = _class
_STOP_HASHES = np.array(sorted(text_arrays.hash_of(w) for w in set(STOP_WORDS)), np.uint64)
N_TEXT = _CLASSES * _CLASSES + 7
N_META = 2 * BUCKETS + 4


def text_features(column: pa.Array) -> np.ndarray:
    """One row of numbers for each text, whatever its length.

    Shares of the pairs of character classes, and: logarithm of the word count, mean word
    length, share of words equal to the one before, share of different words, of stop words, of
    lines equal to an earlier one, and whether there is a word at all.
    """
    out = np.zeros((len(column), N_TEXT))
    for texts in text_arrays.chunks(column, CHUNK_BYTES):
        n, data = len(texts.starts), texts.data
        part = np.zeros((n, N_TEXT))
        if len(data):
            classes = _CLASS_OF[data]
            row = np.repeat(np.arange(n), texts.ends - texts.starts)
            pair = row[:-1] * _CLASSES**2 + classes[:-1] * _CLASSES + classes[1:]
            pair = pair[row[:-1] == row[1:]]
            counts = np.bincount(pair, minlength=n * _CLASSES**2).reshape(n, -1)
            part[:, : _CLASSES**2] = counts / np.maximum(counts.sum(1, keepdims=True), 1)
            first, behind, of = text_arrays.words(texts)
            hashes = text_arrays.word_hashes(texts, first, behind)
            n_words = np.bincount(of, minlength=n)
            some = np.maximum(n_words, 1)
            same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
            different = np.zeros(n)
            if len(of):
                order = np.lexsort((hashes, of))
                h, o = hashes[order], of[order]
                new = np.ones(len(o), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                different = np.bincount(o[new], minlength=n)
            stop = np.isin(hashes, _STOP_HASHES)
            part[:, -7] = np.log1p(n_words)
            part[:, -6] = np.bincount(of, weights=behind - first, minlength=n) / some
            part[:, -5] = np.bincount(of[1:][same], minlength=n) / some
            part[:, -4] = different / some
            part[:, -3] = np.bincount(of[stop], minlength=n) / some
            part[:, -2] = _repeated_lines(texts)
            part[:, -1] = n_words > 0
        out[texts.first : texts.first + n] = part
    return out


def _repeated_lines(texts: text_arrays.Texts) -> np.ndarray:
    """The share of lines that equal an earlier line of their text."""
    n, data = len(texts.starts), texts.data
    edge = np.zeros(len(data) + 1, bool)
    edge[np.flatnonzero(data == 10)] = True
    edge[texts.starts[texts.starts < texts.ends]] = True
    first = np.flatnonzero(edge[:-1])
    behind = np.append(first[1:], len(data))
    of = np.searchsorted(texts.ends, first, side="right")
    first = first + (data[first] == 10)
    full = first < behind
    first, behind, of = first[full], behind[full], of[full]
    if not len(first):
        return np.zeros(n)
    hashes = text_arrays.word_hashes(texts, first, behind)
    order = np.lexsort((hashes, of))
    h, o = hashes[order], of[order]
    again = np.zeros(len(o), bool)
    again[1:] = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[again], minlength=n) / np.maximum(np.bincount(o, minlength=n), 1)


def meta_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """One row of numbers: hashed language and source, and length on two scales."""
    n = len(lang)
    out = np.zeros((n, N_META))
    for k, column in enumerate((lang, source)):
        coded = column.dictionary_encode()
        bucket = np.array(
            [text_arrays.hash_of(v) % BUCKETS if v else 0 for v in coded.dictionary.to_pylist()] or [0]
        )
        index = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.where(index >= 0, bucket[np.maximum(index, 0)], BUCKETS - 1)
        out[np.arange(n), k * BUCKETS + at] = 1
    size = np.maximum(n_chars.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False), 0)
    logs = np.log1p(np.nan_to_num(size))
    out[:, -4:] = np.stack([logs, logs**2 / 10, size < 200, size > 20_000], axis=1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Linear:
    """Logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    #: Slope and offset of the calibration.
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -10, 10)
        return z @ self.weights[:-1] + self.weights[-1]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(x) + self.offset, -30, 30)


def _newton(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (the last one constant) of ridge logistic regression."""
    full = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(full.shape[1]), np.full(full.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        p = _sigmoid(full @ w)
        gradient = full.T @ (p - y) + penalty * w
        hessian = (full * (p * (1 - p) + 1e-6)[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Linear:
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    return Linear(mean, scale, _newton(np.clip((x - mean) / scale, -10, 10), y, ridge))


def calibrate(model: Linear, x: np.ndarray, y: np.ndarray) -> None:
    """Platt scaling with smoothed targets."""
    good, bad = y.sum(), len(y) - y.sum()
    targets = np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    model.slope, model.offset = _newton(model.raw(x)[:, None], targets, 1e-3)


@dataclass
class CoTrained:
    text: Linear | None
    meta: Linear | None
    prior: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, ...]:
        """Scores of the text view, the metadata view, and both together."""
        if self.text is None or self.meta is None:
            same = np.full(len(text), self.prior)
            return same, same, same
        a, b = self.text.log_odds(text), self.meta.log_odds(meta)
        prior = np.log(self.prior / (1 - self.prior))
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - prior)


def co_train(
    text: np.ndarray,
    meta: np.ndarray,
    labels: np.ndarray,
    pool_text: np.ndarray,
    pool_meta: np.ndarray,
    rounds: int = ROUNDS,
) -> CoTrained:
    """Both views from labelled rows (a fourth of them calibrates) and an unlabelled pool."""
    known = len(labels)
    prior = float(labels.mean()) if known else 1.0
    held = np.arange(known) % 4 == 3
    if not known or min(labels.sum(), known - labels.sum()) < 4 or len(set(labels[held])) < 2 or len(set(labels[~held])) < 2:
        return CoTrained(None, None, prior)
    views, pools = (text, meta), (pool_text, pool_meta)
    taught = [(v[~held], labels[~held]) for v in views]
    models = [fit_linear(*t) for t in taught]
    free = [np.ones(len(pool_text), bool), np.ones(len(pool_text), bool)]
    for _ in range(rounds):
        for teacher, learner in ((0, 1), (1, 0)):
            if not len(pool_text):
                continue
            p = _sigmoid(models[teacher].raw(pools[teacher]))
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                most = int(ROUND_SHARE * len(p) * (prior if label else 1 - prior))
                at = np.flatnonzero(free[learner] & (sure >= CONFIDENT))
                at = at[np.argsort(-sure[at], kind="stable")][:most]
                free[learner][at] = False
                x, y = taught[learner]
                taught[learner] = (
                    np.vstack([x, pools[learner][at]]),
                    np.concatenate([y, np.full(len(at), label)]),
                )
        models = [fit_linear(*t) for t in taught]
    for model, view in zip(models, views, strict=True):
        calibrate(model, view[held], labels[held])
    return CoTrained(models[0], models[1], prior)


def _features(docs: DataFrame) -> DataFrame:
    """(doc_id, text_view, meta_view) of documents."""

    @F.arrow_udf("array<double>")
    @lean_rows
    def of_text(texts: pa.Array) -> pa.Array:
        return pa.array(list(text_features(texts)), pa.list_(pa.float64()))

    @F.arrow_udf("array<double>")
    @lean_rows
    def of_meta(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        return pa.array(list(meta_features(lang, source, n_chars)), pa.list_(pa.float64()))

    return docs.select(
        "doc_id", of_text("text").alias("text_view"), of_meta(*_meta_columns()).alias("meta_view")
    )


def _meta_columns() -> list:
    return [F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("double")]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most_labelled: int = MOST_LABELLED,
    most_pool: int = MOST_POOL,
    rounds: int = ROUNDS,
) -> CoTrained:
    """A model from ``docs`` (doc_id, text, lang, source, n_chars) and ``labels`` (doc_id, quality)."""
    order = F.xxhash64(F.lit(17), "doc_id")
    usable = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    # Smallest hashes first: bounded samples that do not depend on the partitioning.
    chosen = usable.orderBy(order, "doc_id").limit(most_labelled)
    free = docs.where(F.col("doc_id").isNotNull()).select("doc_id")
    candidates = free.orderBy(order, "doc_id").limit(2 * (most_labelled + most_pool))
    picked = (
        candidates.join(usable.select("doc_id", F.lit(True).alias("known")), "doc_id", "left")
        .where("known IS NULL")
        .select("doc_id")
        .distinct()
        .orderBy(order, "doc_id")
        .limit(most_pool)
        .select("doc_id", F.lit(None).cast("int").alias("quality"))
    )
    wanted = chosen.select("doc_id", F.col("quality").cast("int").alias("quality")).union(picked)
    # At most most_labelled + most_pool ids.
    sample = docs.join(F.broadcast(wanted), "doc_id")
    rows = (
        _features(sample.select("doc_id", "text", *_named_meta(sample)))
        .join(F.broadcast(wanted), "doc_id")
        .select("doc_id", "quality", "text_view", "meta_view")
        .dropDuplicates(["doc_id"])
        .collect()
    )
    rows.sort(key=lambda r: (hash_order(r["doc_id"]), r["doc_id"]))
    labelled = [r for r in rows if r["quality"] is not None]
    pool = [r for r in rows if r["quality"] is None]

    def matrix(part: list, name: str, width: int) -> np.ndarray:
        return np.array([r[name] for r in part]).reshape(len(part), width)

    return co_train(
        matrix(labelled, "text_view", N_TEXT),
        matrix(labelled, "meta_view", N_META),
        np.array([float(r["quality"]) for r in labelled]),
        matrix(pool, "text_view", N_TEXT),
        matrix(pool, "meta_view", N_META),
        rounds,
    )


def hash_order(doc_id: int) -> int:
    """A fixed order without a pattern, so that the part held back is a random one."""
    return int(text_arrays.mix(np.array([doc_id], np.int64).view(np.uint64))[0])


def _named_meta(docs: DataFrame) -> list:
    return [F.col(c) for c in ("lang", "source", "n_chars")]


def score_documents(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``docs`` with ``text_score``, ``meta_score`` and ``score`` (probability of being good)."""

    @F.arrow_udf("struct<text_score: double, meta_score: double, score: double>")
    @lean_rows
    def scored(texts: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        found = model.scores(text_features(texts), meta_features(lang, source, n_chars))
        return pa.StructArray.from_arrays(
            [pa.array(x) for x in found], names=["text_score", "meta_score", "score"]
        )

    added = ("text_score", "meta_score", "score")
    names = [c for c in docs.columns if c not in added]
    both = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("d"),
        scored(F.col("text"), *_meta_columns()).alias("s"),
    )
    return both.select(*[F.col(f"d.`{c}`").alias(c) for c in names], "s.*")
