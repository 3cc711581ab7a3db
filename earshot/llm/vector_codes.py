"""Codes of vectors by parts, with codebooks fitted by dual-tree Lloyd rounds.

Components become the integers floor(256 * x), and a vector is cut into ``PARTS`` equal consecutive
parts, each with a codebook of ``ENTRIES`` entries.  A round assigns each part to the nearest entry and
moves each entry to the floor of its parts' mean.

Assignment walks two trees at once: one over a chunk's parts, one over the entries, both split
at the median of the widest component.  A pair of nodes is dropped if even its nearest
corners lie farther apart than the farthest corners of another pair of the same part node.  A
part node with one entry left is assigned whole, by its cached sum and count; only leaves
that stay uncertain compute distances.  All numbers are integers, so bounds, ties (lower index)
and means are exact, however rows are partitioned.

Spark runs a round as one pass: each task returns sums and counts per entry, which are added
by key.  Codebooks are ``ENTRIES`` times a vector's length; they are the only thing that comes
to the driver or is broadcast, at most ``MOST_BYTES`` at a time.

Vectors that are null or hold null or non-finite components are dropped.  Each vector length
has codebooks of its own; a length that ``PARTS`` does not divide is filled up with zeros.
Codebooks start as the vectors of the smallest ids (null last, then by components); with fewer
vectors they have fewer entries.  Components beyond ``MOST`` / 256 count as that.  Repeated
rows are coded each on its own, an empty table gives no rows, a null label is a label like any
other, and further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.session import scratch_path

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Parts in a leaf, and vectors whose parts make one tree.
LEAF_ROWS = 16
CHUNK_ROWS = 16_384
#: Largest integer component; squared distances of 4,096 components then fit 64 bits.
MOST = 1 << 24
#: Bytes of codebooks that are fitted and broadcast together.
MOST_BYTES = 32 << 20


class Tree:
    """Rows of integers, ordered so that each level's nodes are runs of equal length.

    Level l has 2**l nodes; node i has rows ``cuts[l][i]`` to ``cuts[l][i + 1]`` of ``order``
    and children 2i and 2i + 1.
    """

    def __init__(self, rows: np.ndarray, levels: int) -> None:
        n = len(rows)
        self.levels = levels
        self.order = np.arange(n)
        self.cuts = [(n * np.arange(2**k + 1)) >> k for k in range(levels + 1)]
        self.low, self.high = [], []
        for cut in self.cuts:
            self.rows = rows[self.order]
            at = np.minimum(cut[:-1], n - 1)
            low = np.minimum.reduceat(self.rows, at)
            high = np.maximum.reduceat(self.rows, at)
            self.low.append(low)
            self.high.append(high)
            if len(self.low) <= levels:
                node = np.repeat(np.arange(len(at)), np.diff(cut))
                along = self.rows[np.arange(n), np.argmax(high - low, axis=1)[node]]
                self.order = self.order[np.lexsort((along, node))]

    def sums(self) -> np.ndarray:
        """Sums of the first 0, 1, ... rows; a node's sum is the difference of two."""
        out = np.zeros((len(self.rows) + 1, self.rows.shape[1]), np.int64)
        np.cumsum(self.rows, axis=0, out=out[1:])
        return out


def _levels(n: int, leaf: int) -> int:
    """Levels after which nodes have at most ``leaf`` rows."""
    return max(0, (-(-n // leaf) - 1).bit_length())


class Entries:
    """A codebook as a tree; equal entries count as the one of the lowest index."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        kept = np.unique(entries, axis=0, return_index=True)[1] if entries.shape[1] else np.array([0])
        kept = np.sort(kept)
        self.tree = Tree(entries[kept], _levels(len(kept), 1))
        self.index = kept[self.tree.order]


def _nearest_corners(a: Tree, la: int, i: np.ndarray, b: Tree, lb: int, j: np.ndarray):
    """Squared distances of the nearest and of the farthest corners of pairs of nodes."""
    below, above = b.low[lb][j] - a.high[la][i], a.low[la][i] - b.high[lb][j]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(-below, -above)
    return (near * near).sum(axis=1), (far * far).sum(axis=1)


def assign(points: np.ndarray, book: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For integer rows: index of the nearest entry of each; sums and counts for each entry."""
    n, width = points.shape
    index = np.zeros(n, np.int64)
    sums = np.zeros(book.entries.shape, np.int64)
    counts = np.zeros(len(book.entries), np.int64)
    if not width:
        counts[0] = n
        return index, sums, counts
    tree, others = Tree(points, _levels(n, LEAF_ROWS)), book.tree
    cached = tree.sums()
    node, entry = np.zeros(1, np.int64), np.zeros(1, np.int64)
    level = depth = 0
    while True:
        near, far = _nearest_corners(tree, level, node, others, depth, entry)
        first = np.flatnonzero(np.diff(node, prepend=-1))
        bound = np.minimum.reduceat(far, first)
        left = np.diff(np.append(first, len(node)))
        kept = near <= np.repeat(bound, left)
        node, entry = node[kept], entry[kept]
        if depth == others.levels:
            # One entry left: the whole node is its.
            first = np.flatnonzero(np.diff(node, prepend=-1))
            alone = np.diff(np.append(first, len(node))) == 1
            sure = first[alone]
            start, end = tree.cuts[level][node[sure]], tree.cuts[level][node[sure] + 1]
            found = book.index[others.cuts[depth][entry[sure]]]
            np.add.at(sums, found, cached[end] - cached[start])
            np.add.at(counts, found, end - start)
            size = end - start
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            index[tree.order[np.repeat(start, size) + within]] = np.repeat(found, size)
            rest = np.ones(len(node), bool)
            rest[sure] = False
            node, entry = node[rest], entry[rest]
        if not len(node) or (level == tree.levels and depth == others.levels):
            break
        if depth < others.levels:
            depth += 1
            node, entry = np.repeat(node, 2), (2 * entry[:, None] + [0, 1]).ravel()
            filled = others.cuts[depth][entry] < others.cuts[depth][entry + 1]
            node, entry = node[filled], entry[filled]
        if level < tree.levels:
            level += 1
            node, entry = np.concatenate([2 * node, 2 * node + 1]), np.tile(entry, 2)
            order = np.argsort(node, kind="stable")
            node, entry = node[order], entry[order]
    if len(node):
        row, nearest = _uncertain(tree, node, book, entry)
        index[tree.order[row]] = nearest
        np.add.at(sums, nearest, tree.rows[row])
        np.add.at(counts, nearest, 1)
    return index, sums, counts


def _uncertain(
    tree: Tree, node: np.ndarray, book: Entries, entry: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of leaves with several entries left, and the nearest of these entries."""
    cuts = tree.cuts[tree.levels]
    found = book.index[book.tree.cuts[book.tree.levels][entry]]
    first = np.flatnonzero(np.diff(node, prepend=-1))
    left = np.diff(np.append(first, len(node)))
    leaves = node[first]
    size = cuts[leaves + 1] - cuts[leaves]
    row = np.repeat(cuts[leaves] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    # Each row of a leaf with each entry left there, row by row.
    per_row, from_pair = np.repeat(left, size), np.repeat(first, size)
    begin = np.cumsum(per_row) - per_row
    pair = np.repeat(from_pair - begin, per_row) + np.arange(int(per_row.sum()))
    apart = tree.rows[np.repeat(row, per_row)] - book.entries[found[pair]]
    distance = np.einsum("ij,ij->i", apart, apart)
    least = np.minimum.reduceat(distance, begin)
    nearest = np.where(distance == np.repeat(least, per_row), found[pair], len(book.entries))
    return row, np.minimum.reduceat(nearest, begin)


def integers(column: pa.Array) -> np.ndarray:
    """Vectors of one length, at least one, as rows of integer components."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(256 * values), -MOST, MOST).astype(np.int64)
    return scaled.reshape(len(column), -1)


def cut(rows: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """(vector, part, position) of vectors, filled up with zeros to a multiple of ``parts``."""
    rows = np.pad(rows, ((0, 0), (0, -rows.shape[1] % parts)))
    return rows.reshape(len(rows), parts, rows.shape[1] // parts)


def _by_length(vectors: pa.Array, limit: int = CHUNK_ROWS) -> Iterator[tuple[int, np.ndarray]]:
    """(length, places in the column) for chunks of vectors of one length."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        for at in range(0, len(places), limit):
            yield int(length), places[at : at + limit]


def _finite(vectors: DataFrame, vec_id: str, vector: str, label: str | None) -> DataFrame:
    kept = F.col(f"`{vector}`")
    label_of = F.col(f"`{label}`") if label else F.lit(None).cast("string")
    finite = F.forall(
        kept, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vectors.where(kept.isNotNull() & finite).select(
        F.col(f"`{vec_id}`").alias("vec_id"),
        kept.cast("array<double>").alias("vector"),
        label_of.alias("label"),
    )


def smallest(rows: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """For each vector length, the vectors of the smallest ids, numbered from zero.

    Each task hands on at most ``entries`` vectors of a length, so no task sorts the table.
    """
    schema = rows.select("vec_id", "vector").schema

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            for length, places in _by_length(vectors):
                order = pc.sort_indices(ids.take(pa.array(places)), null_placement="at_end")
                last = ids[places[order[min(entries, len(order)) - 1].as_py()]].as_py()
                picked = [
                    (i is None, i, vectors[p].as_py())
                    for p, i in zip(places, ids.take(pa.array(places)).to_pylist(), strict=True)
                    if last is None or (i is not None and i <= last)
                ]
                known = found.get(length, []) + picked
                known.sort(key=lambda x: (x[0], 0 if x[0] else x[1], x[2]))
                found[length] = known[:entries]
        rows = [(i, v) for known in found.values() for _, i, v in known]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in rows], batch.column(0).type),
                    pa.array([v for _, v in rows], batch.column(1).type),
                ],
                names=["vec_id", "vector"],
            )

    least_rows = rows.select("vec_id", "vector").mapInArrow(least, schema)
    length = F.size("vector").alias("length")
    first = Window.partitionBy("length").orderBy(F.col("vec_id").asc_nulls_last(), "vector")
    return (
        least_rows.select(length, "vec_id", "vector")
        .withColumn("entry", F.row_number().over(first) - 1)
        .where(F.col("entry") < entries)
    )


def partial_sums(rows: DataFrame, books: dict[int, np.ndarray]) -> dict[int, tuple]:
    """By length: sums (part, entry, position) and counts (part, entry) of the assigned parts."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {n: [Entries(e) for e in book] for n, book in shared.value.items()}
        sums = {n: np.zeros(book.shape, np.int64) for n, book in shared.value.items()}
        counts = {n: np.zeros(book.shape[:2], np.int64) for n, book in shared.value.items()}
        for batch in batches:
            for n, places in _by_length(batch.column(0)):
                parts = cut(integers(batch.column(0).take(pa.array(places))), len(trees[n]))
                for k, book in enumerate(trees[n]):
                    _, more, many = assign(np.ascontiguousarray(parts[:, k]), book)
                    sums[n][k] += more
                    counts[n][k] += many
        for n, many in counts.items():
            part, entry = np.nonzero(many)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(part), n)),
                    pa.array(part),
                    pa.array(entry),
                    pa.array(many[part, entry]),
                    pa.array(list(sums[n][part, entry]), pa.list_(pa.int64())),
                ],
                names=["length", "part", "entry", "many", "sums"],
            )

    found = rows.select("vector").mapInArrow(
        add, "length long, part long, entry long, many long, sums array<long>"
    )
    # A part of no components has no position, but still a count.
    added = (
        found.select("length", "part", "entry", "many", F.posexplode_outer("sums"))
        .groupBy("length", "part", "entry", "pos")
        .agg(F.sum("many").alias("many"), F.sum("col").alias("total"))
        .collect()
    )
    shared.unpersist()
    sums = {n: np.zeros(book.shape, np.int64) for n, book in books.items()}
    counts = {n: np.zeros(book.shape[:2], np.int64) for n, book in books.items()}
    for row in added:
        counts[row["length"]][row["part"], row["entry"]] = row["many"]
        if row["pos"] is not None:
            sums[row["length"]][row["part"], row["entry"], row["pos"]] = row["total"]
    return {n: (sums[n], counts[n]) for n in books}


def moved(book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry at the floor of its parts' mean."""
    used = counts > 0
    means = sums // np.where(used, counts, 1)[:, :, None]
    return np.where(used[:, :, None], means, book)


def fit_codebooks(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> dict[int, np.ndarray]:
    """By vector length: integers (part, entry, position).  ``rows`` has vec_id and finite vectors."""
    start: dict[int, list] = {}
    for row in smallest(rows, entries).orderBy("length", "entry").collect():
        start.setdefault(row["length"], []).append(row["vector"])
    books = {
        n: cut(integers(pa.array(v, pa.list_(pa.float64()))), parts).transpose(1, 0, 2).copy()
        for n, v in start.items()
    }
    for _ in range(rounds):
        added = partial_sums(rows, books) if books else {}
        books = {n: moved(book, *added[n]) for n, book in books.items()}
    return books


def codebooks_sha256(book: np.ndarray) -> str:
    """Hex digest of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, label, code, error and codebooks_sha256 of each finite vector.

    ``code`` has two hex digits for each part, more where a codebook has over 256 entries.
    """
    shared = rows.sparkSession.sparkContext.broadcast(books)
    names = {n: codebooks_sha256(book) for n, book in books.items()}
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {n: [Entries(e) for e in book] for n, book in shared.value.items()}
        for batch in batches:
            for n, places in _by_length(batch.column(1)):
                chosen = pa.array(places)
                parts = cut(integers(batch.column(1).take(chosen)), len(trees[n]))
                index = np.empty(parts.shape[:2], np.int64)
                error = np.zeros(len(parts), np.int64)
                for k, book in enumerate(trees[n]):
                    points = np.ascontiguousarray(parts[:, k])
                    index[:, k] = assign(points, book)[0]
                    apart = points - book.entries[index[:, k]]
                    error += (apart * apart).sum(axis=1)
                digits = 2 if max(len(b.entries) for b in trees[n]) <= 256 else 8
                codes = [row.tobytes().hex() for row in index.astype(">u4" if digits == 8 else np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(chosen),
                        batch.column(2).take(chosen),
                        pa.array(codes, pa.string()),
                        pa.array(error),
                        pa.array([names[n]] * len(places), pa.string()),
                    ],
                    names=["vec_id", "label", "code", "error", "codebooks_sha256"],
                )

    return rows.select("vec_id", "vector", "label").mapInArrow(
        coded,
        f"vec_id {types['vec_id']}, label {types['label']}, code string, error long, "
        "codebooks_sha256 string",
    )


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over all rows of its label; nulls are one label.

    Errors are added before the shuffle and joined back, so a label may hold any share of the rows.
    """
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(
        F.sum("error").alias("label_error")
    )
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")


def _groups(lengths: list[int], entries: int) -> list[list[int]]:
    """Vector lengths whose codebooks take ``MOST_BYTES`` together; a longer vector is alone."""
    groups, taken = [[]], 0
    for n in sorted(lengths):
        size = 8 * entries * (n + PARTS)
        if groups[-1] and taken + size > MOST_BYTES:
            groups.append([])
            taken = 0
        groups[-1].append(n)
        taken += size
    return groups


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | None = "label",
) -> DataFrame:
    """One row per finite vector: vec_id, label, code, error, codebooks_sha256, label_error.

    Codes are written once in the shared folder, as two later steps read them.
    """
    rows = _finite(vectors, vec_id, vector, label)
    lengths = [r["n"] for r in rows.select(F.size("vector").alias("n")).distinct().collect()]
    path = scratch_path(vectors.sparkSession, "vector-codes")
    for group in _groups(lengths, entries):
        of_group = rows.where(F.size("vector").isin(group)) if len(lengths) > len(group) else rows
        books = fit_codebooks(of_group, parts, entries, rounds)
        encode(of_group, books).write.mode("append").parquet(path)
    return with_label_errors(vectors.sparkSession.read.parquet(path))
