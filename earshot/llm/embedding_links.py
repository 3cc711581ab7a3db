"""Near duplicates among embeddings by a forest of random-projection trees.

Each tree splits the vectors by a random direction at the median of a sample, again and again; a
vector within ``SPILL`` of a split goes to both sides, so that close vectors seldom part.
Vectors that meet in a leaf of any tree are compared by cosine in double precision; links are
verified pairs, and components are unions of links.

Each number of components has trees of its own, as only vectors of equal length compare.  They
are fitted on a bounded sample (``MOST_SAMPLED`` vectors of a length, chosen by hash); every vector
is put into its leaves.  Equal vectors are one vertex with a weight.  Leaves larger than
``BLOCK`` rows are cut into blocks by hash, and each pair of blocks is a task of its own, so
nothing is dropped from a crowded leaf and no task grows with it.  A pair is counted in the
first leaf it shares only, which a task sees from the leaf numbers that vectors carry; tasks
return link counts and one local root for each vector, never pairs.

Vectors that are null, zero or have null or non-finite components link with nothing: they have
no links and are their own component.  Rows that share an id count as one vertex for components.  A null id has a null
component.  Repeated rows are copies and link with each other.  Labels and further columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.components import connected_components
from earshot.session import scratch_path

COSINE = 0.9
TREES = 8
#: Distance from a split, along its direction, within which a unit vector goes both ways.
SPILL = 0.03
#: Rows that a leaf should have.
LEAF_ROWS = 1000
#: Splits above a leaf at most; with the number of trees it bounds the forest's size.
MOST_DEPTH = 12
MOST_SAMPLED = 20_000
BLOCK = 2000


@dataclass
class Node:
    """A split, or a leaf if it has a number."""

    direction: np.ndarray | None = None
    at: float = 0.0
    left: Node | None = None
    right: Node | None = None
    leaf: int = -1


def fit_forest(
    sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 5, first: int = 0
) -> list[Node]:
    """Trees whose leaves are numbered through from ``first``; ``sample`` has unit vectors."""
    draw = np.random.default_rng(seed)
    count = first

    def grow(rows: np.ndarray, levels: int) -> Node:
        nonlocal count
        if levels and len(rows) >= 8:
            direction = draw.normal(size=sample.shape[1])
            direction /= np.linalg.norm(direction)
            along = sample[rows] @ direction
            at = float(np.median(along))
            low = along < at
            if low.any() and not low.all():
                return Node(
                    direction, at, grow(rows[low], levels - 1), grow(rows[~low], levels - 1)
                )
        count += 1
        return Node(leaf=count - 1)

    return [grow(np.arange(len(sample)), depth) for _ in range(trees)]


def leaf_count(forest: list[Node]) -> int:
    waiting, most = list(forest), 0
    while waiting:
        node = waiting.pop()
        if node.leaf >= 0:
            most = max(most, node.leaf + 1)
        else:
            waiting += [node.left, node.right]
    return most


def route(forest: list[Node], units: np.ndarray, spill: float = SPILL) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for each leaf that a vector belongs to, ordered by row and leaf."""
    rows, leaves = [], []
    for tree in forest:
        waiting = [(tree, np.arange(len(units)))]
        while waiting:
            node, at = waiting.pop()
            if not len(at):
                continue
            if node.leaf >= 0:
                rows.append(at)
                leaves.append(np.full(len(at), node.leaf))
                continue
            along = units[at] @ node.direction - node.at
            waiting.append((node.left, at[along < spill]))
            waiting.append((node.right, at[along >= -spill]))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, leaf = np.concatenate(rows), np.concatenate(leaves)
    order = np.lexsort((leaf, row))
    return row[order], leaf[order]


def route_lengths(
    forests: dict[int, list[Node]], column: pa.Array, kind: str, spill: float
) -> tuple[np.ndarray, np.ndarray]:
    """As ``route``, for stored vectors of any lengths; ``forests`` are by number of bytes."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    rows, leaves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        row, leaf = route(forests[int(size)], _units(_matrix(column.take(pa.array(at)), kind)), spill)
        rows.append(at[row])
        leaves.append(leaf)
    row, leaf = np.concatenate(rows), np.concatenate(leaves)
    order = np.lexsort((leaf, row))
    return row[order], leaf[order]


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """The stored bytes of vectors as rows of doubles."""
    raw = b"".join(x.as_py() for x in column)
    return np.frombuffer(raw, kind).reshape(len(column), -1).astype(np.float64) if raw else np.zeros((0, 0))


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _element_kind(rows: DataFrame, embedding: str) -> str:
    """How components are stored: as they came if they are floats, else as doubles."""
    return "<f4" if rows.schema[embedding].dataType.elementType.typeName() == "float" else "<f8"


def usable_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vector, key): the bytes of each vector, null if it can link with nothing."""
    kind = _element_kind(rows, embedding)

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1):
                items = value.as_py()
                usable = items is not None and len(items) > 0 and None not in items
                vector = np.array(items, np.float64) if usable else np.zeros(1)
                if usable and np.isfinite(vector).all() and 0 < np.linalg.norm(vector) < np.inf:
                    out.append((vector + 0.0).astype(kind).tobytes())
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vector"]
            )

    return (
        rows.select(
            F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("v")
        )
        .mapInArrow(stored, "vec_id long, vector binary")
        .select("vec_id", "vector", F.md5("vector").alias("key"))
    )


def link_counts(
    left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...] | None, leaf: int, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row of both blocks counted in this leaf, and the row of its local root.

    A block is (vectors, weights, owner, leaves): ``leaves`` are all leaf numbers of its rows and
    ``owner`` the row each belongs to.  Without ``right`` the block is compared with itself.
    """
    x, weight_x, owner_x, leaves_x = left
    y, weight_y, owner_y, leaves_y = right or left
    norm_x, norm_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    close = (x @ y.T) / norm_x[:, None] / norm_y[None, :] >= cosine
    if right is None:
        np.fill_diagonal(close, False)
    a, b = np.nonzero(close)
    n = len(x)
    shift = 0 if right is None else n
    total = n if right is None else n + len(y)
    root = np.arange(total)
    if not len(a):
        return np.zeros(total, np.int64), root
    # Pairs that share an earlier leaf were counted there.
    rows_a, at_a = np.unique(a, return_inverse=True)
    rows_b, at_b = np.unique(b, return_inverse=True)
    early = np.unique(leaves_x[leaves_x < leaf])
    if len(early):
        def membership(rows: np.ndarray, owner: np.ndarray, leaves: np.ndarray, size: int) -> np.ndarray:
            place = np.full(size, -1)
            place[rows] = np.arange(len(rows))
            at = np.minimum(np.searchsorted(early, leaves), len(early) - 1)
            hit = (early[at] == leaves) & (place[owner] >= 0)
            out = np.zeros((len(rows), len(early)), np.float32)
            out[place[owner[hit]], at[hit]] = 1
            return out

        shared = membership(rows_a, owner_x, leaves_x, n) @ membership(rows_b, owner_y, leaves_y, len(y)).T
        new = shared[at_a, at_b] == 0
    else:
        new = np.ones(len(a), bool)
    links = np.bincount(a[new], weights=weight_y[b[new]], minlength=total)
    if right is not None:
        links += np.bincount(b[new] + shift, weights=weight_x[a[new]], minlength=total)
    ends = np.concatenate([a, b + shift]), np.concatenate([b + shift, a])
    while True:
        before = root.copy()
        np.minimum.at(root, ends[0], root[ends[1]])
        root = root[root]
        if (root == before).all():
            return links.astype(np.int64), root


def link_vectors(
    rows: DataFrame,
    cosine: float = COSINE,
    trees: int = TREES,
    spill: float = SPILL,
    leaf_rows: int = LEAF_ROWS,
    block: int = BLOCK,
    most_sampled: int = MOST_SAMPLED,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``rows``."""
    spark = rows.sparkSession
    kind = _element_kind(rows, embedding)
    prepared = usable_vectors(rows, vec_id, embedding)
    different = (
        prepared.where("vector IS NOT NULL")
        .groupBy("key", "vector")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    )
    path = scratch_path(spark, "vectors")
    different.write.parquet(path)
    different = spark.read.parquet(path)
    size = F.octet_length("vector")
    # One row for each length.
    lengths = different.groupBy(size.alias("bytes")).agg(F.count("*").alias("n")).orderBy("bytes").collect()
    if not lengths:
        return prepared.select(
            "vec_id",
            F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    forests: dict[int, list[Node]] = {}
    n_leaves = 0
    for length in lengths:
        depth = min(MOST_DEPTH, max(0, math.ceil(math.log2(max(length["n"] / leaf_rows, 1)))))
        if depth:
            own = different.where(size == length["bytes"])
            sample = own.orderBy(F.xxhash64(F.lit(11), "key"), "key").limit(most_sampled)
            column = sample.select("vector").toArrow().column("vector").combine_chunks()
            grown = fit_forest(_units(_matrix(column, kind)), depth, trees, first=n_leaves)
        else:  # one leaf has all pairs
            grown = [Node(leaf=n_leaves)]
        forests[length["bytes"]] = grown
        n_leaves = leaf_count(grown)
    forest = spark.sparkContext.broadcast(forests)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_leaves, np.int64)
        for batch in batches:
            if batch.num_rows:
                _, leaf = route_lengths(forest.value, batch.column(0), kind, spill)
                counts += np.bincount(leaf, minlength=n_leaves)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n_leaves)), pa.array(counts)], names=["leaf", "n"]
        )

    # One row for each leaf of the forest.
    counted = (
        different.select("vector")
        .mapInArrow(sizes, "leaf long, n long")
        .groupBy("leaf")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    blocks = np.ones(n_leaves, np.int64)
    for row in counted:
        blocks[row["leaf"]] = max(1, -(-row["n"] // block))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row, leaf = route_lengths(forest.value, part.column(1), kind, spill)
                begin = np.searchsorted(row, np.arange(part.num_rows + 1))
                lists = [leaf[s:e].astype(np.int32).tobytes() for s, e in zip(begin, begin[1:], strict=False)]
                own = np.array([int(k.as_py()[:12], 16) for k in part.column(0)])[row] % blocks[leaf]
                # A block meets each block of its leaf in a task of the two.
                times = blocks[leaf]
                again = np.repeat(np.arange(len(row)), times)
                other = np.arange(len(again)) - np.repeat(np.cumsum(times) - times, times)
                mine = own[again]
                low, high = np.minimum(mine, other), np.maximum(mine, other)
                take = pa.array(row[again])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(leaf[again]),
                        pa.array(low),
                        pa.array(high),
                        pa.array((mine != low) & (low != high)),
                        *[part.column(k).take(take) for k in range(4)],
                        pa.array(lists, pa.binary()).take(take),
                    ],
                    names=["leaf", "low", "high", "second", "key", "vector", "id", "n", "leaves"],
                )

    def compared(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        leaf, low, high = (group.column(k)[0].as_py() for k in ("leaf", "low", "high"))
        second = group.column("second").to_numpy()
        parts, order = [], []
        for side in (False, True):
            at = np.flatnonzero(second == side)
            if side and low == high:
                continue
            part = group.take(pa.array(at))
            raw = [np.frombuffer(x.as_py(), np.int32) for x in part.column("leaves")]
            vectors = _matrix(part.column("vector").combine_chunks(), kind) if len(at) else None
            parts.append(
                (
                    vectors,
                    part.column("n").to_numpy(),
                    np.repeat(np.arange(len(raw)), [len(r) for r in raw]),
                    np.concatenate(raw) if raw else np.zeros(0, np.int32),
                )
            )
            order.append(at)
        empty = pa.table(
            {
                "key": pa.array([], pa.string()),
                "id": pa.array([], pa.int64()),
                "links": pa.array([], pa.int64()),
                "root": pa.array([], pa.int64()),
            }
        )
        if any(p[0] is None for p in parts):
            return empty
        links, root = link_counts(parts[0], parts[1] if len(parts) > 1 else None, leaf, cosine)
        rows_of = np.concatenate(order)
        some = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
        return pa.table(
            {
                "key": group.column("key").take(pa.array(rows_of[some])),
                "id": group.column("id").take(pa.array(rows_of[some])),
                "links": pa.array(links[some]),
                "root": group.column("id").take(pa.array(rows_of[root[some]])),
            }
        )

    found = (
        different.select("key", "vector", "id", "n")
        .mapInArrow(
            dealt,
            "leaf long, low long, high long, second boolean, key string, vector binary, id long, "
            "n long, leaves binary",
        )
        .groupBy("leaf", "low", "high")
        .applyInArrow(compared, "key string, id long, links long, root long")
    )
    path = scratch_path(spark, "vector-links")
    found.write.parquet(path)
    found = spark.read.parquet(path)
    sums = found.groupBy("key").agg(F.sum("links").alias("links"))
    vertices = different.select("key", "id", "n").join(sums, "key", "left")
    # Rows of one id belong together, whichever vectors they have.
    keyed = prepared.join(
        vertices.select("key", "id", "n", F.coalesce("links", F.lit(0)).alias("links")), "key", "left"
    )
    same = keyed.where("vec_id <> id").select(F.col("vec_id").alias("id"), F.col("id").alias("root"))
    parts = connected_components(found.select("id", "root").union(same), "id", "root")
    labelled = keyed.select(
        "vec_id", F.coalesce(F.col("n") - 1 + F.col("links"), F.lit(0)).alias("n_links")
    ).join(parts.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return labelled.select(
        "vec_id",
        F.col("n_links").cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
