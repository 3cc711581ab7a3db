from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from earshot.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def squared(x, y):
    return sum((a - b) ** 2 for a, b in zip(x, y, strict=True))


def plainly(rows, parts=16, entries=64, rounds=2):
    """Codes by comparing each part with each entry; rows are (vec_id, vector, label)."""
    kept = [
        (i, [min(max(math.floor(256 * x), -vector_codes.MOST), vector_codes.MOST) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out, by_length = [], defaultdict(list)
    for row in kept:
        by_length[len(row[1])].append(row)
    for n, group in by_length.items():
        width = -(-n // parts)
        filled = [(i, v + [0] * (width * parts - n), label) for i, v, label in group]
        cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in filled]
        first = sorted(range(len(filled)), key=lambda k: (filled[k][0] is None, filled[k][0] or 0, filled[k][1]))
        books = [[cut[k][p] for k in first[:entries]] for p in range(parts)]

        def nearest(p, part):
            return min(range(len(books[p])), key=lambda e: (squared(part, books[p][e]), e))  # noqa: B023

        for _ in range(rounds):
            for p in range(parts):
                members = defaultdict(list)
                for vector in cut:
                    members[nearest(p, vector[p])].append(vector[p])
                books[p] = [
                    [sum(c) // len(members[e]) for c in zip(*members[e], strict=True)] if members[e] else books[p][e]
                    for e in range(len(books[p]))
                ]
        digits = ",".join(str(x) for book in books for entry in book for x in entry)
        name = hashlib.sha256(digits.encode()).hexdigest()
        for (i, _, label), vector in zip(filled, cut, strict=True):
            index = [nearest(p, vector[p]) for p in range(parts)]
            error = sum(squared(vector[p], books[p][index[p]]) for p in range(parts))
            out.append((i, label, "".join(f"{e:02x}" for e in index), error, name))
    of_label = defaultdict(int)
    for row in out:
        of_label[row[1]] += row[3]
    return sorted(((*row, of_label[row[1]]) for row in out), key=repr)


def compressed(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = vector_codes.compress(df, **options).select(
        "vec_id", "label", "code", "error", "codebooks_sha256", "label_error"
    )
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", range(40))
def test_trees_find_the_nearest_entry(seed, monkeypatch):
    draw = np.random.default_rng(seed)
    monkeypatch.setattr(vector_codes, "LEAF_ROWS", int(draw.integers(1, 40)))
    n, k, width, most = (int(draw.integers(*r)) for r in ((1, 400), (1, 70), (0, 6), (1, 30)))
    points, entries = draw.integers(-most, most + 1, (n, width)), draw.integers(-most, most + 1, (k, width))
    if seed % 3 == 0:
        points[: n // 2] = points[0]
    index, sums, counts = vector_codes.assign(points, vector_codes.Entries(entries))
    plain = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (plain == index).all()
    for e in range(k):
        assert counts[e] == (plain == e).sum() and (sums[e] == points[plain == e].sum(axis=0)).all()


def test_whole_nodes_are_assigned_by_cached_sums(monkeypatch):
    draw = np.random.default_rng(3)
    centres = np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]])
    points = centres[draw.integers(0, 4, 4000)] + draw.integers(-20, 21, (4000, 2))
    uncertain, compared = vector_codes._uncertain, []

    def watched(*found):
        out = uncertain(*found)
        compared.append(len(out[0]))
        return out

    monkeypatch.setattr(vector_codes, "_uncertain", watched)
    index, _, counts = vector_codes.assign(points, vector_codes.Entries(centres))
    assert (centres[index] == np.round(points, -3)).all() and counts.sum() == 4000
    # Only the leaves that hold rows of two centres compare rows.
    assert sum(compared) < 100


def test_codes_equal_those_of_all_comparisons(spark):
    draw = np.random.default_rng(5)
    rows = [(int(i), (draw.normal(size=32) / 4).tolist(), int(i % 3) or None) for i in draw.permutation(300)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(150)]  # a hot vector
    rows += [(7, rows[1][1], 2), (7, rows[1][1], 2)]  # repeated rows
    assert compressed(spark, rows) == plainly(rows)


def test_awkward_vectors(spark):
    draw = np.random.default_rng(9)
    rows = [(i, (draw.normal(size=20)).tolist(), 0) for i in range(30)]  # not a multiple of 16, few rows
    rows += [(100 + i, (draw.normal(size=16)).tolist(), None) for i in range(70)]  # a second length
    rows += [(200, [1e300] * 16, 1), (201, [-1e-300] * 16, 1), (202, [], 1)]
    rows += [(300, None, 0), (301, [1.0, None] * 8, 0), (302, [math.nan] * 16, 0), (303, [math.inf] * 16, 0)]
    rows += [(None, [0.5] * 16, None), (None, [0.25] * 16, None)]
    found = compressed(spark, rows)
    assert found == plainly(rows)
    assert {r[0] for r in found}.isdisjoint({300, 301, 302, 303}) and len({r[4] for r in found}) == 3


def test_tied_entries_and_parameters(spark):
    rows = [(i, [float(i % 4)] * 8, i % 2) for i in range(100)]
    assert compressed(spark, rows) == plainly(rows)
    assert compressed(spark, rows, parts=4, entries=3, rounds=3) == plainly(rows, 4, 3, 3)


def test_empty_tables_and_clashing_names(spark):
    empty = vector_codes.compress(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and "label_error" in empty.columns
    df = spark.createDataFrame([(1, [0.5] * 16, None), (2, [0.25] * 16, 3)], SCHEMA)
    more = df.withColumn("Code", F.lit("x")).withColumn("vector", F.lit(1)).withColumn("length", F.lit(2))
    assert {r["error"] for r in vector_codes.compress(more).collect()} == {0}


def test_lengths_are_fitted_in_groups_of_bounded_codebooks():
    groups = vector_codes._groups([64, 10**6, 128, 70_000], 64)
    assert sorted(n for g in groups for n in g) == [64, 128, 70_000, 10**6] and groups[-1] == [10**6]
