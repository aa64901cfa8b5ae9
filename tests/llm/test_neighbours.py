"""Nearest vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartlens.llm import neighbours

DDL = "vec_id long, embedding array<double>, label int, node long, rank int, score string"


def frame(spark, rows):
    floats = lambda x: x and [None if v is None else float(v) for v in x]
    return spark.createDataFrame([(i, floats(x), 1, 2, 3, "s") for i, x in rows], DDL)


def usable(x):
    return x is not None and len(x) > 0 and all(v is not None and math.isfinite(v) for v in x) and any(x)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def expected(rows, every, top):
    out = {}
    kept = [(k, i, x) for k, (i, x) in enumerate(rows) if i is not None and usable(x)]
    for k, i, x in kept:
        if i % every == 0:
            near = sorted((-cosine(x, y), j) for m, j, y in kept if m != k and len(y) == len(x))
            out.setdefault(i, []).append([(j, -c) for c, j in near[:top]])
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_small_tables_are_answered_exactly(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.standard_normal(6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(9)]  # copies, more than are asked for
    rows += [(200 + i, (np.array(rows[20][1]) * 2.0**i).tolist()) for i in range(7)]  # parallel
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [1.0, None, 0, 0, 0, 0]), (304, [math.nan] + [1.0] * 5)]
    rows += [(305, [math.inf] + [1.0] * 5), (None, rows[3][1]), (310, [1e300] * 6), (320, [1e-300] * 6), (330, [-0.0, 1, 0, 0, 0, 0])]
    rows += [(400, [1.0, 2.0]), (401, [2.0, 1.0]), (410, [3.0])]
    got = answers(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0))
    want = expected(rows, 10, 5)
    assert set(got) == {k for k, v in want.items() if v[0]}
    for query, answer in got.items():
        best = want[query][0]
        assert [c for _, c in answer] == pytest.approx([c for _, c in best], abs=1e-12)
        if query != 320 and len({round(c, 9) for _, c in best}) == len(best):
            assert [i for i, _ in answer] == [i for i, _ in best]


def test_copies_come_in_order_of_their_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40, -1, -1)] + [(50, [1.0, 2.0, 3.1]), (50, [1.0, 2.0, 3.1])]
    got = neighbours.nearest(frame(spark, rows), F.col("vec_id").isin(0, 3, 50))
    found = answers(got)
    assert [i for i, _ in found[0]] == [1, 2, 3, 4, 5] and [i for i, _ in found[3]] == [0, 1, 2, 4, 5]
    assert sorted(i for i, _ in found[50]) == [0, 0, 1, 1, 2, 2, 3, 3, 50, 50]  # each of the two rows is answered
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "double"]


@pytest.mark.parametrize("clusters", [0, 12])
def test_recall(spark, clusters):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((3000, 24))
    if clusters:
        x = draw.standard_normal((clusters, 24))[draw.integers(0, clusters, 3000)] + 0.02 * x
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = answers(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0)), expected(rows, 50, 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q][0]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    assert all(abs(c - cosine(rows[q][1], rows[i][1])) < 1e-12 for q, v in got.items() for i, c in v)


def test_links_come_from_neighbours_of_neighbours(spark):
    """Rounds find what the first lists miss."""
    draw = np.random.default_rng(3)
    x = draw.standard_normal((4000, 32))
    rows = neighbours._usable(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "vec_id", "embedding")
    nodes = neighbours.stored(neighbours._codes(rows.withColumnRenamed("vec_id", "node").select("node", "vector")), "test-codes")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    best = np.argsort(-sims, axis=1)[:, :10]

    def recall(rounds):
        links = neighbours.neighbour_graph(nodes, degree=16, rounds=rounds).toPandas()
        assert not links.duplicated(["node", "other"]).any() and (links.node != links.other).all()
        assert links.groupby("node").size().max() <= 16
        found = links.groupby("node").other.apply(set)
        return np.mean([len(found[i] & set(best[i])) / 10 for i in range(len(x))])

    first = recall(0)
    assert first < 0.9 and recall(4) > max(0.9, first + 0.05)


def test_empty_tables(spark):
    assert neighbours.nearest(frame(spark, []), F.col("vec_id") % 2 == 0).collect() == []
    assert neighbours.nearest(frame(spark, [(1, [1.0]), (3, [2.0])]), F.col("vec_id") % 2 == 0).collect() == []
    assert neighbours.nearest(frame(spark, [(2, [1.0])]), F.col("vec_id") % 2 == 0).collect() == []
