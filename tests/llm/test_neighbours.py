"""Nearest neighbours: the curve, and recall and exact scores against brute force."""

import math

import duckdb
import numpy as np
import pytest

from gustline.llm import neighbours, queries
from tests.llm.conftest import SF_DIR


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    keys = neighbours.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(ids, vectors, k):
    for i, query in zip(ids, vectors):
        if i % 20 == 0:
            scores = (vectors * query).sum(axis=1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            yield i, [(int(ids[j]), float(scores[j])) for j in order]


def check(rows, ids, vectors, least, k=20):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    place = {int(v): j for j, v in enumerate(ids)}
    right = total = 0
    for i, expected in brute(ids, vectors, k):
        own = found.pop(int(i), [])
        assert [r for r, _, _ in own] == list(range(1, len(expected) + 1))
        for _, vec_id, score in own:
            assert math.isclose(score, float(vectors[place[vec_id]] @ vectors[place[int(i)]]), abs_tol=1e-12)
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        right += len({v for _, v, _ in own} & {v for v, _ in expected})
        total += len(expected)
    assert not found and right >= least * total
    return right / total


def test_recall_on_the_table(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet'").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    check(queries.op2_neighbours(spark, SF_DIR).collect(), ids, vectors, 0.9)


def test_clusters_need_narrow_windows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16)) * 5
    vectors = np.concatenate([c + rng.normal(size=(30, 16)) * 0.1 for c in centres])
    ids = np.arange(len(vectors))
    windows = []
    measure = neighbours.window_needed
    monkeypatch.setattr(neighbours, "window_needed", lambda *a: windows.append(measure(*a)) or windows[-1])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    check(neighbours.nearest_neighbours(df, "vec_id % 20 = 0").collect(), ids, vectors, 0.9)
    assert windows[0] <= 4


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [1.0, 1.0, 1.0]), (20, [2.0, 4.0]), (40, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS key0", "2 AS rank", "3 AS label")
    found = sorted(tuple(r) for r in neighbours.nearest_neighbours(df, "vec_id % 20 = 0").collect())
    assert found == [(0, 1, 20, 10.0), (0, 2, 1, 5.0), (0, 3, 2, 5.0), (20, 1, 0, 10.0), (20, 2, 1, 10.0), (20, 3, 2, 10.0)]
    assert neighbours.nearest_neighbours(df.limit(0), "vec_id % 20 = 0").count() == 0


@pytest.mark.parametrize("clusters", [20, 80])
def test_windows_of_clusters_do_not_grow_with_the_table(spark, monkeypatch, clusters):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(clusters, 16)) * 5
    vectors = np.concatenate([c + rng.normal(size=(30, 16)) * 0.1 for c in centres])
    ids = np.arange(len(vectors))
    seen = []
    measure = neighbours.window_needed
    monkeypatch.setattr(neighbours, "window_needed", lambda *a: seen.append((len(a[2][0]), measure(*a))) or seen[-1][1])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    check(neighbours.nearest_neighbours(df, "vec_id % 20 = 0", block_rows=32).collect(), ids, vectors, 0.9)
    blocks, window = seen[0]
    assert blocks >= len(ids) // 32 and window <= 4


def test_cells_of_equal_vectors_are_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PER_TASK", 50)
    ids = np.arange(600)
    vectors = np.where((ids % 3 == 0)[:, None], np.ones(8), np.random.default_rng(6).normal(size=(600, 8)))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    check(neighbours.nearest_neighbours(df, "vec_id % 20 = 0", block_rows=16).collect(), ids, vectors, 0.9)


def test_repeated_ids_are_one_item(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (1, [3.0, 0.0]), (1, [0.0, 5.0]), (2, [4.0, 0.0])]
    rows += [(3, [1.0, 1.0])] * 100
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(tuple(r) for r in neighbours.nearest_neighbours(df, "vec_id % 20 = 0").collect())
    assert found == [(20, 1, 1, 5.0), (20, 2, 2, 4.0), (20, 3, 3, 1.0)]
