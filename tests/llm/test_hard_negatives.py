"""Hard negatives: against brute force, what the tree leaves out, and odd vectors."""

import numpy as np
import pytest

from gustline.llm import hard_negatives as module
from gustline.llm import queries
from gustline.llm.hard_negatives import LEAST, MOST, Index, hard_negatives

TYPES = "vec_id long, label long, vector array<long>"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    out = []
    for a, label, vector in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, v)), i, own) for i, own, v in rows if i != a)
        for p_score, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(n, -s) for s, n, own in scored if own != label and -low * p_score <= -100 * s <= -high * p_score]
            out += [(a, p, rank + 1, n, -p_score, s) for rank, (n, s) in enumerate(fit[:negatives])]
    return sorted(out)


def found(df, **parameters):
    return sorted(map(tuple, hard_negatives(df, **{"anchors": "vec_id % 50 = 0", **parameters}).collect()))


def clustered(n, seed, clusters=40, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, size))
    centres *= 1000 / np.linalg.norm(centres, axis=1, keepdims=True)
    home = rng.integers(0, clusters, n)
    vectors = np.floor(centres[home] + rng.normal(size=(n, size)) * 12).astype(int)
    return [(i, int(rng.integers(0, 4)), v.tolist()) for i, v in enumerate(vectors)]


def test_clusters_equal_brute_force_and_leaves_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 100)
    monkeypatch.setattr(module, "ASKED", 3)
    rows = clustered(3000, 1)
    df = spark.createDataFrame(rows, TYPES).repartition(4)
    visited = []
    within = Index.within

    def counted(self, asked):
        out = within(self, asked)
        visited.append((out.count(), asked.count(), int((self.tree.rows > 0).sum())))
        return out

    monkeypatch.setattr(Index, "within", counted)
    assert found(df) == brute(rows)
    (seen, anchors, leaves), _ = visited
    assert leaves > 50 and seen < 0.2 * anchors * leaves


def test_structureless_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 3)), rng.integers(-3, 4, 4).tolist()) for i in range(300)]
    rows += [(1000 + i, 1, [3, 3, 3, 3]) for i in range(200)]  # a third are one vector
    df = spark.createDataFrame(rows, TYPES)
    assert found(df) == brute(rows)
    assert found(df, positives=2, negatives=1, low=0, high=100) == brute(rows, positives=2, negatives=1, low=0, high=100)


def test_long_vectors_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 2)), (rng.integers(-(2**28), 2**28, 6) + 1).tolist()) for i in range(200)]
    rows += [(500, 0, [2**62, 0, 0, 0, 0, 0]), (550, 0, [-(2**63), 2**63 - 1, 0, 0, 0, 0])]  # too long: no part
    df = spark.createDataFrame(rows, TYPES)
    assert found(df) == brute(rows[:200])


def test_odd_rows(spark):
    rows = [(0, 1, [10, 0]), (1, 1, [10, 1]), (2, 2, [9, 0]), (3, 2, [8, 0]), (3, 2, [7, 0]), (4, None, [9, 0]), (None, 2, [9, 0])]
    rows += [(5, 2, None), (6, 2, [None, 1]), (7, 2, []), (8, 2, [9, 0, 0]), (9, 2, [0, 0]), (50, 1, [0, 0]), (100, 3, [1, 1])]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], TYPES + ", leaf int, anchor int, rank string")
    kept = [r for r in rows if None not in r[:2] and r[2] and len(r[2]) == 2 and None not in r[2]]
    assert found(df) == brute(kept) and (0, 1, 1, 2, 100, 90) in found(df)
    assert found(df.limit(0)) == []
    # The same anchor twice, with different vectors, is searched for twice.
    twice = spark.createDataFrame([(0, 1, [10]), (0, 1, [20]), (1, 1, [10]), (2, 2, [9])], TYPES)
    assert found(twice) == [(0, 1, 1, 2, 100, 90), (0, 1, 1, 2, 200, 180)]


def test_a_window_is_kept_where_a_row_lies_in_it():
    """What the tree leaves out holds no score in the window, whatever the vectors."""
    rng = np.random.default_rng(4)
    for scale in (2, 100, 10**6):
        rows = rng.integers(-scale, scale + 1, (800, 5)) + (rng.integers(0, 8, (800, 1)) * scale * 4)
        tree = module.Tree(rows[::7])
        for entry in tree.ranges(rows):
            tree.store(*entry)
        anchors, leaf = rows[:40], tree.place(rows)
        scores = anchors @ rows.T
        low = np.quantile(scores, rng.random((40, 2)) * 0.5, axis=1).diagonal(axis1=0, axis2=2).T.astype(np.int64)
        high = low + scale * scale
        kept = tree.leaves(anchors, low, high)
        for i in range(40):
            inside = ((scores[i][:, None] >= low[i]) & (scores[i][:, None] <= high[i])).any(axis=1)
            assert kept[i][leaf[inside]].all()
        everything = tree.leaves(anchors, np.full((40, 1), LEAST), np.full((40, 1), MOST))
        assert everything[:, np.unique(leaf)].all()


@pytest.mark.parametrize("share", ["sf0.001"])
def test_query_keeps_floor_and_labels(spark, share):
    rows = queries.op12_hard_negatives(spark, f"/root/testdata/{share}").collect()
    assert rows and all(50 * r.positive_score <= 100 * r.negative_score <= 95 * r.positive_score for r in rows)
