"""Hard negatives by a multiway hyperplane tree (GNAT).

A node has up to ``FANOUT`` split points far from each other; a row belongs to the child of the nearest one (ties to
the first). For every split point and every child the node stores the least and the largest distance
between them, over all rows. A search knows its distances to the split points; a child whose stored range can't hold a
row at a distance between r and R of the anchor is left out with all below it. Scores are inner products, so
a window of scores is such an annulus, given the lengths in the child. What is left is compared exactly, leaf
by leaf, in blocks of rows.

A search looks through the leaves of its own child of the root first: what it finds there narrows the annulus for all. The tree (two
levels, 256 leaves) is fitted on ``SAMPLE`` rows at most; its ranges, lengths and leaves are of all rows. A leaf of any
size is dealt to tasks in blocks. Results are exact. Where vectors have no structure (independent directions in
many dimensions) nothing can be left out, and every anchor is compared with every row, in blocks.

Rows without id or label, null vectors and those with a null component take no part, nor do vectors that haven't
the most common number of components, or whose squared length has more than 62 bits (their scores wouldn't fit a
long). Rows that repeat an id are candidates like others, but not for the anchors of that id; each anchor
row is searched for by itself. Equal scores go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.shared import written

FANOUT = 16
SAMPLE = 4096  # rows
BLOCK = 8192  # rows that a task holds at once, about
ASKED = 256  # anchors compared with them at once
LEAST, MOST = -(1 << 62), 1 << 62
EXACT = 2.0**53  # products of lengths below it make every sum exact in double precision


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean, of each row to each point."""
    rows, points = rows.astype(np.float64), points.astype(np.float64)
    squares = (rows * rows).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * (rows @ points.T)
    return np.sqrt(np.maximum(squares, 0))


def split_points(rows: np.ndarray) -> np.ndarray:
    """Up to ``FANOUT`` different rows, each as far from those before as can be."""
    chosen, near = [0], distances(rows, rows[:1])[:, 0]
    while len(chosen) < FANOUT and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    def longest(rows: np.ndarray) -> float:
        return float(np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))

    if longest(left) * longest(right) < EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


class Tree:
    """Split points of the root and of its children, and what is stored about all rows below them."""

    def __init__(self, sample: np.ndarray):
        self.root = split_points(sample)
        own = distances(sample, self.root).argmin(axis=1)
        self.below = [split_points(sample[own == j]) for j in range(len(self.root))]
        n = len(self.root)
        # (split point, child): of the root, and of each child of the root.
        self.near, self.far = np.full((n + 1, FANOUT, FANOUT), np.inf), np.full((n + 1, FANOUT, FANOUT), -np.inf)
        self.short, self.long = np.full((n, FANOUT), np.inf), np.full((n, FANOUT), -np.inf)
        self.rows = np.zeros((n, FANOUT), np.int64)

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        own = distances(rows, self.root).argmin(axis=1)
        leaf = np.zeros(len(rows), np.int64)
        for j, points in enumerate(self.below):
            at = own == j
            if at.any():
                leaf[at] = j * FANOUT + distances(rows[at], points).argmin(axis=1)
        return leaf

    def ranges(self, rows: np.ndarray) -> Iterator[tuple[int, int, int, float, float, int]]:
        """(node, split point, child, least, largest, rows); node -1 holds lengths, by leaf."""
        leaf, to_root = self.place(rows), distances(rows, self.root)
        lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
        for j, points in enumerate(self.below):
            child = leaf // FANOUT == j
            if not child.any():
                continue
            for i, column in enumerate(to_root[child].T):
                yield 0, i, j, column.min(), column.max(), 0
            for k in range(len(points)):
                at = leaf == j * FANOUT + k
                if at.any():
                    for i, column in enumerate(distances(rows[at], points).T):
                        yield j + 1, i, k, column.min(), column.max(), 0
                    yield -1, j, k, lengths[at].min(), lengths[at].max(), int(at.sum())

    def store(self, node: int, point: int, child: int, least: float, largest: float, rows: int) -> None:
        if node < 0:
            self.short[point, child], self.long[point, child], self.rows[point, child] = least, largest, rows
        else:
            self.near[node, point, child], self.far[node, point, child] = least, largest

    def kept(self, node: int, to_points: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        """Which children (columns) may hold a row between ``inner`` and ``outer`` (search x child) of each search."""
        n = to_points.shape[1]
        at = to_points[:, :, None]
        nearest = np.maximum(np.maximum(self.near[node, :n], at - outer[:, None]), inner[:, None] - at)
        return (nearest <= np.minimum(self.far[node, :n], at + outer[:, None])).all(axis=1)

    def leaves(self, anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """Which leaves (columns) may hold scores within some window (columns of ``lows``, ``highs``) of each anchor."""
        n = len(self.root)
        out = np.zeros((len(anchors), n, FANOUT), bool)
        lengths = (anchors.astype(np.float64) ** 2).sum(axis=1)[:, None]
        # Beyond what rounding may do to a distance.
        slack = 1e-6 * (np.sqrt(lengths) + self.long.max(initial=0))
        to_root = distances(anchors, self.root)
        to_below = [distances(anchors, points) for points in self.below]
        for low, high in zip(lows.T.astype(np.float64)[:, :, None], highs.T.astype(np.float64)[:, :, None]):
            open_ = (low <= high)[:, 0]

            def annulus(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                with np.errstate(invalid="ignore"):
                    inner = np.sqrt(np.maximum(lengths + short**2 - 2 * high, 0)) - slack
                    outer = np.sqrt(np.maximum(lengths + long**2 - 2 * low, 0)) + slack
                return np.where(np.isfinite(short), inner, np.inf), np.where(np.isfinite(long), outer, -np.inf)

            inner, outer = annulus(self.short.min(axis=1), self.long.max(axis=1))
            first = self.kept(0, to_root, np.pad(inner, ((0, 0), (0, FANOUT - n)), constant_values=np.inf),
                              np.pad(outer, ((0, 0), (0, FANOUT - n)), constant_values=-np.inf))
            for j in range(n):
                asked = np.flatnonzero(first[:, j] & open_)
                if len(asked):
                    inner, outer = annulus(self.short[j], self.long[j])
                    out[asked, j] |= self.kept(j + 1, to_below[j][asked], inner[asked], outer[asked])
        return out.reshape(len(anchors), -1) & (self.rows.reshape(-1) > 0)


def first_of(scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` largest fitting scores of each row, ties to smaller ids."""
    if scores.shape[1] > k:
        masked = np.where(fits, scores, LEAST - 1)
        least = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        fits = fits & (scores >= least[:, None])
    row, column = np.nonzero(fits)
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


@dataclass
class Index:
    """The rows of a table in the leaves of a tree."""

    rows: DataFrame  # vec_id, label, vector
    size: int
    tree: Tree

    @classmethod
    def of(cls, rows: DataFrame, size: int) -> Index:
        n = rows.count()
        spread = F.xxhash64("vec_id")
        share = min(1.0, 2 * SAMPLE / max(n, 1))
        picked = rows.where(F.pmod(spread, F.lit(1 << 40)) < int(share * (1 << 40)))
        sample = [r.vector for r in picked.orderBy(spread, "vec_id").limit(SAMPLE).select("vector").collect()]
        sample = sample or [[0] * size]
        tree = Tree(np.array(sample, np.int64).reshape(len(sample), size))

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["node", "point", "child", "least", "largest", "n"]
            types = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
            for batch in batches:
                found = list(zip(*tree.ranges(matrix(batch.column("vector"), size))))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], names=names)

        stored = (
            rows.select("vector")
            .mapInArrow(ranges, "node int, point int, child int, least double, largest double, n long")
            .groupBy("node", "point", "child")
            .agg(F.min("least").alias("least"), F.max("largest").alias("largest"), F.sum("n").alias("n"))
        )
        for row in stored.collect():  # at most FANOUT ** 3 + 2 * FANOUT ** 2
            tree.store(*row)
        return cls(rows, size, tree)

    def placed(self, rows: DataFrame) -> DataFrame:
        tree, size = self.tree, self.size

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = pa.array(tree.place(matrix(batch.column("vector"), size)), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=[*batch.schema.names, "leaf"])

        types = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
        return rows.mapInArrow(place, f"{types}, leaf long")

    def nearby(self, asked: DataFrame) -> DataFrame:
        """``asked`` with each leaf that has rows below the same child of the root as its own."""
        filled = F.get(F.array(*map(F.lit, (self.tree.rows.reshape(-1) > 0).tolist())), F.col("leaf").cast("int"))
        child = F.expr(f"leaf div {FANOUT}") * FANOUT
        return asked.withColumn("leaf", F.explode(F.sequence(child, child + (FANOUT - 1)))).where(filled)

    def within(self, asked: DataFrame) -> DataFrame:
        """``asked`` (anchor, vec_id, label, vector, lows, highs) with each leaf that may hold a score in a window."""
        tree, size = self.tree, self.size

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, 1024):
                    batch = whole.slice(start, 1024)
                    windows = [batch.column(c).to_pylist() for c in ("lows", "highs")]
                    most = max(map(len, windows[0]))
                    padded = [
                        np.array([[*own, *[pad] * (most - len(own))] for own in side], np.int64)
                        for side, pad in zip(windows, (MOST, LEAST))
                    ]
                    open_ = tree.leaves(matrix(batch.column("vector"), size), *padded)
                    leaves = pa.array([np.flatnonzero(own) for own in open_], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([*batch.columns, leaves], names=[*batch.schema.names, "leaves"])

        types = ", ".join(f"{name} {kind}" for name, kind in asked.dtypes)
        return asked.mapInArrow(walk, f"{types}, leaves array<long>").withColumn("leaf", F.explode("leaves")).drop("leaves")

    def search(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        """anchor, slot, rank, vec_id and score of the ``k`` best of each window, within the asked leaves.

        Windows are pairs of ``lows`` and ``highs``, both inclusive; a slot is a window's place. Only rows of the
        anchor's label count, or only others. Vectors of the index travel once.
        """
        size, blocks = self.size, -(-self.tree.rows.reshape(-1) // BLOCK)
        number = F.greatest(F.lit(1), F.get(F.array(*map(F.lit, blocks.tolist())), F.col("leaf").cast("int")))
        names = ["leaf", "block", "asked", "vec_id", "label", "vector", "anchor", "lows", "highs"]
        stored = self.placed(self.rows).select(
            "leaf", (F.monotonically_increasing_id() % number).alias("block"), F.lit(0).alias("asked"),
            "vec_id", "label", "vector",
            F.lit(None).cast("long").alias("anchor"), *(F.lit(None).cast("array<long>").alias(c) for c in ("lows", "highs")),
        )
        searches = asked.withColumn("asked", F.lit(1)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)))
        together = (
            stored.union(searches.select(names)).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asked")
        )
        schema = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])

        def found(anchors: pa.RecordBatch, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
            own_ids, own_labels = (anchors.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
            rows = anchors.column("anchor").to_numpy(zero_copy_only=False)
            scores = inner_products(matrix(anchors.column("vector"), size), vectors)
            fits = (own_labels[:, None] == labels) == same
            fits &= own_ids[:, None] != ids
            lows, highs = (anchors.column(c).to_pylist() for c in ("lows", "highs"))
            out = [[], [], [], []]
            for slot in range(max(map(len, lows))):
                low = np.array([own[slot] if slot < len(own) else MOST for own in lows], np.int64)
                high = np.array([own[slot] if slot < len(own) else LEAST for own in highs], np.int64)
                row, column = first_of(scores, fits & (scores >= low[:, None]) & (scores <= high[:, None]), ids, k)
                for held, values in zip(out, (rows[row], np.full(len(row), slot), scores[row, column], ids[column])):
                    held.append(values)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), f.type) for c, f in zip(out, schema)], schema=schema
            )

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held = None, []
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in ("leaf", "block", "asked")])
                cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
                for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                    if start == end:
                        continue
                    *home, is_asked = keys[:, start].tolist()
                    if home != at:
                        at, held = home, []
                    part = batch.slice(start, end - start)
                    if not is_asked:
                        ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
                        held.append((ids, labels, matrix(part.column("vector"), size)))
                    elif held:
                        held = [tuple(map(np.concatenate, zip(*held)))]
                        for first in range(0, part.num_rows, ASKED):
                            yield found(part.slice(first, ASKED), *held[0])

        best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
        return (
            together.mapInArrow(compare, "anchor long, slot int, score long, vec_id long")
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
        )


def usable(df: DataFrame, id_col: str, label_col: str, vector_col: str) -> tuple[DataFrame, int]:
    rows = df.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<long>").alias("vector"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.where(F.forall("vector", lambda x: x.isNotNull()))
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = rows.where(square < 2.0**62)
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = common["size"] if common else 0
    return rows.where(F.size("vector") == size), size


def hard_negatives(
    df: DataFrame,
    anchors: str,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "vector",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    For each row that the SQL condition ``anchors`` (on vec_id) picks, the ``positives`` other rows of its label
    with the largest inner products of whole-number vectors; for each of them the first ``negatives`` rows of
    other labels whose score lies between ``low`` and ``high`` percent of the positive's.
    """
    rows, size = usable(df, id_col, label_col, vector_col)
    index = Index.of(written(rows, "vectors"), size)
    asking = written(
        index.placed(index.rows.where(anchors)).withColumn("anchor", F.monotonically_increasing_id()), "anchors"
    )
    anchor = asking.select("anchor", "vec_id", "label", "vector")
    everything = {"lows": F.array(F.lit(LEAST)), "highs": F.array(F.lit(MOST))}

    # The leaves nearby give what the others must reach.
    near = index.search(index.nearby(asking.withColumns(everything)), True, positives)
    reached = near.groupBy("anchor").agg(F.when(F.count("score") == positives, F.min("score")).alias("score"))
    lows = F.array(F.coalesce("score", F.lit(LEAST)))
    asked = anchor.join(reached, "anchor", "left").select(*anchor.columns, lows.alias("lows"), everything["highs"].alias("highs"))
    found = written(index.search(index.within(asked), True, positives), "positives")

    whole, part = F.expr("score div 100"), F.col("score") % 100
    windows = (
        found.where("score >= 0")
        .select(
            "anchor",
            (F.col("rank") - 1).cast("int").alias("slot"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
            (whole * low + F.ceil(part * low / 100)).cast("long").alias("low"),
            (whole * high + F.floor(part * high / 100)).cast("long").alias("high"),
        )
        .where("low <= high")
    )

    def asked_for(windows: DataFrame) -> DataFrame:
        sides = F.array_sort(F.collect_list(F.struct("slot", "low", "high")))
        places = F.sequence(F.lit(0), F.array_max("sides.slot"))

        def side(name: str, absent: int):
            own = lambda place: F.filter("sides", lambda s: s["slot"] == place)[0][name]
            return F.transform(places, lambda place: F.coalesce(own(place), F.lit(absent))).alias(f"{name}s")

        each = windows.groupBy("anchor").agg(sides.alias("sides"))
        return each.select("anchor", side("low", MOST), side("high", LEAST))

    near = index.search(index.nearby(asking.join(asked_for(windows), "anchor")), False, negatives)
    reached = near.groupBy("anchor", "slot").agg(F.when(F.count("score") == negatives, F.min("score")).alias("reached"))
    narrowed = windows.join(reached, ["anchor", "slot"], "left").withColumn("low", F.coalesce("reached", "low"))
    hard = index.search(index.within(anchor.join(asked_for(narrowed), "anchor")), False, negatives)
    ids = asking.select("anchor", F.col("vec_id").alias("anchor_id"))
    return (
        hard.join(windows.join(ids, "anchor"), ["anchor", "slot"])
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
