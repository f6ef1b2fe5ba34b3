"""Approximate nearest neighbours with shifted space-filling curves.

Each curve projects the vectors to a few dimensions, shifts them and orders them by their place on a
Hilbert curve. Spark range-partitions that order and cuts it into blocks of a fixed number of rows. A
query is compared with the vectors in the blocks around its own, on every curve; what the curves find
is merged, and ranked by the exact inner product (in double precision) of the original vectors.

How many blocks a window needs is measured, not guessed: for a bounded sample of queries the true
neighbours are found by one scan, and the window is the smallest in which the curves together hold
the wanted share of them. Where the vectors lie in clusters it stays narrow, and a query's work doesn't
grow with the table. Vectors without structure (independent directions in many dimensions) have no near
neighbours to speak of; there it grows until most blocks are in it.

Null and zero vectors, vectors with null or non-finite components and rows without an id take no
part, nor do vectors that haven't the most common number of components. Equal scores go to the
smaller id. Rows that repeat an id are one item: it comes once in a list, with the largest score that any
of its vectors has with any of the query's, and never in its own list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.shared import written

CURVES = 3
DIMENSIONS, BITS = 8, 7  # of a curve: 56 bits of key
BLOCK_ROWS = 2048
MOST_BLOCKS = 1 << 17  # of a curve: beyond 268 million rows, blocks get larger and are split among tasks
PER_TASK = 16_384  # vectors that a task holds at once
SCORED = 256  # queries whose scores are held at once


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates (rows), by exchange and inversion of low bits."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


class Curve:
    """A random projection to a few directions, a shift, and the curve through them."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.axes = np.linalg.qr(rng.normal(size=(size, min(size, DIMENSIONS))))[0]
        self.shift = rng.random(self.axes.shape[1])

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        spread = unit @ self.axes * math.sqrt(vectors.shape[1])
        even = 1 / (1 + np.exp(-1.7 * spread))  # about uniform between 0 and 1
        return hilbert_keys(((even + self.shift) / 2 * (1 << BITS)).astype(np.int64), BITS)


def as_matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def ranked(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, largest first, ties to smaller ids; an id counts once."""
    order = np.lexsort((ids, -scores))
    first = np.sort(np.unique(ids[order], return_index=True)[1])
    return order[first[:k]]


def best(scores: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query: np.ndarray, own: int, k: int):
    """Rows and exact scores of the k best. Scores that are too near to tell are computed again, one row like another."""
    scores = np.where(ids == own, -np.inf, scores)
    wanted = k
    while True:
        near = np.flatnonzero(ids != own)
        if len(scores) > wanted:
            least = np.partition(scores, len(scores) - wanted)[len(scores) - wanted]
            near = near[scores[near] >= least - 1e-9 * max(1.0, abs(least))]
        exact = (vectors[near] * query).sum(axis=1)
        order = ranked(exact, ids[near], k)
        if len(order) == k or len(scores) <= wanted:
            return near[order], exact[order]
        wanted *= 4  # rows that repeat an id took places


def usable(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    vector = F.col("vector")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = (
        df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & vector.isNotNull() & F.forall(vector, fine))
        .where(F.exists(vector, lambda x: x != 0))
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 1
    return rows.where(F.size("vector") == size), size


def indexed(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """vec_id, vector and the place on each curve."""
    curves = [Curve(size, seed + i) for i in range(CURVES)]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = as_matrix(batch.column("vector"), size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c.keys(vectors), pa.int64()) for c in curves)],
                names=["vec_id", "vector", *(f"key{i}" for i in range(CURVES))],
            )

    return rows.mapInArrow(keys, "vec_id long, vector array<double>" + "".join(f", key{i} long" for i in range(CURVES)))


def block_cuts(index: DataFrame, block_rows: int) -> list[np.ndarray]:
    """For each curve the keys at which blocks begin: every ``block_rows``-th of the range-partitioned order.

    At most MOST_BLOCKS a curve, and one more for each partition, come to the driver.
    """
    keys = index.select(F.inline(F.array(*[F.struct(F.lit(i).alias("curve"), F.col(f"key{i}").alias("key")) for i in range(CURVES)])))
    ordered = keys.repartitionByRange("curve", "key").sortWithinPartitions("curve", "key")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # within the partition
    found = ordered.select("curve", "key", place.alias("place")).where(F.col("place") % block_rows == 0).distinct().collect()
    return [np.unique(np.array([r.key for r in found if r.curve == i], np.int64)) for i in range(CURVES)]


def blocks_of(batch: pa.RecordBatch, cuts: list[np.ndarray]) -> np.ndarray:
    """The block of each row (columns) on each curve (rows)."""
    return np.stack([np.searchsorted(cuts[i], batch.column(f"key{i}").to_numpy(), "right") for i in range(CURVES)])


def window_needed(index: DataFrame, size: int, cuts: list, queries: DataFrame, k: int, target: float, sample: int) -> int:
    """The smallest window (blocks on each side) that holds the target share of the sample's true neighbours."""
    picked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not picked:
        return 0
    probes = np.array([row.vector for row in picked])
    owners = np.array([row.vec_id for row in picked])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (np.zeros(0), np.zeros(0, np.int64), np.zeros((CURVES, 0), np.int64))
        held = [nothing] * len(owners)  # the k best of the task so far
        for batch in batches:
            vectors, ids = as_matrix(batch.column("vector"), size), batch.column("vec_id").to_numpy()
            blocks, scores = blocks_of(batch, cuts), probes @ vectors.T
            for q, own in enumerate(owners):
                rows, exact = best(scores[q], ids, vectors, probes[q], own, k)
                both = [np.concatenate(x, axis=-1) for x in zip(held[q], (exact, ids[rows], blocks[:, rows]), strict=True)]
                top = ranked(both[0], both[1], k)
                held[q] = tuple(x[..., top] for x in both)
        columns = [
            pa.array(np.repeat(np.arange(len(owners)), [len(h[0]) for h in held]), pa.int32()),
            pa.array(np.concatenate([h[0] for h in held]), pa.float64()),
            pa.array(np.concatenate([h[1] for h in held]), pa.int64()),
            pa.array([x for h in held for x in h[2].T.tolist()], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["q", "score", "vec_id", "blocks"])

    found = top_of(index.mapInArrow(nearest, "q int, score double, vec_id long, blocks array<long>"), "q", k, "blocks").collect()
    home = np.stack([np.searchsorted(cuts[i], [row[f"key{i}"] for row in picked], "right") for i in range(CURVES)])
    distances = [min(abs(int(home[i, row.q]) - row.blocks[i]) for i in range(CURVES)) for row in found]
    if not distances:
        return 0
    return int(np.sort(distances)[max(0, math.ceil(target * len(distances)) - 1)])


def top_of(found: DataFrame, query: str, k: int, *more: str) -> DataFrame:
    """The k best ids of each query with their ranks. Lists are cut before and after the shuffle, never gathered whole."""
    once = found.groupBy(query, "vec_id").agg(F.max("score").alias("score"), *[F.max_by(c, "score").alias(c) for c in more])
    order = Window.partitionBy(query).orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    df: DataFrame,
    queries: str,
    k: int = 20,
    target: float = 0.96,
    sample: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 17,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score: for each row that the SQL condition ``queries`` (on vec_id) picks, the
    ``k`` ids with the largest inner products found.

    Only the keys between blocks, the sample and its neighbours come to the driver; all are bounded. Neighbouring
    blocks go together into cells, the more the wider the window, so that a query is sent to few of them. The
    vectors of a cell are split among tasks of ``PER_TASK`` vectors.
    """
    rows, size = usable(df, id_col, vector_col)
    index = written(indexed(rows, size, seed), "curves")
    cuts = block_cuts(index, max(block_rows, -(-index.count() // MOST_BLOCKS)))
    window = window_needed(index, size, cuts, index.where(queries), k, target, sample)
    together = min(max(window, 1), max(1, PER_TASK // block_rows))  # blocks of a cell

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(blocks_of(batch, cuts).T.tolist(), pa.list_(pa.int32()))
            kept = [c for c in batch.schema.names if not c.startswith("key")]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), found], names=[*kept, "blocks"])

    def cell(block: Column) -> Column:
        return F.floor(block / together).cast("int")

    # Equal vectors share a block whatever its cuts, so cells are split by their actual size.
    keys = index.select([f"key{i}" for i in range(CURVES)]).mapInArrow(homes, "blocks array<int>")
    sizes = keys.select(F.posexplode("blocks").alias("curve", "block")).groupBy("curve", cell(F.col("block")).alias("cell")).count()
    crowded = sizes.where(F.col("count") > PER_TASK).select("curve", "cell", F.ceil(F.col("count") / PER_TASK).cast("int").alias("parts"))
    crowded = F.broadcast(written(crowded, "crowded"))  # at most one row a cell, so at most MOST_BLOCKS a curve
    parts = F.coalesce("parts", F.lit(1))

    placed = index.mapInArrow(homes, "vec_id long, vector array<double>, blocks array<int>")
    placed = placed.select("vec_id", "vector", F.posexplode("blocks").alias("curve", "block"))
    stored = placed.withColumn("cell", cell(F.col("block"))).join(crowded, ["curve", "cell"], "left")
    stored = stored.select(
        "curve", "cell", F.pmod(F.xxhash64("vec_id", "vector"), parts).cast("int").alias("part"), F.lit(0).alias("query"), "vec_id", "vector"
    )
    last = F.get(F.array(*[F.lit(len(c)) for c in cuts]), F.col("curve"))
    near = F.sequence(cell(F.greatest(F.col("block") - window, F.lit(0))), cell(F.least(F.col("block") + window, last)))
    asked = placed.where(queries).select("curve", F.explode(near).alias("cell"), "vec_id", "vector")
    asked = asked.join(crowded, ["curve", "cell"], "left").select(
        "curve", "cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(1).alias("query"), "vec_id", "vector"
    )
    met = stored.union(asked).repartition("curve", "cell", "part").sortWithinPartitions("curve", "cell", "part", "query")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vectors = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("curve", "cell", "part", "query")])
            all_ids, all_vectors = batch.column("vec_id").to_numpy(), as_matrix(batch.column("vector"), size)
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cut], [*cut, len(all_ids)], strict=True):
                if start == end:
                    continue
                *home, query = keys[:, start].tolist()
                if home != at:
                    at, ids, vectors = home, [], []
                if not query:
                    ids.append(all_ids[start:end])
                    vectors.append(all_vectors[start:end])
                    continue
                if not ids:
                    continue
                ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                for first in range(start, end, SCORED):
                    yield scored(all_ids[first : min(first + SCORED, end)], all_vectors[first : min(first + SCORED, end)], ids[0], vectors[0])

    def scored(own: np.ndarray, probes: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        scores = probes @ vectors.T
        found = [best(scores[i], ids, vectors, probes[i], own[i], k) for i in range(len(own))]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(own, [len(places) for places, _ in found]), pa.int64()),
                pa.array(ids[np.concatenate([places for places, _ in found])], pa.int64()),
                pa.array(np.concatenate([exact for _, exact in found]), pa.float64()),
            ],
            names=["query_id", "vec_id", "score"],
        )

    found = met.mapInArrow(compare, "query_id long, vec_id long, score double")
    return top_of(found, "query_id", k).select("query_id", "rank", "vec_id", "score")
