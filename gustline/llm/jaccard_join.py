"""N-gram Jaccard join with prefix trees.

Every document is the set of its different word n-grams, in one global order: rare ones first, by a
sketch of fixed size that counts all n-grams of all documents. Documents with the same set are one
node. Two sets that reach the similarity share one of their rarest n-grams (the prefix), so nodes
meet in the lists of their prefix n-grams.

1. Stars: one set of each list is probed against a tree of the others. Families of near copies
   become components after a number of comparisons that is linear in their size.
2. The rest: components that still share a prefix n-gram, at positions that leave room for the overlap
   they need, are compared as wholes, again in trees of bounded size.

Before sets meet in a tree, their signatures do: a few bits for each n-gram, set where an odd number of
n-grams falls. No more bits differ than n-grams do, so a pair that is too far apart by signature is out
for certain; the whole sets are gathered for the other pairs only.

A tree holds sets in the global order, frequent n-grams first, and shares what they begin with.
A probe walks it with the overlap so far and leaves a branch when the overlap can't reach what the
branch's sets need, given how many n-grams remain on both sides. So overlaps are exact.

Null or blank text: the empty set, linked with nothing. Rows without an id have no component (null)
and link nothing. Repeated rows are documents like others. Hashes have 64 bits, of which 52 and the
frequency class are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.llm.shared import KeyFilter, Shipped, documents, slices, written
from gustline.llm.word_hashes import U, shingle_sets

BUCKETS = 1 << 18  # of the sketch, whatever the input
BLOCK = 256  # sets in one tree


# similarity in whole numbers: the overlap is at least percent/100 of the union


def needed(a: int, b: int, percent: int) -> int:
    """The least overlap of sets of these sizes."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n, percent: int):
    """So many of the first elements hold one of any common overlap with a set of whatever size."""
    return n - -(-percent * n // 100) + 1


def prefix_length_of(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100) + 1


def reach(n, position, percent: int):
    """The largest partner whose first common element can stand at this position (from 0) of a set of n.

    From there on ``n - position`` elements are left, and the overlap that two sizes need must fit in them.
    """
    return (100 + percent) * (n - position) // percent - n


# sets


def signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def node_of(hashes: np.ndarray) -> int:
    return signed(xxhash.xxh3_64_intdigest(hashes.tobytes()))


def signature(hashes: np.ndarray) -> bytes:
    """Four to eight bits for each hash: whether an odd number of hashes ends with the bit's number."""
    bits = min(max((len(hashes) - 1).bit_length() + 2, 6), 24)
    counts = np.bincount((hashes & U((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
    return np.packbits((counts & 1).astype(bool), bitorder="little").tobytes()


def difference(a: np.ndarray, b: np.ndarray) -> int:
    """At least so many elements are in one of the sets only, by their signatures as whole 64-bit words.

    Each such element changes one bit. A longer signature is folded to the length of the other.
    """
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    elif len(b) > len(a):
        b = np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def counted_sets(df: DataFrame, words: int) -> DataFrame:
    """doc_id, key, n, node and signature of each document; and rows of bucket and count for the sketch."""
    names = ("doc_id", "key", "n", "node", "bucket", "count")
    schema = pa.schema([(c, pa.int64()) for c in names] + [("sign", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, "text"):
            hashes, first = shingle_sets(batch.column("text"), words)
            sketch += np.bincount(hashes & U(BUCKETS - 1), minlength=BUCKETS)
            n = np.diff(first)
            sets = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            nodes, signs = [node_of(s) for s in sets], [signature(s) for s in sets]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(n), pa.array(nodes, pa.int64()), none, none]
                + [pa.array(signs, pa.binary())],
                schema=schema,
            )
        used = np.flatnonzero(sketch)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(used), pa.array(sketch[used]), pa.nulls(len(used), pa.binary())], schema=schema
        )

    return df.mapInArrow(count, "doc_id long, key long, n long, node long, bucket long, count long, sign binary")


class Order:
    """The global order: 12 bits of frequency class, then 52 bits of the hash."""

    def __init__(self, sketch: np.ndarray):
        self.classes = np.minimum(np.log2(np.maximum(sketch, 1)) * 64, 4095).astype(np.uint16)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        return (self.classes[hashes & U(BUCKETS - 1)].astype(U) << U(52)) | (hashes >> U(12))

    def sets(self, texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
        """Node and sorted keys of each text."""
        hashes, first = shingle_sets(texts, words)
        keys = self.keys(hashes)
        for a, b in zip(first[:-1], first[1:], strict=True):
            yield node_of(hashes[a:b]), np.sort(keys[a:b])


# the tree


class PrefixTree:
    """Sets as paths, with runs of single children kept together.

    A node is (keys, children, set's number or -1, smallest and largest size of the sets below).
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        paths = [np.ascontiguousarray(s[::-1]) for s in sets]  # frequent first
        order = sorted(range(len(paths)), key=lambda i: paths[i].astype(">u8").tobytes())
        self.root = self._grown([paths[i] for i in order], order, 0)

    def _grown(self, paths: list[np.ndarray], numbers: list[int], depth: int):
        """The node for sorted paths that agree up to ``depth``; no recursion for runs."""
        first, last = paths[0], paths[-1]
        reach = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:reach] != last[depth:reach])
        end = depth + int(differ[0]) if len(differ) else reach
        # Sorted as bytes, so what the first and the last share, all share.
        here = [n for p, n in zip(paths, numbers, strict=True) if len(p) == end]
        rest = [(p, n) for p, n in zip(paths, numbers, strict=True) if len(p) > end]
        children = []
        start = 0
        for i in range(1, len(rest) + 1):
            if i == len(rest) or rest[i][0][end] != rest[start][0][end]:
                own = rest[start:i]
                children.append(self._grown([p for p, _ in own], [n for _, n in own], end))
                start = i
        sizes = [self.sizes[n] for n in numbers]
        return first[depth:end], children, here, min(sizes), max(sizes)

    def linked(self, probe: np.ndarray, percent: int) -> Iterator[int]:
        """Numbers of the sets whose similarity with the probe reaches the percentage."""
        size = len(probe)
        stack = [(self.root, 0, 0)]
        while stack:
            (keys, children, here, least, most), depth, overlap = stack.pop()
            if 100 * min(size, most) < percent * max(size, least):
                continue
            depth += len(keys)
            remaining = size
            if len(keys):
                at = np.searchsorted(probe, keys)
                at_or_end = np.minimum(at, size - 1)
                overlap += int((probe[at_or_end] == keys).sum())
                # Keys fall along a path: what is left of the probe lies below the last one.
                remaining = int(at[-1])
            if here and overlap >= needed(size, depth, percent):
                yield from here
            if overlap + min(remaining, most - depth) >= needed(size, least, percent):
                stack += [(child, depth, overlap) for child in children]


# candidates


def star_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """hub and node: each set of a list with the list's first hub of a fitting size; without one it becomes a hub.

    Lists go by the share of a node's prefix that others share, then by node: the same order in all lists, so
    a family's lists agree on few hubs. A text that others were made from has no n-grams of its own in its
    prefix, so it comes before its copies and is near them all. A list has at most one hub for each power of
    100/percent in size.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, list_hubs = None, []
        for batch in batches:
            hubs, nodes = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("token", "n", "node")), strict=True)
            for t, n, node in rows:
                if t != token:
                    token, list_hubs = t, []
                for size, hub in list_hubs:
                    if 100 * min(size, n) >= percent * max(size, n):
                        if hub != node:
                            hubs.append(hub)
                            nodes.append(node)
                        break
                else:
                    list_hubs.append((n, node))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hubs, pa.int64()), pa.array(nodes, pa.int64())], names=["hub", "node"]
            )

    lists = postings.select("token", "n", "node", "share").repartition("token")
    ordered = lists.sortWithinPartitions("token", F.desc("share"), "node")
    return ordered.mapInArrow(pairs, "hub long, node long").distinct()


def component_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Different components a < b that share a list with sets whose sizes and positions fit.

    In the list of two sets' first common element, each is no larger than the other's reach; so every link is
    found there, and lists of later common elements may pass it by.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, window, done = None, {}, set()
        for batch in batches:
            found = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("token", "n", "reach", "component")), strict=True)
            for t, n, most, component in rows:
                if t != token:
                    token, window, done = t, {}, set()
                # Sizes ascend. Per component, its smallest set and its largest reach so far decide.
                for other, (least, its_most) in list(window.items()):
                    if its_most < n:
                        del window[other]
                    elif least <= most and other != component:
                        pair = (min(other, component), max(other, component))
                        if pair not in done:
                            done.add(pair)
                            found.append(pair)
                least, its_most = window.get(component, (n, most))
                window[component] = least, max(its_most, most)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    ordered = (
        postings.groupBy("token", "n", "component")
        .agg(F.max("reach").alias("reach"))
        .repartition("token")
        .sortWithinPartitions("token", "n", "component")
    )
    return ordered.mapInArrow(pairs, "a long, b long").distinct()


def in_blocks(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members and probes for pairs of hub and node: each hub is probed against trees of its nodes."""
    blocks = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    members = pairs.join(blocks, "hub").select(F.col("hub").alias("tree"), block.alias("block"), "node")
    probes = blocks.select(
        F.col("hub").alias("tree"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.col("hub").alias("node"),
    )
    return members, probes


def near_signatures(members: DataFrame, probes: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """hub (the probe) and node (the member) of pairs whose signatures don't rule the similarity out."""
    rows = (
        members.select("tree", "block", "node", F.lit(0).alias("probe"))
        .union(probes.select("tree", "block", "node", F.lit(1).alias("probe")))
        .join(signatures.select("node", "n", "sign"), "node")
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "probe")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members = None, []
        for batch in batches:
            hubs, nodes = [], []
            columns = (batch.column(c).to_pylist() for c in ("tree", "block", "node", "probe", "n", "sign"))
            for name, block, node, probe, n, sign in zip(*columns, strict=True):
                if (name, block) != at:
                    at, members = (name, block), []
                sign = np.frombuffer(sign, U)
                if not probe:
                    members.append((node, n, sign))
                    continue
                for other, m, its in members:
                    least = needed(n, m, percent)
                    if other != node and least <= min(n, m) and difference(sign, its) <= n + m - 2 * least:
                        hubs.append(node)
                        nodes.append(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hubs, pa.int64()), pa.array(nodes, pa.int64())], names=["hub", "node"]
            )

    return rows.mapInArrow(compare, "hub long, node long")


def probed(members: DataFrame, probes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b between the probes and the members of the same tree; trees are named by ``tree`` and ``block``."""
    rows = (
        members.select("tree", "block", "node", F.lit(0).alias("probe"))
        .union(probes.select("tree", "block", "node", F.lit(1).alias("probe")))
        .join(sets, "node")
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "probe")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, sets, tree = None, [], [], None
        for batch in batches:
            a, b = [], []
            columns = (batch.column(c).to_pylist() for c in ("tree", "block", "node", "probe", "keys"))
            for name, block, node, probe, keys in zip(*columns, strict=True):
                if (name, block) != at:
                    at, nodes, sets, tree = (name, block), [], [], None
                keys = np.frombuffer(keys, U)
                if not probe:
                    nodes.append(node)
                    sets.append(keys)
                    continue
                if not sets:
                    continue
                tree = tree or PrefixTree(sets)
                own = [nodes[i] for i in tree.linked(keys, percent)]
                a += [node] * len(own)
                b += own
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(link, "a long, b long")


# components


def components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable), for all nodes of the links.

    Alternating large and small stars: neighbours are linked to the smallest neighbour until nothing
    changes. Only minima are gathered per node, so a node of any degree costs no memory.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = written(edges, "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every node also keeps its own way to the smallest.
        large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(smallest.select("u", F.col("m").alias("v")))
        edges = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        edges = written(edges, "stars")
        summary = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if summary == state:
            break
        state = summary
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.union(edges.select("v", "v").distinct().toDF("node", "component"))


# the join


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id for every row, the set's node and its component (both by the set
    alone), and ``key``, a hash of the text that tells rows of one id apart.
    """
    spark = df.sparkSession
    docs = documents(df, id_col=id_col, text_col=text_col)
    counted = written(counted_sets(docs.withColumn("key", F.xxhash64("text")), words), "shingle-sets")
    sketch = np.zeros(BUCKETS, np.int64)
    for row in counted.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("count")).collect():
        sketch[row[0]] = row[1]
    order = Shipped(spark, Order(sketch))
    nodes = counted.where("bucket IS NULL").select("doc_id", "key", "n", "node", "sign")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies in one task give one list entry
        for batch in slices(batches, "text"):
            tokens, sizes, reaches, owners = [], [], [], []
            for node, keys in order.value.sets(batch.column("text"), words):
                if not len(keys) or node in seen:
                    continue
                seen.add(node)
                own = keys[: prefix_length(len(keys), percent)]
                tokens.append(own)
                sizes.append(np.full(len(own), len(keys)))
                reaches.append(reach(len(keys), np.arange(len(own)), percent))
                owners.append(np.full(len(own), node))
            if len(seen) > 1_000_000:
                seen.clear()
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64))]
                    + [pa.array(np.concatenate(x)) for x in (sizes, reaches, owners)],
                    names=["token", "n", "reach", "node"],
                )

    def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries of lists with two nodes or more. Lists go through in order; only the last entry is held back."""
        held = None  # (token, n, reach, node)
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("token", "n", "reach", "node")]
            if held is not None:
                columns = [np.concatenate([[h], x]) for h, x in zip(held, columns)]
            token, node = columns[0], columns[-1]
            if not len(token):
                continue
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            columns = [x[new] for x in columns]
            token = columns[0]
            same = token[1:] == token[:-1]
            shared = np.zeros(len(token), bool)
            shared[1:] |= same
            shared[:-1] |= same
            # The last entry is decided with the next batch; it comes again if its list goes on.
            held = tuple(x[-1] for x in columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[shared].astype(np.int64)) for x in columns], names=["token", "n", "reach", "node"]
            )

    identified = docs.where("doc_id IS NOT NULL")
    ordered = (
        identified.select("text")
        .mapInArrow(prefixes, "token long, n long, reach long, node long")
        .repartition("token")
        .sortWithinPartitions("token", "n", "node")
    )
    postings = written(ordered.mapInArrow(shared_only, "token long, n long, reach long, node long"), "prefix-lists")

    entries = postings.groupBy("node").agg(F.count("*").alias("entries"))
    signatures = written(
        nodes.join(entries, "node")
        .groupBy("node")
        .agg(*(F.first(c).alias(c) for c in ("n", "sign", "entries")))
        .select("node", "n", "sign", (F.col("entries") / prefix_length_of(F.col("n"), percent)).alias("share")),
        "signatures",
    )

    def linked(pairs: DataFrame) -> DataFrame:
        """Those pairs of hub and node that reach the similarity, as a and b."""
        wanted = KeyFilter(pairs.select(F.explode(F.array("hub", "node")).alias("node")))
        wanted = Shipped(spark, wanted)

        def ordered_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in slices(batches, "text"):
                out, sets = [], []
                for node, keys in order.value.sets(batch.column("text"), words):
                    if wanted.value.passes(node) and node not in seen and len(keys):
                        seen.add(node)
                        out.append(node)
                        sets.append(keys.tobytes())
                if len(seen) > 1_000_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out, pa.int64()), pa.array(sets, pa.binary())], names=["node", "keys"]
                )

        sets = identified.select("text").mapInArrow(ordered_sets, "node long, keys binary")
        sets = sets.groupBy("node").agg(F.first("keys").alias("keys"))
        return probed(*in_blocks(pairs), sets, percent)

    # 1. stars
    stars = star_pairs(postings.join(signatures.select("node", "share"), "node"), percent)
    near = written(near_signatures(*in_blocks(stars), signatures, percent), "stars-to-check")
    star_links = written(linked(near), "star-links")
    families = written(components(star_links), "families")

    # 2. the rest
    labelled = (
        postings.join(families, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .select("token", "n", "reach", "component")
    )
    pairs = written(component_pairs(labelled, percent), "components-to-compare")
    involved = pairs.select("a").union(pairs.select("b")).distinct().toDF("component")
    inside = families.join(involved, "component", "left_semi")
    alone = involved.join(families.select("component").distinct(), "component", "left_anti")
    inside = written(inside.select("component", "node").union(alone.select("component", "component")), "involved")
    sizes = inside.groupBy("component").agg(F.count("*").alias("size"))
    a, b = (sizes.select(F.col("component").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    larger_first = F.col("size_a") >= F.col("size_b")
    sided = written(
        pairs.join(a, "a")
        .join(b, "b")
        .select(
            F.when(larger_first, F.col("a")).otherwise(F.col("b")).alias("tree"),
            F.when(larger_first, F.col("b")).otherwise(F.col("a")).alias("component"),
            F.ceil(F.greatest("size_a", "size_b") / BLOCK).alias("blocks"),
        ),
        "sided-pairs",
    )
    trees = sided.select("tree", "blocks").distinct()
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    tree_members = trees.join(inside.withColumnRenamed("component", "tree"), "tree").select(
        "tree", block.alias("block"), "node"
    )
    tree_probes = sided.join(inside, "component").select(
        "tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "node"
    )
    rest = near_signatures(tree_members, tree_probes, signatures, percent)
    # Stars have been checked.
    either_way = near.select("hub", "node").union(near.select(F.col("node").alias("hub"), F.col("hub").alias("node")))
    rest = written(rest.join(either_way, ["hub", "node"], "left_anti"), "rest-to-check")
    more_links = linked(rest)
    family_links = families.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = written(components(family_links.union(more_links)), "components")

    # Back to the documents.
    own = nodes.where("doc_id IS NOT NULL AND n > 0").join(final, "node", "left")
    own = own.select("doc_id", "key", "n", "node", F.coalesce("component", "node").alias("component"))
    smallest = own.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = own.join(smallest, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "node", "component", "key")
    rest = nodes.where("doc_id IS NULL OR n = 0").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).alias("component_id"),
        "node",
        F.col("node").alias("component"),
        "key",
    )
    return linked.union(rest)

