"""Best-fit packing of tokenised documents into sequences, by a linear grouping scheme.

Only the number of pieces of each length matters for a plan, and there are at most ``capacity``
lengths, so the plan is made on the driver of a histogram of bounded size:

1. Large lengths are put into groups of equal cardinality and rounded up to the largest of a group.
2. A linear program over all configurations of these few sizes says how often to use each.
3. Actual pieces, longest first, take the slots of their group; what rounding left stays free.
4. Small pieces, longest first, go where they leave the least space (best fit), in bulk per length.

The pieces then look up their places by length and rank. Ranks within a length come from counts per
(length, salt) and a row number within each, so a length that a third of all pieces share is dealt
over many tasks.

Null text is an empty document: its only token is the end mark. Every row counts as a document,
repeated rows too. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.shared import Shipped, batch_of, documents, slices, worker_cache, written

GROUPS = 20  # of large lengths
PER_BIN = 3  # large pieces are those of which at most so many fit into a sequence
PER_SALT = 200_000  # pieces
WORD_END = "</w>"  # fixed value: how the vocabulary marks the last token of a word
MEMO = 3 << 18  # words whose ids a worker remembers before it starts afresh

Pattern = list[tuple[int, int]]  # length and number of pieces of that length in one sequence


# the plan


def configurations(sizes: list[int], capacity: int) -> np.ndarray:
    """Every way to put up to PER_BIN pieces of these sizes into a sequence, as counts per size."""
    rows = []
    for n in range(1, PER_BIN + 1):
        for picked in combinations_with_replacement(range(len(sizes)), n):
            if sum(sizes[i] for i in picked) <= capacity:
                rows.append(np.bincount(picked, minlength=len(sizes)))
    return np.array(rows, dtype=float)


def fewest_sequences(ways: np.ndarray, need: np.ndarray) -> np.ndarray:
    """How often to use each way so that the needs are met by the fewest sequences; fractions allowed.

    Revised simplex method; the start uses a sequence of its own for every piece.
    """
    k = len(need)
    alone = [int(np.flatnonzero((ways.sum(axis=1) == 1) & (ways[:, j] == 1))[0]) for j in range(k)]
    basis, inverse, amount = list(alone), np.eye(k), need.astype(float)
    for _ in range(50 * k):
        worth = ways @ inverse.sum(axis=0)
        enter = int(worth.argmax())
        if worth[enter] <= 1 + 1e-9:
            break
        direction = inverse @ ways[enter]
        rows = np.flatnonzero(direction > 1e-9)
        leave = int(rows[(amount[rows] / direction[rows]).argmin()])
        step = amount[leave] / direction[leave]
        amount -= step * direction
        amount[leave] = step
        pivot = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, pivot)
        inverse[leave] = pivot
        basis[leave] = enter
    used = np.zeros(len(ways))
    np.add.at(used, basis, np.maximum(amount, 0))
    return used


def grouped_patterns(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Steps 1 to 3; takes what it places out of ``counts``."""
    large = sorted((n for n in counts if capacity // (PER_BIN + 1) < n < capacity and counts[n]), reverse=True)
    total = sum(counts[n] for n in large)
    if not total:
        return []
    groups: list[list[list[int]]] = []  # of each group, lengths with counts, longest first
    room = 0
    for length in large:
        left = counts[length]
        while left:
            if not room:
                room = -(-total // GROUPS)
                groups.append([])
            take = min(room, left)
            groups[-1].append([length, take])
            room -= take
            left -= take
    ways = configurations([g[0][0] for g in groups], capacity)
    used = fewest_sequences(ways, np.array([sum(n for _, n in g) for g in groups]))
    out = []
    # Fractions of sequences are left out here; their pieces are placed by best fit.
    for way, times in sorted(zip(ways.astype(int).tolist(), np.floor(used + 1e-6).astype(int), strict=True), reverse=True):
        slots = [j for j, n in enumerate(way) for _ in range(n)]
        left = int(min([times, *(sum(n for _, n in groups[j]) // m for j, m in enumerate(way) if m)]))
        while left:
            # As long as each slot's pieces keep their length, sequences look alike.
            heads: dict[int, int] = defaultdict(int)
            for j in slots:
                heads[j] += 1
            same = left
            pattern: dict[int, int] = defaultdict(int)
            for j, m in heads.items():
                length, n = groups[j][0]
                if n >= m:
                    same = min(same, n // m)
                else:
                    same = 1
            for j, m in heads.items():
                need = m * same
                while need:
                    length, n = groups[j][0]
                    take = min(n, need)
                    pattern[length] += take // same if same > 1 else take
                    counts[length] -= take
                    need -= take
                    if n == take:
                        groups[j].pop(0)
                    else:
                        groups[j][0][1] -= take
            out.append((sorted(pattern.items(), reverse=True), same))
            left -= same
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of sequences, each with the number of its sequences. All pieces are placed."""
    counts = dict(histogram)
    patterns = [([(capacity, 1)], counts.pop(capacity))] if counts.get(capacity) else []
    open_bins: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)  # by free space
    spaces: list[int] = []

    def put(pattern: Pattern, times: int, free: int) -> None:
        if not free:
            patterns.append((pattern, times))
            return
        if not open_bins[free]:
            insort(spaces, free)
        open_bins[free].append((pattern, times))

    for pattern, times in grouped_patterns(counts, capacity):
        put(pattern, times, capacity - sum(n * m for n, m in pattern))
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                free, pattern, times = capacity, [], left
            else:
                free = spaces[at]
                pattern, times = open_bins[free].pop()
                if not open_bins[free]:
                    spaces.pop(at)
            each = free // length
            full = min(times, left // each)
            if full:
                put([*pattern, (length, each)], full, free - each * length)
                left -= full * each
                times -= full
            if left and times and left < each:
                put([*pattern, (length, left)], 1, free - left * length)
                left, times = 0, times - 1
            if times and pattern:
                put(pattern, times, free)
    for groups in open_bins.values():
        patterns += groups
    return patterns


class Places:
    """For each length, ranges of ranks with the sequence and offset of the first piece."""

    def __init__(self, patterns: list[tuple[Pattern, int]]):
        ranges: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        used: dict[int, int] = defaultdict(int)
        sequence = 0
        for pattern, times in patterns:
            offset = 0
            for length, each in pattern:
                ranges[length].append((used[length], sequence, each, offset))
                used[length] += each * times
                offset += length * each
            sequence += times
        self.sequences = sequence
        self.ranges = {length: np.array(rows, np.int64).T for length, rows in ranges.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequences, offsets = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        for length in np.unique(lengths):
            own = lengths == length
            first, sequence, each, offset = self.ranges[int(length)]
            at = np.searchsorted(first, ranks[own], "right") - 1
            turn, place = np.divmod(ranks[own] - first[at], each[at])
            sequences[own] = sequence[at] + turn
            offsets[own] = offset[at] + place * length
        return sequences, offsets


# the tokens


class WordIds:
    """Token ids as bytes. The tokenizer drops white space, so words can be looked up one by one."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has its one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # A full stop or comma between a letter and white space is a token of its own. Not so after the
        # one letter whose lower case ends with a mark, which goes together with the stop.
        stop = "[.,](?=[ \n\t\r]|$)"
        self.words = re.compile(rf"[^\W\d_İ]+(?={stop})|(?<=[^\W\d_İ]){stop}|[^ \n\t\r]+").findall

    def encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def learn(self, words: list[str]) -> None:
        """Letters alone make one word of the tokenizer, so many can be encoded at once and told apart again."""
        plain = [w for w in words if w.lower().isalpha()]
        for start in range(0, len(plain), 1000):
            part = plain[start : start + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            data = ids.tobytes()
            self.memo.update((w, data[a:b]) for w, a, b in zip(part, [0, *ends], ends, strict=False))
            if len(ends) != len(part):
                self.memo.update(zip(part, self.encoded(part), strict=True))
        rest = [w for w in words if not w.lower().isalpha()]
        for start in range(0, len(rest), 10_000):
            part = rest[start : start + 10_000]
            self.memo.update(zip(part, self.encoded(part), strict=True))

    def of(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        # Special strings may take white space with them: such a text is encoded as it is.
        whole = [any(s in text for s in self.special) for text in texts]
        split = [
            [] if w else self.words(text.lower() if text.isascii() else text)
            for text, w in zip(texts, whole, strict=True)
        ]
        self.learn(list(set().union(*split).difference(memo)))
        for text, words, w in zip(texts, split, whole, strict=True):
            yield self.encoded([text])[0] if w else b"".join(map(memo.__getitem__, words))


def token_pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32, and the ids if asked for."""
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
        + [("ids", pa.binary())] * with_ids
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache("word_ids")
        words = known.get(tokenizer) or known.setdefault(tokenizer, WordIds(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text"):
            rows = []
            ids = batch.column("doc_id").to_pylist()
            for doc_id, tokens in zip(ids, words.of([t or "" for t in batch.column("text").to_pylist()]), strict=True):
                tokens += end
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    own = tokens[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)) + (own,) * with_ids)
            yield batch_of(schema, list(map(list, zip(*rows, strict=True))) if rows else [[]] * len(schema))

    columns = "doc_id long, piece long, start long, length long, ids_crc32 long"
    return documents(df).mapInArrow(cut, columns + ", ids binary" * with_ids)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """The pieces with sequence_id and offset. ``pieces`` should be a written table: it is read twice."""
    spark = pieces.sparkSession
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    places = Shipped(spark, Places(plan(histogram, capacity)))
    salts = max(16, -(-sum(histogram.values()) // PER_SALT))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = (
        salted.withColumn("rank", F.row_number().over(within) - 1)
        .join(first, ["length", "salt"])
        .withColumn("rank", F.col("first") + F.col("rank"))
        .select(*pieces.columns, "rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            found = places.value.find(lengths, ranks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in batch.schema.names if name != "rank"] + [pa.array(x) for x in found],
                names=[n for n in batch.schema.names if n != "rank"] + ["sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, pieces.schema.add("sequence_id", "long").add("offset", "long"))


def pack_documents(
    df: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False
) -> DataFrame:
    """Tokenises and packs; one row per piece. Documents are cut only where they are longer than a sequence."""
    return pack(written(token_pieces(df, tokenizer, capacity, end_id, with_ids), "token-pieces"), capacity)
