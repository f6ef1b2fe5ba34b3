"""Document fingerprints by winnowing.

Every run of ``gram`` code points has a rolling polynomial hash. Of each ``window`` consecutive hashes the least is
chosen, the rightmost of equal ones, and its position is kept. So any ``window + gram - 1`` code points that two
texts share put a common (hash, place in the passage) into both fingerprints, and two chosen positions that follow
each other are at most ``window`` apart.

A text of fewer than ``gram`` code points, but not none, is one run; with fewer runs than a window holds, all are
one window. Null text counts as empty and has an empty fingerprint. A fingerprint is a string of twelve hex
digits a choice: eight of the hash, four of the distance to the choice before (to the beginning, for the first).
Equal texts have equal fingerprints. Likeness is the Jaccard index of the sets of hashes; two empty ones are alike.
Rows come back one for one, repeated rows too.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.shared import batch_of, documents, slices

GRAM, WINDOW = 16, 32
PRIME, BASE = (1 << 31) - 1, 1_103_515_245
STRIDE = 1 << 20  # windows looked at together, so that a very long text needs no more memory
LOW = (1 << 32) - 1
CHOICE = np.dtype([("hash", ">u4"), ("gap", ">u2")])


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hash of each run of ``gram`` values, put together from runs of doubled lengths."""
    power, size = values % PRIME, 1
    whole, length = None, 0
    while True:
        if gram & size:
            if whole is None:
                whole = power
            else:
                n = min(len(whole), len(power) - length)
                whole = (whole[:n] * pow(BASE, size, PRIME) + power[length : length + n]) % PRIME
            length += size
        if length == gram:
            return whole[: len(values) - gram + 1]
        power = (power[:-size] * pow(BASE, size, PRIME) + power[size:]) % PRIME
        size *= 2


def sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    size = 1
    while size * 2 <= window:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = window - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Fingerprint:
    """Chosen hashes and their positions."""

    def __init__(self, hashes: np.ndarray, positions: np.ndarray):
        self.hashes, self.positions = hashes, positions

    def __str__(self) -> str:
        out = np.empty(len(self.hashes), CHOICE)
        out["hash"] = self.hashes
        out["gap"] = np.diff(self.positions, prepend=0)
        return out.tobytes().hex()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        read = np.frombuffer(bytes.fromhex(text), CHOICE)
        return cls(read["hash"].astype(np.int64), np.cumsum(read["gap"].astype(np.int64)))

    def likeness(self, other: Fingerprint) -> float:
        mine, theirs = set(self.hashes.tolist()), set(other.hashes.tolist())
        return len(mine & theirs) / len(mine | theirs) if mine or theirs else 1.0

    def shared(self, other: Fingerprint) -> list[tuple[int, int]]:
        """Pairs of positions with equal hashes."""
        at: dict[int, list[int]] = {}
        for h, place in zip(other.hashes.tolist(), other.positions.tolist()):
            at.setdefault(h, []).append(place)
        return [(p, q) for h, p in zip(self.hashes.tolist(), self.positions.tolist()) for q in at.get(h, ())]


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> Fingerprint:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    gram = min(gram, len(codes))
    grams = len(codes) - gram + 1 if len(codes) else 0
    window = min(window, grams)
    chosen, last = [], -1
    for start in range(0, grams - window + 1 if grams else 0, STRIDE):
        end = min(start + STRIDE, grams - window + 1)
        values = codes[start : end + window + gram - 2].astype(np.int64) + 1
        places = np.arange(start, start + len(values) - gram + 1)
        least = sliding_least((gram_hashes(values, gram) << 32) | (LOW - places), window)
        new = np.empty(len(least), bool)
        new[0] = least[0] != last
        np.not_equal(least[1:], least[:-1], out=new[1:])
        last = least[-1]
        chosen.append(least[new])
    keys = np.concatenate(chosen) if chosen else np.empty(0, np.int64)
    return Fingerprint(keys >> 32, LOW - (keys & LOW))


def document_fingerprints(
    df: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_chars (code points) and the fingerprint of every row, without a shuffle."""
    if not 0 < window < 1 << 16 or gram < 1:
        raise ValueError("A run has at least one code point, a window 1 to 65,535 runs")
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            yield batch_of(schema, [batch.column("doc_id"), list(map(len, texts)), [str(fingerprint(t, gram, window)) for t in texts]])

    return documents(df, id_col=id_col, text_col=text_col).mapInArrow(marks, "doc_id long, n_chars long, fingerprint string")


def ranges(docs: DataFrame, rows_of_a_range: int = 256) -> list[tuple[bool, int, int]]:
    """The first (has an id, id, hash of the text) of each range of documents in their order.

    Their number is bounded by four times the session's shuffle partitions, however many documents there are.
    """
    most = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = max(1, min(most, docs.count() // rows_of_a_range))
    firsts = (
        docs.select("doc_id", "tie")
        .repartitionByRange(number, "doc_id", "tie")
        .withColumn("part", F.spark_partition_id())
        .groupBy("part")
        .agg(F.min(F.struct("doc_id", "tie")).alias("first"))
        .collect()
    )
    return sorted((r.first.doc_id is not None, r.first.doc_id or 0, r.first.tie) for r in firsts)


EDITED = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
EDITED_TYPES = (
    "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints_of_edits(
    df: DataFrame, share: int = 4, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each document's fingerprint beside that of an edited text, and how like it and the next document are.

    The edit replaces the last 1 / ``share`` (rounded down) of a text by as many code points, or all, from the
    beginning of the next document; after the last one comes the first. Documents are ordered by id, null first,
    and rows of one id by a hash of their text.

    Documents are dealt to ranges of that order; each range also gets the first document of the next one. Rows of
    the same id and text stay in one range.
    """
    docs = documents(df, id_col=id_col, text_col=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    firsts = ranges(docs)

    @F.arrow_udf("int")
    def place(ids: pa.Array, ties: pa.Array) -> pa.Array:
        keys = [(i is not None, i or 0, t) for i, t in zip(ids.to_pylist(), ties.to_pylist())]
        own = [bisect_right(firsts, key) - 1 for key in keys]
        return pa.array([2 * i + (firsts[i] == key) for i, key in zip(own, keys)], pa.int32())

    own = F.shiftright("place", 1)
    entry = lambda part, ahead: F.struct(part.alias("part"), F.lit(ahead).alias("ahead"))
    entries = F.when(
        F.col("place") % 2 == 1, F.array(entry(own, False), entry(F.pmod(own - 1, F.lit(max(len(firsts), 1))), True))
    ).otherwise(F.array(entry(own, False)))
    dealt = (
        docs.withColumn("place", place("doc_id", "tie"))
        .select("doc_id", "text", "tie", F.inline(entries))
        .repartition("part")
        .sortWithinPartitions("part", "ahead", "doc_id", "tie")
        .select("doc_id", "text", "ahead")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in slices(batches, "text"):
            out = []
            for doc_id, text, ahead in zip(*(c.to_pylist() for c in batch.columns)):
                marks = fingerprint(text, gram, window)
                if before is not None:
                    own_id, own_text, own_marks = before
                    size = len(own_text)
                    gone = size // share
                    edited = own_text[: size - gone] + text[:gone]
                    edited_marks = fingerprint(edited, gram, window)
                    near = own_marks.likeness(edited_marks), own_marks.likeness(marks)
                    out.append((own_id, size, edited, str(own_marks), str(edited_marks), *near))
                before = None if ahead else (doc_id, text, marks)
            if out:
                yield batch_of(EDITED, list(zip(*out)))

    return dealt.mapInArrow(compare, EDITED_TYPES)
