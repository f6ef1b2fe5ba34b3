"""Line deduplication with a log-template tree of fixed depth.

A line's path in the tree is its number of tokens, its leading tokens and its last one, where tokens
with digits count as variable fields. In a leaf, lines that agree in enough of their tokens share a
template, and the tokens in which they differ become variable fields too. A template that recurs
across documents is dropped from all of them but the first (by id), so no content is lost whole.

Copies of a line within a document, and of a line across documents, are combined in the map tasks
before the tree is built, so a line that a third of all documents share is one row per task. A leaf
is streamed and keeps all its templates open; in a large one, an index by position and token finds
every template that a line may join.

Lines with fewer tokens than ``min_tokens`` stay. Null text stays null, empty text empty. Rows that
repeat id and text count as one document and are changed alike; a null id sorts last.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.shared import slices, written

SCANNED = 1024  # templates of a leaf that are compared one and all; more are looked up first
FIELD = "<*>"
has_digit = re.compile("[0-9]").search


def masked(tokens: list[str]) -> list[str]:
    return [FIELD if has_digit(t) else t for t in tokens]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def line_key(line: str, min_tokens: int) -> tuple[list[str], int] | None:
    """The masked tokens and their hash; none for short lines."""
    tokens = line.split()
    if len(tokens) < min_tokens:
        return None
    if has_digit(line):
        tokens = masked(tokens)
    return tokens, signed(xxhash.xxh3_64_intdigest(" ".join(tokens)))


def leaf(tokens: list[str], depth: int) -> int:
    return signed(xxhash.xxh3_64_intdigest("\n".join([str(len(tokens)), *tokens[:depth], tokens[-1]])))


class Templates:
    """The templates of one leaf, as arrays of token numbers; 0 is a variable field."""

    def __init__(self, width: int):
        self.width, self.numbers, self.ids = width, {FIELD: 0}, []
        self.rows = np.empty((16, width), np.int32)
        # For each position and token the templates that had it there when they were opened.
        self.holders: dict[tuple[int, int], array] = {}

    def _index(self, n: int) -> None:
        for at, token in enumerate(self.rows[n].tolist()):
            if token:
                self.holders.setdefault((at, token), array("i")).append(n)

    def _candidates(self, line: np.ndarray, similarity: float) -> np.ndarray:
        """Every template that can be alike enough, in order.

        At least ``similarity`` squared of the width must be equal, so of the rarest positions one more
        than may differ hold an equal token.
        """
        held = [self.holders.get((at, token), ()) for at, token in enumerate(line.tolist()) if token]
        least = max(1, ceil(similarity * similarity * self.width - 1e-9))
        held = sorted(held, key=len)[: max(0, len(held) - least + 1)]
        found = [np.frombuffer(h, np.int32) for h in held if len(h)]
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int32)

    def place(self, tokens: list[str], key: int, similarity: float) -> int:
        """The key of the first line of the template that this line joins or opens."""
        numbers = self.numbers
        line = np.array([numbers.setdefault(t, len(numbers)) for t in tokens], np.int32)
        n = len(self.ids)
        if n < SCANNED:
            among, rows = None, self.rows[:n]
        else:
            among = self._candidates(line, similarity)
            rows = self.rows[among]
        if len(rows):
            # A variable field neither speaks for nor against; at least one token must be equal.
            fields = (rows == 0) | (line == 0)
            equal = ((rows == line) & ~fields).sum(axis=1)
            compared = np.maximum(self.width - (fields.sum(axis=1)), 1)
            score = np.where(equal >= similarity * np.maximum(compared, self.width * similarity), equal, -1)
            best = int(score.argmax())
            if score[best] > 0:
                best = best if among is None else int(among[best])
                self.rows[best][self.rows[best] != line] = 0
                return self.ids[best]
        if n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[n] = line
        self.ids.append(key)
        if n + 1 == SCANNED:
            for k in range(n):
                self._index(k)
        if n + 1 >= SCANNED:
            self._index(n)
        return key


def drop_recurring_lines(
    df: DataFrame,
    min_docs: int = 3,
    min_tokens: int = 3,
    depth: int = 3,
    similarity: float = 0.75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns, with the text cleaned, and n_lines and n_dropped (long) for each row.

    A template recurs if it stands in ``min_docs`` documents or more.
    """
    document = [
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("key_id"),
        F.xxhash64(F.col(text_col)).alias("key_text"),
    ]
    lines_schema = pa.schema(
        [("key_id", pa.int64()), ("key_text", pa.int64()), ("line", pa.int64()), ("leaf", pa.int64())]
        + [("tokens", pa.string())]
    )

    def parse(batches: Iterator[pa.RecordBatch], whole: bool = True) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns: list[list] = [[] for _ in lines_schema]
            ids, texts = batch.column("key_id").to_pylist(), batch.column("key_text").to_pylist()
            for a, b, text in zip(ids, texts, batch.column("text").to_pylist(), strict=True):
                own = {}
                for line in (text or "").split("\n"):
                    if found := line_key(line, min_tokens):
                        own[found[1]] = found[0]
                columns[0] += [a] * len(own)
                columns[1] += [b] * len(own)
                columns[2] += own
                if whole:
                    columns[3] += [leaf(tokens, depth) for tokens in own.values()]
                    columns[4] += map(" ".join, own.values())
            arrays = [pa.array(c, f.type) for c, f in zip(columns, lines_schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays[: 5 if whole else 3], names=lines_schema.names[: 5 if whole else 3])

    source = df.select(*document, F.col(text_col).cast("string").alias("text"))
    parsed = source.mapInArrow(parse, "key_id long, key_text long, line long, leaf long, tokens string")
    # Of a line in one document only, two lines in one leaf, or nothing: only the first two go on.
    distinct = parsed.groupBy("leaf", "line").agg(
        F.first("tokens").alias("tokens"), F.min("key_id").alias("first"), F.max("key_id").alias("last")
    )
    in_leaf = Window.partitionBy("leaf")
    shared = (
        distinct.withColumn("beside", F.count("*").over(in_leaf))
        .where("beside > 1 OR first < last")
        .select("leaf", "line", "tokens", (F.col("first") < F.col("last")).alias("recurs"))
        .sortWithinPartitions("leaf", "line")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, templates = None, None
        for batch in batches:
            found = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("leaf", "line", "tokens")), strict=True)
            for leaf_key, line, text in rows:
                tokens = text.split(" ")
                if leaf_key != at:
                    at, templates = leaf_key, Templates(len(tokens))
                if len(tokens) != templates.width:  # two paths with one hash
                    found.append(line)
                    continue
                found.append(templates.place(tokens, line, similarity))
            yield pa.RecordBatch.from_arrays(
                [batch.column("line"), pa.array(found, pa.int64())], names=["line", "template"]
            )

    templates = written(shared.mapInArrow(place, "line long, template long"), "line-templates")
    # The same hash in two leaves is one line here.
    templates = templates.groupBy("line").agg(F.min("template").alias("template"))

    keys = source.mapInArrow(lambda batches: parse(batches, whole=False), "key_id long, key_text long, line long")
    held = written(keys.join(templates, "line"), "lines-with-templates")
    recurring = (
        held.select("template", "key_id", "key_text")
        .distinct()
        .groupBy("template")
        .agg(F.count("*").alias("n"), F.min(F.struct("key_id", "key_text")).alias("first"))
        .where(F.col("n") >= min_docs)
    )
    dropped = (
        held.join(recurring, "template")
        .where("key_id <> first.key_id OR key_text <> first.key_text")
        .groupBy("key_id", "key_text")
        .agg(F.collect_set("line").alias("lines_to_drop"))
    )
    spared = [F.col(c) for c in df.columns if c != text_col]
    joined = (
        df.select(*document, F.col(text_col).cast("string").alias("own_text"), F.struct(*spared).alias("other"))
        .join(dropped, ["key_id", "key_text"], "left")
        .select("own_text", "other", "lines_to_drop")
    )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "own_text"):
            texts, all_lines, all_dropped = [], [], []
            drops = batch.column("lines_to_drop").to_pylist()
            for text, drop in zip(batch.column("own_text").to_pylist(), drops, strict=True):
                lines = (text or "").split("\n")
                n = len(lines) if text else 0
                if drop:
                    drop = set(drop)
                    kept = [x for x in lines if not ((found := line_key(x, min_tokens)) and found[1] in drop)]
                    text, lines = "\n".join(kept), kept
                texts.append(text)
                all_lines.append(n)
                all_dropped.append(n - len(lines) if drop else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("other"), pa.array(texts, pa.string())]
                + [pa.array(x, pa.int64()) for x in (all_lines, all_dropped)],
                names=["other", "cleaned", "n_lines", "n_dropped"],
            )

    schema = joined.select("other").schema.add("cleaned", "string").add("n_lines", "long").add("n_dropped", "long")
    result = joined.mapInArrow(clean, schema)
    columns = [F.col("cleaned").alias(c) if c == text_col else F.col("other")[c].alias(c) for c in df.columns]
    return result.select(*columns, "n_lines", "n_dropped")
