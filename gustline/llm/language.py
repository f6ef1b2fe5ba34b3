"""Language identification by cross-parsing entropy.

A suffix automaton is built of labelled text for each language. A text is parsed into phrases, each
the longest match in the automaton; the language that needs the fewest phrases, weighted by the bits
that one phrase costs (the logarithm of the automaton's text length), wins.

Texts become symbols first: letters in lower case, everything else one space. They are parsed whole,
in blocks of 256 symbols with a new phrase at each block's start, so that many blocks go through the
automaton side by side.

Null text, or text without a letter: ``und``, score 0. Without any labelled text every row gets that.
Ties go to the language that sorts first. Rows come back one for one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.shared import batch_of, documents, slices, worker_cache

UNKNOWN_LANGUAGE = "und"
BLOCK = 256
DENSE = 94  # letters of a language up to which its transitions are one flat table
SPACE, OTHER, PAD = 0, 1, 2


def lower_letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is none. Made once in each worker."""
    cache = worker_cache("letters")
    if "letters" not in cache:
        found = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                low = c.lower()
                found[point] = ord(low) if len(low) == 1 else point
        cache["letters"] = found
    return cache["letters"]


def letters_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    found = lower_letters()[points]
    # One space for any number of other signs.
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
    return found[keep]


class SuffixAutomaton:
    """Every state's transitions; state 0 is the root."""

    def __init__(self, symbols: list[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in self.next[p]:
                self.next[p][c] = new
                p = link[p]
            if p != -1:
                q = self.next[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new

    def transitions(self, width: int) -> Transitions:
        """States count from 1 and are multiplied by ``width``, the number of symbols."""
        edges = ((state + 1) * width + c for state, own in enumerate(self.next) for c in sorted(own))
        to = ((own[c] + 1) * width for own in self.next for c in sorted(own))
        return Transitions(np.fromiter(edges, np.int64), np.fromiter(to, np.int64), (len(self.next) + 1) * width, width)


class Transitions:
    """Where each state goes by each symbol, 0 if nowhere: a flat table for few symbols, else sorted edges."""

    def __init__(self, edges: np.ndarray, to: np.ndarray, size: int, width: int):
        self.parts = edges, to, size, width
        self.edges, self.to, self.width = edges, to, width
        self.flat = None
        if width <= 3 + DENSE:
            self.flat = np.zeros(size, np.int32)
            self.flat[edges] = to
            self.flat[PAD::width] = np.arange(0, size, width)  # padding changes nothing
        self.dtype = np.int32 if self.flat is not None else np.int64
        # The root's row.
        self.fresh = np.zeros(width, self.dtype)
        first = slice(*np.searchsorted(edges, [width, 2 * width]))
        self.fresh[edges[first] - width] = to[first]
        self.fresh[PAD] = width

    def follow(self, state: np.ndarray, symbols: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        np.add(state, symbols, out=at)
        if self.flat is not None:
            np.take(self.flat, at, out=out, mode="clip")
            return
        place = np.minimum(np.searchsorted(self.edges, at), len(self.edges) - 1)
        out[:] = np.where(self.edges[place] == at, self.to[place], 0)
        np.copyto(out, state, where=symbols == PAD)


class CrossParser:
    """The automata of all languages; ``texts`` has the labelled texts of each."""

    def __init__(self, texts: dict[str, list[str]], size: int):
        joined = {lang: np.concatenate([letters_of(t + " ") for t in own])[:size] for lang, own in texts.items()}
        self.languages = sorted(lang for lang, points in joined.items() if points.any())
        counts = Counter()
        for lang in self.languages:
            counts.update(Counter(joined[lang].tolist()))
        counts.pop(0, None)
        # A decomposed letter may come apart; the most frequent letters come first, ties by code point.
        known = sorted(counts, key=lambda p: (-counts[p], p))
        self.symbol = np.full(0x110000, OTHER, np.int32)
        self.symbol[0] = SPACE
        self.symbol[known] = np.arange(3, 3 + len(known))
        # Each language has an alphabet of its own, of all letters in its text; others never match.
        self.tables, self.own, self.bits = [], [], []
        for lang in self.languages:
            symbols = self.symbol[joined[lang]]
            letters = np.unique(symbols[symbols > PAD])
            own = np.full(3 + len(known), OTHER, np.int32)
            own[[SPACE, PAD]] = SPACE, PAD
            own[letters] = np.arange(3, 3 + len(letters))
            self.own.append(own)
            self.tables.append(SuffixAutomaton(own[symbols].tolist()).transitions(3 + len(letters)))
            self.bits.append(math.log2(len(symbols) + 1))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol for each text and language, and whether the text has a letter."""
        symbols = [letters_of(t) for t in texts]
        has_letter = np.array([bool(s.any()) for s in symbols], bool)
        lengths = np.array([len(s) for s in symbols], np.int64)
        blocks = -(-lengths // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        padded = np.full((int(first[-1]), BLOCK), PAD, np.int32)
        flat = padded.reshape(-1)
        for s, start in zip(symbols, first[:-1] * BLOCK, strict=True):
            flat[start : start + len(s)] = self.symbol[s]
        columns = np.ascontiguousarray(padded.T)
        owner = np.repeat(np.arange(len(texts)), blocks)
        bits = np.empty((len(texts), len(self.languages)))
        for k, table in enumerate(self.tables):
            phrases = np.bincount(owner, self.phrases(table, np.take(self.own[k], columns)), len(texts))
            bits[:, k] = phrases * self.bits[k] / np.maximum(lengths, 1)
        return bits, has_letter

    @staticmethod
    def phrases(table: Transitions, columns: np.ndarray) -> np.ndarray:
        """Phrases of each block, the started one included."""
        root, fresh = table.width, table.fresh.copy()
        nowhere = fresh == 0
        fresh[nowhere] = root  # a symbol that matches nowhere is a phrase of its own
        state = np.full(columns.shape[1], root, table.dtype)
        count = np.ones(columns.shape[1], np.int32)
        at, to = np.empty_like(state), np.empty_like(state)
        missing = np.empty(len(state), bool)
        for symbols in columns:
            table.follow(state, symbols, at, to)
            np.equal(to, 0, out=missing)
            count += missing
            where = np.flatnonzero(missing)
            signs = symbols[where]
            to[where] = fresh[signs]
            count[where] += nowhere[signs] & (state[where] != root)
            state, to = to, state
        return count

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        bits, has_letter = self.entropies(texts)
        out = []
        for row, letters in zip(bits, has_letter, strict=True):
            if not letters:
                out.append((UNKNOWN_LANGUAGE, 0.0))
                continue
            best = int(row.argmin())
            rest = np.delete(row, best)
            score = 1.0 - row[best] / rest.min() if len(rest) else 1.0
            out.append((self.languages[best], float(min(max(score, 0.0), 1.0))))
        return out


def labelled_sample(
    df: DataFrame, lang_col: str, documents_per_language: int, languages: int, characters_per_document: int
) -> dict[str, list[str]]:
    """Texts of the labelled rows with the smallest hash of their id: at most so many for each language.

    The bounds are parameters, so what comes to the driver doesn't grow with the corpus. Each task
    keeps its best rows of a language before the shuffle.
    """
    labelled = documents(df, F.col(lang_col).cast("string").alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL"
    )
    nearest = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        labelled.select("doc_id", "lang")
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= documents_per_language)
        .orderBy("rank", "lang")
        .limit(documents_per_language * languages)
        .collect()
    )
    rank = {(row.doc_id, row.lang): row.rank for row in reversed(ids)}
    rows = (
        labelled.where(F.col("doc_id").isin(sorted({row.doc_id for row in ids})))
        .groupBy("doc_id", "lang")
        .agg(F.min(F.substring("text", 1, characters_per_document)).alias("text"))
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in sorted((r for r in rows if (r.doc_id, r.lang) in rank), key=lambda r: rank[r.doc_id, r.lang]):
        texts.setdefault(row.lang, []).append(row.text)
    return texts


def identify_language(
    df: DataFrame,
    labelled: DataFrame,
    keep: list[str | Column] = (),
    lang_col: str = "lang",
    documents_per_language: int = 60,
    symbols_per_language: int = 30_000,
    languages: int = 100,
    characters_per_document: int = 20_000,
    with_text: bool = False,
) -> DataFrame:
    """Every row of ``df`` with doc_id, the columns ``keep``, lang_pred and score; only the text is looked at.

    ``with_text`` gives the text back too, which then passes through the tasks once.

    The automata are fitted on the driver on a bounded sample of ``labelled``: of each language the
    ``documents_per_language`` rows with the smallest hashed id, cut to ``symbols_per_language``
    symbols in all, learned from the first ``characters_per_document`` of each text; at most ``languages``
    languages. They are then applied to every whole text.
    """
    texts = labelled_sample(labelled, lang_col, documents_per_language, languages, characters_per_document)
    parser = CrossParser(texts, symbols_per_language)
    shared = df.sparkSession.sparkContext.broadcast(
        (parser.languages, parser.bits, np.flatnonzero(parser.symbol != OTHER), parser.symbol[parser.symbol != OTHER],
         parser.own, [t.parts for t in parser.tables])
    )
    source = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    kept = [f for f in source.schema.fields if f.name not in (("doc_id",) if with_text else ("doc_id", "text"))]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, bits, points, symbols, alphabets, tables = shared.value
        own = CrossParser({}, 0)
        own.languages, own.bits, own.own = names, bits, alphabets
        own.symbol[points] = symbols
        own.tables = [Transitions(*parts) for parts in tables]
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = own.predict(texts) if names else [(UNKNOWN_LANGUAGE, 0.0)] * len(texts)
            columns = [batch.column("doc_id"), *(batch.column(f.name) for f in kept)]
            schema = pa.schema(
                [batch.schema.field("doc_id"), *(batch.schema.field(f.name) for f in kept)]
                + [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())]
            )
            yield batch_of(schema, [*columns, [x for x, _ in found], [s for _, s in found]])

    result = source.select("doc_id", *[f.name for f in kept]).schema
    return source.mapInArrow(predict, result.add("lang_pred", "string").add("score", "double"))
