"""Secret scans: fixed patterns, and credential formats inferred from what they find.

Grammar inference: the strings that the fixed patterns label as credentials form a prefix tree for
each kind; states whose continuations are statistically compatible (Hoeffding bounds on all
outgoing frequencies, checked recursively) are merged into a probabilistic automaton. The same is
done for ordinary words. Every long token of every text is scored by how much likelier the best
credential format is than ordinary text, in bits per character.

Null text counts as empty: no spans. Rows come back one for one. All documents are labelled; a kind
with fewer than 8 different credentials in them all gets no format. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from hashlib import sha256
from math import log, log2, sqrt

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.shared import Shipped, batch_of, documents, slices, written

KINDS = ("assign", "access", "hex")
INFERRED = "inferred"

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
# A run is one match of the base pattern, so asking for the length at once drops the same matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (ACCESS_LENGTH - 4))
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)

# Any token that may be a credential: long, with letters and digits.
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
WORD = re.compile(r"[A-Za-z0-9+/_.=@-]{4,}")
MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])")

Span = tuple[int, int, int]  # start, place of the kind, end


def base_spans(text: str) -> list[tuple[Span, str]]:
    """The spans of the fixed patterns with the credential inside, by start, then kind."""
    found: list[tuple[Span, str]] = []
    if ":" in text or "=" in text:
        found += [
            ((m.start(), 0, m.end()), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        found += [((m.start(), 1, m.end()), m[0]) for m in ACCESS.finditer(text)]
    found += [((m.start(), 2, m.end()), m[0]) for m in HEX.finditer(text)]
    found.sort()
    return found


def symbols(token: str) -> str:
    """Character classes: a-f, other lower case, upper case, digits; signs stand for themselves."""
    return "".join(
        "h" if "a" <= c <= "f" else "l" if "a" <= c <= "z" else "U" if "A" <= c <= "Z" else "9" if c.isdigit() else c
        for c in token
    )


# Of a class, each character is taken as equally likely.
CLASS_BITS = {"h": log2(6), "l": log2(20), "U": log2(26), "9": log2(10)}
END = ""


class ProbabilisticAutomaton:
    """Merged prefix tree of sample strings with frequencies; smoothed, so unseen steps cost bits."""

    def __init__(self, samples: list[str], alpha: float = 0.05, longest: int = 200):
        self.edges: list[dict[str, int]] = [{}]
        self.uses: list[Counter] = [Counter()]
        for sample, times in sorted(Counter(s[:longest] for s in samples).items()):
            state = 0
            for c in sample:
                self.uses[state][c] += times
                if c not in self.edges[state]:
                    self.edges[state][c] = len(self.edges)
                    self.edges.append({})
                    self.uses.append(Counter())
                state = self.edges[state][c]
            self.uses[state][END] += times
        self.bound = sqrt(0.5 * log(2 / alpha))
        self._merge_all()
        self.totals = [sum(u.values()) for u in self.uses]

    def _merge_all(self) -> None:
        kept, kept_set = [0], {0}
        parents = {to: (0, c) for c, to in self.edges[0].items()}
        border = deque(sorted(parents))
        while border:
            state = border.popleft()
            parent, symbol = parents[state]
            if self.edges[parent].get(symbol) != state:
                continue
            for into in kept:
                if self._compatible(into, state):
                    self.edges[parent][symbol] = into
                    self._fold(into, state)
                    break
            else:
                kept.append(state)
                kept_set.add(state)
            # What folding hung below a kept state comes up for a decision.
            waiting = set(border)
            for red in kept:
                for c, to in sorted(self.edges[red].items()):
                    if to not in kept_set and to not in waiting:
                        parents[to] = (red, c)
                        border.append(to)
                        waiting.add(to)

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = sum(self.uses[a].values()), sum(self.uses[b].values())
            if not n or not m:
                continue
            limit = self.bound * (1 / sqrt(n) + 1 / sqrt(m))
            for c in self.uses[a].keys() | self.uses[b].keys():
                if abs(self.uses[a][c] / n - self.uses[b][c] / m) > limit:
                    return False
                if c in self.edges[a] and c in self.edges[b] and self.edges[b][c] != b:
                    stack.append((self.edges[a][c], self.edges[b][c]))
        return True

    def _fold(self, into: int, state: int) -> None:
        """Adds the tree below ``state`` to the automaton at ``into``."""
        stack = [(into, state)]
        while stack:
            into, state = stack.pop()
            self.uses[into].update(self.uses[state])
            for c, to in self.edges[state].items():
                if c in self.edges[into]:
                    stack.append((self.edges[into][c], to))
                else:
                    self.edges[into][c] = to

    def bits(self, sample: str) -> float:
        """What the string costs, in bits per character."""
        state, cost = 0, 0.0
        for c in sample:
            # Add-half smoothing over some forty classes and signs; after an unseen step, start afresh.
            cost -= log2((self.uses[state][c] + 0.5) / (self.totals[state] + 20))
            state = self.edges[state].get(c, 0)
        cost -= log2((self.uses[state][END] + 0.5) / (self.totals[state] + 20))
        return (cost + sum(CLASS_BITS.get(c, 0.0) for c in sample)) / max(1, len(sample))


def first_by_hash(df: DataFrame, n: int) -> set[int]:
    """The ``n`` different ids with the smallest hashes. About twice as many come to the driver, however many there are.

    Hashes are spread evenly, so a threshold that should leave enough is tried, and doubled where ids repeat.
    """
    ids, hashed = df.select("doc_id").where("doc_id IS NOT NULL"), F.xxhash64("doc_id")
    share = min(1.0, (2 * n + 1000) / max(1, ids.count()))
    while True:
        below = ids.where(hashed < F.lit(int(share * (1 << 64)) - (1 << 63))) if share < 1 else ids
        rows = below.distinct().select("doc_id", hashed.alias("hash")).collect()
        if len(rows) >= n or share == 1:
            return {row.doc_id for row in sorted(rows, key=lambda r: (r.hash, r.doc_id))[:n]}
        share = min(1.0, 2 * share)


def credential_formats(
    df: DataFrame, sample_documents: int, samples: int
) -> tuple[dict[str, ProbabilisticAutomaton], ProbabilisticAutomaton]:
    """Automata of the labelled credentials of each kind, and of ordinary words.

    The credentials are those of all documents, the ordinary words those of the ``sample_documents``
    documents with the smallest hashed ids; of each kind, and of the words, the ``samples`` different
    strings with the smallest hashes are learned. Each task keeps no more than that, and two rounds of
    ranks bring them together, so what comes to the driver doesn't grow with the number of tasks.
    """
    ids = first_by_hash(df, sample_documents)
    schema = pa.schema([("kind", pa.string()), ("hash", pa.int64()), ("value", pa.string())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, dict[str, int]] = {kind: {} for kind in ("", *KINDS)}
        limits = dict.fromkeys(found, 1 << 63)  # hashes from here on can't be among the smallest

        def add(kind: str, value: str) -> None:
            hashed = xxhash.xxh64_intdigest(value.encode("utf-8", "replace"), 42)
            hashed -= (hashed >> 63) << 64
            if hashed >= limits[kind]:
                return
            own = found[kind]
            own[value] = hashed
            if len(own) >= 2 * samples + 100:
                smallest = sorted(own.items(), key=lambda x: (x[1], x[0]))[:samples]
                found[kind] = dict(smallest)
                limits[kind] = smallest[-1][1] + 1 if smallest else -1 << 63

        for batch in slices(batches, "text"):
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                spans = base_spans(text or "")
                for span, value in spans:
                    add(KINDS[span[1]], value)
                if doc_id in ids:
                    for word in set(WORD.findall(text or "")) - {value for _, value in spans}:
                        add("", word)
        rows = [
            (kind, hashed, value)
            for kind, own in found.items()
            for value, hashed in sorted(own.items(), key=lambda x: (x[1], x[0]))[:samples]
        ]
        yield batch_of(schema, [list(c) for c in zip(*rows, strict=True)] or [[], [], []])

    labelled = df.select("doc_id", "text").mapInArrow(label, "kind string, hash long, value string").distinct()
    labelled = written(labelled, "labelled-tokens")
    for group in ([F.pmod(F.spark_partition_id(), F.lit(64))], []):
        labelled = labelled.select("kind", "hash", "value", *[g.alias("part") for g in group])
        nearest = Window.partitionBy("kind", *(["part"] if group else [])).orderBy("hash", "value")
        labelled = labelled.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= samples)
    groups: dict[str, list[str]] = {kind: [] for kind in ("", *KINDS)}
    for row in sorted(labelled.collect(), key=lambda r: (r.kind, r.rank)):
        groups[row.kind].append(symbols(row.value))
    # Two credentials make no format.
    formats = {kind: ProbabilisticAutomaton(groups[kind]) for kind in KINDS if len(groups[kind]) >= 8}
    return formats, ProbabilisticAutomaton(groups[""] or ["l"])


def secret_spans(
    df: DataFrame,
    sample_documents: int = 4000,
    samples: int = 400,
    margin: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, spans and counts per kind, with the inferred spans; ``margin`` is in bits per character.

    The formats are fitted on a bounded sample (``credential_formats``); every token of every whole
    text is scored. Rows are independent: no shuffle of the documents.
    """
    source = documents(df, id_col=id_col, text_col=text_col)
    formats, ordinary = credential_formats(source, sample_documents, samples)
    shared = Shipped(df.sparkSession, (formats, ordinary))
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(f"n_{kind}", pa.int64()) for kind in (*KINDS, INFERRED)]
        + [("base_sha256", pa.string()), ("spans", pa.string())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formats, ordinary = shared.value
        names = (*KINDS, INFERRED)

        def inferred(text: str, base: list[Span]) -> Iterator[Span]:
            for m in TOKEN.finditer(text):
                token = m[0]
                if not MIXED.match(token) or any(m.start() < end and start < m.end() for start, _, end in base):
                    continue
                form = symbols(token)
                if formats and ordinary.bits(form) - min(f.bits(form) for f in formats.values()) > margin:
                    yield m.start(), len(KINDS), m.end()

        def listed(spans: list[Span]) -> str:
            return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in spans)

        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                base = [span for span, _ in base_spans(text or "")]
                every = sorted([*base, *inferred(text or "", base)])
                counts = Counter(kind for _, kind, _ in every)
                rows.append(
                    [*(counts[i] for i in range(4)), sha256(listed(base).encode()).hexdigest(), listed(every)]
                )
            yield batch_of(schema, [batch.column("doc_id"), *map(list, zip(*rows, strict=True))])

    columns = ", ".join(f"n_{kind} long" for kind in (*KINDS, INFERRED))
    return source.mapInArrow(scan, f"doc_id long, {columns}, base_sha256 string, spans string")
