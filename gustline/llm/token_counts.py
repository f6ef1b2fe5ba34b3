"""Token counts by byte-pair merging with a heap over a linked list of symbols.

The lowest-rank adjacent pair is popped and merged until none is left. The count is the number of
initial symbols less the merges; characters outside the vocabulary count as their UTF-8 bytes.
No identifiers are made. Works for SentencePiece BPE models with byte fallback and without text
normalisation, whose pieces hold the space mark only in front.

Null text counts as empty: no bytes, no tokens. Rows come back one for one, repeated rows too.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from gustline.llm.shared import batch_of, documents, slices, worker_cache

SPACE = "▁"
MEMO = 1 << 20  # words whose counts a worker remembers before it starts afresh


def largest_connected(pieces: Iterable[str]) -> set[str]:
    """The largest set of characters that are linked by standing side by side in pieces, without the space mark."""
    above: dict[str, str] = {}

    def top(c: str) -> str:
        while (up := above.setdefault(c, c)) != c:
            above[c] = c = above.setdefault(up, up)
        return c

    for piece in pieces:
        own = piece.lstrip(SPACE)
        for a, b in zip(own, own[1:]):
            above[top(a)] = top(b)
    sets = defaultdict(set)
    for c in list(above):
        sets[top(c)].add(c)
    return max(sets.values(), key=len, default=set())


class PieceCounter:
    """Counts the pieces of a text as the model's library does."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(sp.get_piece_size())
        pieces = {
            sp.id_to_piece(i): -sp.get_score(i)
            for i in ids
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
        }
        self.rank = {p: r for p, r in pieces.items() if len(p) > 1}
        self.known = {p for p in pieces if len(p) == 1}
        if any(SPACE in p.lstrip(SPACE) for p in pieces) or sp.encode("a", out_type=str)[0][0] != SPACE:
            raise ValueError("The model doesn't mark spaces in front of words only")
        # Signs that stand side by side in a piece are connected. No merge reaches from the largest
        # connected set (the letters) to the others, so a text can be cut there before counting.
        letters = "".join(map(re.escape, sorted(largest_connected(self.rank))))
        self.parts = re.compile(f" *(?:[{letters}]+|[^ {letters}]+)| +").findall if letters else lambda text: [text]
        self.memo: dict[str, int] = {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        memo, total = self.memo, 0
        if len(memo) > MEMO:
            memo.clear()
        for part in self.parts(" " + text.replace(SPACE, " ")):
            n = memo.get(part)
            if n is None:
                n = self.part(part)
            total += n
        return total

    def part(self, part: str) -> int:
        marked = part.replace(" ", SPACE)
        n = self.merged(marked) if len(part) > 1 else 1 if marked in self.known else len(part.encode())
        if len(part) < 64:
            self.memo[part] = n
        return n

    def merged(self, part: str) -> int:
        """Initial symbols less merges."""
        rank, known = self.rank, self.known
        symbols: list[str] = list(part)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(part[i : i + 2])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            _, left, size = heappop(heap)
            right = after[left] if symbols[left] else n
            if right >= n or len(symbols[left]) + len(symbols[right]) != size:
                continue  # one of the two has been merged meanwhile
            merges += 1
            symbols[left] = whole = symbols[left] + symbols[right]
            symbols[right] = ""
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                if (r := rank.get(pair := whole + symbols[follow])) is not None:
                    heappush(heap, (r, left, len(pair)))
            if (ahead := before[left]) >= 0 and (r := rank.get(pair := symbols[ahead] + whole)) is not None:
                heappush(heap, (r, ahead, len(pair)))
        return n - merges + sum(len(s.encode()) - 1 for s in symbols if len(s) == 1 and s not in known)


def token_counts(df: DataFrame, model: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether n_tokens is over the limit, for every row.

    ``model`` is a path that every executor can open (the file is installed with its library).
    Rows are independent: no shuffle, and a lost task is simply run again.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = worker_cache("pieces")
        counter = counters.get(model) or counters.setdefault(model, PieceCounter(model))
        for batch in slices(batches, "text"):
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).cast(pa.int64())
            tokens = [counter.count(text or "") for text in batch.column("text").to_pylist()]
            over = [n > limit for n in tokens]
            yield batch_of(schema, [batch.column("doc_id"), sizes, tokens, over])

    return documents(df, id_col=id_col, text_col=text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
