"""Finds and repairs faults in the structure of conversations, at the least cost.

A repaired conversation has the role initials ``(s?(ua)+)?``: perhaps a system turn, then user and assistant
by turns, or nothing. Edits and their costs: Keep 0, Rerole (to user or assistant) 3, Delete 4, Insert (an empty
user or assistant turn) 3. Blank turns and repeated ones (same role and text seen earlier) must be deleted, a
truncated turn (its last visible character is none of ``.!?``) that stays costs 3 more. Of equally cheap repairs
the one whose edits' initials are least in ASCII order is taken.

The edits form an acyclic graph: nodes are (turn, what the repaired part ends with), an edge is a turn's edit with
the insertions before it. Each edge weighs one integer: its high digits are the cost, and each turn owns a slot
of three octal digits among the low ones, in which the letters of its edits stand, with zeros at the end (never
more than two insertions pay before one turn). Letters of a slot end with the turn's own edit, so none is
the beginning of another, and slots compare as the letters written one after the other. The least sum of
weights over the graph then decides everything at once: cost, edits and ties.

Conversations are sorted among tasks by (id, turn), not gathered by id, so one of any length is spread over
tasks. What lies whole within one task and one block is repaired there. Of the others, each block of at most
``BLOCK`` turns gives the least weight from every entry to every exit; those 16 numbers, not the turns, are
combined along the conversation, with the order of a block's letters as its digit.

Null ids are one conversation; a null turn comes first; null role or text is one space. Turns of equal number come
in the order of a hash of role and text, identical rows one after the other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.llm.shared import batch_of, slices, written

BLOCK = 256  # turns
BLOCK_CHARS = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
LARGEST = (1 << 63) - 1

# What the repaired part ends with, and what an inserted or re-roled turn makes of it.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ADDED = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ROLES = {USER: "user", ASSISTANT: "assistant"}

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
LETTERS = "0DIKR"  # as octal digits: in ASCII order, 0 is the end of a slot
SLOT = 9  # bits
TO_DIGITS, TO_LETTERS = str.maketrans("DIKR", "1234"), str.maketrans("1234", "DIKR", "0")


def slot(letters: str) -> int:
    return int(letters.translate(TO_DIGITS).ljust(3, "0"), 8)


KNOWN_MOVES: dict[tuple[str, str], list[tuple[int, int, int, int]]] = {}


def moves(initial: str, fault: str) -> list[tuple[int, int, int, int]]:
    """(from, to, cost, digits) of the cheapest way to pass one turn, for each pair of states."""
    initial = initial if initial in KEPT else ""
    if (initial, fault) in KNOWN_MOVES:
        return KNOWN_MOVES[initial, fault]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    extra = TRUNCATED if fault == "t" else 0
    for entry in STATES:
        state, cost, letters = entry, 0, ""
        for _ in range(3):
            ways = [(state, DELETE, "D")]
            if fault not in "bd":
                ways.append((ADDED[state], REROLE + extra, "R"))
                if state in KEPT.get(initial, ()):
                    ways.append((KEPT[initial][state], KEEP + extra, "K"))
            for to, own, letter in ways:
                weight = cost + own, slot(letters + letter)
                best[entry, to] = min(best.get((entry, to), weight), weight)
            state, cost, letters = ADDED[state], cost + INSERT, letters + "I"
    KNOWN_MOVES[initial, fault] = [(a, b, *weight) for (a, b), weight in best.items()]
    return KNOWN_MOVES[initial, fault]


# Insertions after the last turn.
ENDS = {START: (0, 0), ASSISTANT: (0, 0), USER: (INSERT, slot("I")), SYSTEM: (2 * INSERT, slot("II"))}


def least_weights(turns: Sequence[tuple[str, str]], entry: int) -> list[int | None]:
    """The least weight from ``entry`` to each state over turns of (initial, fault); None where no way leads."""
    width = place = SLOT * (len(turns) + 1)
    best: list[int | None] = [None] * 4
    best[entry] = 0
    for turn in turns:
        place -= SLOT
        after: list[int | None] = [None] * 4
        for a, b, cost, digits in moves(*turn):
            if (so_far := best[a]) is not None:
                weight = so_far + (cost << width) + (digits << place)
                if (other := after[b]) is None or weight < other:
                    after[b] = weight
        best = after
    return best


def with_end(weight: int, state: int, n_turns: int) -> int:
    cost, digits = ENDS[state]
    return weight + (cost << SLOT * (n_turns + 1)) + digits


def letters_of(weight: int, n_turns: int) -> tuple[int, str]:
    """Cost and letters of a weight."""
    width = SLOT * (n_turns + 1)
    digits = weight & ((1 << width) - 1)
    return weight >> width, format(digits, "o").rjust(width // 3, "0").translate(TO_LETTERS)


def apply(letters: str, roles: Sequence[str], texts: Sequence[str], state: int) -> tuple[list[str], list[str]]:
    """The repaired turns."""
    out_roles, out_texts, turn = [], [], 0
    for letter in letters:
        if letter != "D":
            state = KEPT[roles[turn][0]][state] if letter == "K" else ADDED[state]
            out_roles.append(roles[turn] if letter == "K" else ROLES[state])
            out_texts.append("" if letter == "I" else texts[turn])
        turn += letter != "I"
    return out_roles, out_texts


class Facts:
    """Counts over consecutive turns, which can be put together."""

    def __init__(self, turns: Sequence[int | None], roles: Sequence[str], faults: str):
        known = [t for t in turns if t is not None]
        self.first_turn, self.last_turn = (known[0], known[-1]) if known else (None, None)
        self.distinct = sum(1 for _ in groupby(known))
        initials = [r[:1] for r in roles]
        self.first_role, self.last_role = (initials[0], initials[-1]) if initials else (None, None)
        self.illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        self.blank, self.duplicate, self.truncated = map(faults.count, "bdt")

    def before(self, later: Facts) -> None:
        """Adds what comes directly after."""
        for name in ("distinct", "illegal", "blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(later, name))
        if self.last_role is None:
            self.first_role, self.last_role = later.first_role, later.last_role
        elif later.first_role is not None:
            self.illegal += self.last_role + later.first_role not in ("su", "ua", "au")
            self.last_role = later.last_role
        if self.last_turn is None:
            self.first_turn, self.last_turn = later.first_turn, later.last_turn
        elif later.first_turn is not None:
            self.distinct -= self.last_turn == later.first_turn
            self.last_turn = later.last_turn

    def counts(self) -> tuple[int, ...]:
        gaps = 0 if self.last_turn is None else self.last_turn - self.first_turn + 1 - self.distinct
        return min(gaps, LARGEST), self.blank, self.duplicate, self.truncated, self.illegal


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
COUNT_NAMES = [part.split()[0] for part in COUNTS.split(", ")]
COUNT_FIELDS = [(name, pa.int64()) for name in COUNT_NAMES]
TEXTS = pa.list_(pa.string())

CUT = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("whole", pa.bool_())]
    + [("turns", pa.list_(pa.int64())), ("roles", TEXTS), ("texts", TEXTS), ("faults", pa.string())]
    + [("digests", pa.list_(pa.binary())), ("audit", pa.string()), *COUNT_FIELDS]
)
CUT_TYPES = (
    "conv_id long, part int, block long, whole boolean, turns array<long>, roles array<string>, texts array<string>, "
    f"faults string, digests array<binary>, audit string, {COUNTS}"
)


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to repaired conversations, or to blocks of those that may go on in another task."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    conv, first, begun, block, chars = None, None, False, 0, 0  # blocks are numbered through the task
    turns, roles, texts, faults, digests, seen = [], [], [], [], [], set()

    def block_row() -> tuple:
        nonlocal block
        block += 1
        return conv, part, block, False, turns[:], roles[:], texts[:], "".join(faults), digests[:], None, *[None] * 6

    def whole_row() -> tuple:
        codes = "".join(faults)
        weights = least_weights([(r[:1], f) for r, f in zip(roles, codes)], START)
        n = len(roles)
        cost, letters = letters_of(min(with_end(w, s, n) for s, w in enumerate(weights) if w is not None), n)
        kept = apply(letters, roles, texts, START)
        return conv, part, 0, True, None, *kept, None, None, letters, *Facts(turns, roles, codes).counts(), cost

    def clear() -> None:
        nonlocal chars
        chars = 0
        for held in (turns, roles, texts, faults, digests):
            held.clear()

    size = 0
    for batch in (piece for whole in batches for piece in slices([whole], "text")):
        for conv_id, turn, role, text, times, digest in zip(*(column.to_pylist() for column in batch.columns)):
            if first is None or conv_id != conv:
                if first is not None:
                    out.append(block_row() if first or begun else whole_row())
                    clear()
                    seen.clear()
                conv, first, begun = conv_id, first is None, False
            for _ in range(times):
                if len(roles) == BLOCK or (roles and chars + len(text) > BLOCK_CHARS):
                    out.append(block_row())
                    clear()
                    begun = True
                visible = text.rstrip(BLANKS)
                fault = "b" if not visible else "d" if digest in seen else "o" if visible[-1] in ".!?" else "t"
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                faults.append(fault)
                digests.append(digest if fault in "ot" else None)
                seen.add(digest)
                chars += len(text)
            size += len(text or "")
        if len(out) >= 4096 or size > BLOCK_CHARS:
            if out:
                yield batch_of(CUT, list(zip(*out)))
            out, size = [], 0
    if first is not None:
        out.append(block_row())
    if out:
        yield batch_of(CUT, list(zip(*out)))


SUMMARY = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("faults", pa.string())]
    + [("turns", pa.list_(pa.int64())), ("ends", TEXTS), ("sums", pa.list_(pa.int64()))]
    + [("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32()))]
)
SUMMARY_TYPES = (
    "conv_id long, part int, block long, faults string, turns array<long>, ends array<string>, sums array<long>, "
    "costs array<long>, ranks array<int>"
)


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's facts, and cost and order of letters of its ways from state to state (cost -1: no way)."""
    for batch in batches:
        out = []
        for conv, part, block, turns, roles, faults, digests, firsts in zip(*(c.to_pylist() for c in batch.columns)):
            new = set(firsts or ())
            codes = "".join("d" if d is not None and i not in new else f for i, (f, d) in enumerate(zip(faults, digests)))
            facts = Facts(turns, roles, codes)
            ways = [w for entry in STATES for w in least_weights([(r[:1], f) for r, f in zip(roles, codes)], entry)]
            width = SLOT * (len(roles) + 1)
            lower = [-1 if w is None else w & ((1 << width) - 1) for w in ways]
            order = {digits: rank for rank, digits in enumerate(sorted(set(lower)))}
            costs = [-1 if w is None else w >> width for w in ways]
            sums = [facts.distinct, facts.illegal, facts.blank, facts.duplicate, facts.truncated]
            ends, edges = [facts.first_role, facts.last_role], [facts.first_turn, facts.last_turn]
            out.append((conv, part, block, codes, edges, ends, sums, costs, [order[digits] for digits in lower]))
        if out:
            yield batch_of(SUMMARY, list(zip(*out)))


PATH = pa.schema(
    [("part", pa.int32()), ("block", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_())]
    + [("entry", pa.int32()), ("exit", pa.int32()), ("faults", pa.string()), *COUNT_FIELDS]
)
PATH_TYPES = f"part int, block long, piece long, last boolean, entry int, exit int, faults string, {COUNTS}"


def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states in which the cheapest repair enters and leaves each block; blocks come last first.

    From the end, each state has the cost of the rest and the rank of its letters among the four; a block
    adds its own cost, and its order of letters as a higher digit.
    """
    conv, total, held = None, None, []
    rest = {}

    def finished() -> pa.RecordBatch:
        state, rows, cost = START, [], rest[START][0]
        for piece, (part, block, faults, choice) in enumerate(reversed(held)):
            counts = [None] * 6 if piece else [*total.counts(), cost]
            rows.append((part, block, piece, piece + 1 == len(held), state, choice[state], faults, *counts))
            state = choice[state]
        return batch_of(PATH, list(zip(*rows)))

    for batch in batches:
        for own, part, block, faults, turns, ends, sums, costs, ranks in zip(*(c.to_pylist() for c in batch.columns)):
            if held and own != conv:
                yield finished()
                held = []
            facts = Facts([], [], "")
            facts.first_turn, facts.last_turn = turns
            facts.first_role, facts.last_role = ends
            facts.distinct, facts.illegal, facts.blank, facts.duplicate, facts.truncated = sums
            if held:
                facts.before(total)
            else:
                rest = ENDS  # (cost, digits): their digits are in the order of their letters
            conv, total, choice, after = own, facts, [], {}
            for a in STATES:
                ways = [
                    (costs[4 * a + b] + rest[b][0], ranks[4 * a + b], rest[b][1], b) for b in STATES if costs[4 * a + b] >= 0
                ]
                cost, rank, more, to = min(ways)
                choice.append(to)
                after[a] = cost, (rank, more)
            order = {letters: rank for rank, letters in enumerate(sorted({v[1] for v in after.values()}))}
            rest = {a: (cost, order[letters]) for a, (cost, letters) in after.items()}
            held.append((part, block, faults, choice))
    if held:
        yield finished()


PIECES = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("roles", TEXTS), ("texts", TEXTS)]
    + [("audit", pa.string()), *COUNT_FIELDS]
)
PIECE_TYPES = f"conv_id long, piece long, whole boolean, roles array<string>, texts array<string>, audit string, {COUNTS}"


def repaired_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        columns = (c.to_pylist() for c in batch.columns)
        for conv, roles, texts, faults, piece, last, entry, leave, *counts in zip(*columns):
            weight = least_weights([(r[:1], f) for r, f in zip(roles, faults)], entry)[leave]
            _, letters = letters_of(with_end(weight, leave, len(roles)) if last else weight, len(roles))
            out.append((conv, piece, False, *apply(letters, roles, texts, entry), letters, *counts))
        if out:
            yield batch_of(PIECES, list(zip(*out)))


def repair_conversations(
    df: DataFrame,
    times: Column | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The repaired conversations in pieces of whole conversations or of blocks of their turns.

    conv_id, piece (from 0), whole, roles and texts of the repaired turns, audit (letters of the edits) and, with
    piece 0, the counts of the whole conversation: gaps, blank, duplicate, truncated, illegal and cost. See
    ``repaired_turns`` and ``conversation_reports``.

    ``times`` tells how often each row counts: 0 leaves only its conversation's id. Counts beyond a long are the
    largest long.
    """
    times = F.lit(1) if times is None else times
    counted = df.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        times.cast("int").alias("times"),
    )
    present = F.col("times") > 0
    rows = counted.select(
        "conv_id",
        "turn",
        F.when(present, F.col("role")).alias("role"),
        F.when(present, F.col("text")).alias("text"),
        "times",
        F.when(present, F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")))).alias("digest"),
        F.monotonically_increasing_id().alias("row"),  # parts identical rows, should very many be so
    )
    order = ["conv_id", "turn", "digest", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    done = written(ordered.mapInArrow(cut, CUT_TYPES), "conversations")

    whole = done.where("whole").select("conv_id", F.lit(0).cast("long").alias("piece"), "whole", "roles", "texts", "audit", *COUNT_NAMES)
    blocks = done.where(~F.col("whole"))
    # A task knows the repetitions it has seen; the first of each (role, text) over all tasks is no repetition.
    candidates = blocks.select("conv_id", "part", "block", F.posexplode("digests").alias("row", "digest")).where("digest IS NOT NULL")
    firsts = (
        candidates.groupBy("conv_id", "digest")
        .agg(F.min(F.struct("part", "block", "row")).alias("first"))
        .groupBy(F.col("first.part").alias("part"), F.col("first.block").alias("block"))
        .agg(F.collect_list("first.row").alias("firsts"))
    )
    known = blocks.select("conv_id", "part", "block", "turns", "roles", "faults", "digests").join(firsts, ["part", "block"], "left")
    summary = known.select(
        "conv_id", "part", "block", "turns", "roles", "faults", "digests", "firsts"
    ).mapInArrow(summaries, SUMMARY_TYPES)
    chosen = (
        summary.repartition("conv_id")
        .sortWithinPartitions(F.asc("conv_id"), F.desc("part"), F.desc("block"))
        .mapInArrow(paths, PATH_TYPES)
    )
    ready = blocks.select("conv_id", "part", "block", "roles", "texts").join(chosen, ["part", "block"])
    parted = ready.select(
        "conv_id", "roles", "texts", "faults", "piece", "last", "entry", "exit", *COUNT_NAMES
    ).mapInArrow(repaired_blocks, PIECE_TYPES)
    return whole.union(written(parted, "conversation-blocks"))


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """conv_id, piece, place (within the piece), role and text of every repaired turn."""
    return pieces.select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn")).select(
        "conv_id", "piece", "place", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text")
    )


REPORTS = pa.schema([("conv_id", pa.int64()), *COUNT_FIELDS, ("audit", pa.string()), ("repaired_sha256", pa.string())])


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one report a conversation; texts pass through the hash and aren't held."""
    report, audit, hashed = None, [], None
    for batch in batches:
        out = []
        for conv, piece, roles, texts, letters, *counts in zip(*(c.to_pylist() for c in batch.columns)):
            if piece == 0:
                if report:
                    out.append((*report, "".join(audit), hashed.hexdigest()))
                report, audit, hashed, begun = (conv, *counts), [], hashlib.sha256(), False
            audit.append(letters)
            for role, text in zip(roles, texts):
                hashed.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
        if out:
            yield batch_of(REPORTS, list(zip(*out)))
    if report:
        yield batch_of(REPORTS, list(zip(*[(*report, "".join(audit), hashed.hexdigest())])))


def conversation_reports(pieces: DataFrame) -> DataFrame:
    """One row a conversation: its counts, cost, audit and the hash of its repaired ``role:text`` lines.

    A hash runs from the first turn to the last, so the lines of a conversation in several pieces pass
    through one task, which holds a piece at a time.
    """
    lines = F.array_join(F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)), "\n")
    whole = pieces.where("whole").select("conv_id", *COUNT_NAMES, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    parted = (
        pieces.where(~F.col("whole"))
        .select("conv_id", "piece", "roles", "texts", "audit", *COUNT_NAMES)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "piece")
        .mapInArrow(joined, f"conv_id long, {COUNTS}, audit string, repaired_sha256 string")
    )
    return whole.union(parted)


def damaged(df: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with faults put in by a checksum of id and turn, and how often each row then counts."""
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    fault = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    rows = df.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )
    return rows, F.col("times")
