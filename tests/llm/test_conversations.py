"""Conversation repair: against all sequences of edits, against a plain dynamic program, and across tasks."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gustline.llm import conversations
from gustline.llm.conversations import conversation_reports, damaged, repair_conversations, repaired_turns

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")


def faults_of(turns):
    """b, d, t or o for each (role, text)."""
    seen, out = set(), ""
    for role, text in turns:
        shown = VISIBLE.findall(text)
        out += "b" if not shown else "d" if (role, text) in seen else "o" if shown[-1] in ".!?" else "t"
        seen.add((role, text))
    return out


def own_edits(role, text, fault):
    """(letter, cost, repaired turn) of a turn alone."""
    yield "D", 4, None
    if fault not in "bd":
        extra = 3 if fault == "t" else 0
        yield "K", extra, (role, text)
        yield from (("R", 3 + extra, (new, text)) for new in ("user", "assistant"))


def by_enumeration(turns):
    """Every sequence of edits with up to two insertions before each turn and at the end."""
    added = [[("I", 3, (new, "")) for new in chosen] for n in range(3) for chosen in itertools.product(("user", "assistant"), repeat=n)]
    steps = []
    for (role, text), fault in zip(turns, faults_of(turns)):
        steps += [added, [[edit] for edit in own_edits(role, text, fault)]]
    found = []
    for chosen in itertools.product(*steps, added):
        edits = [edit for part in chosen for edit in part]
        repaired = [turn for _, _, turn in edits if turn]
        if PATTERN.fullmatch("".join(role[:1] or "?" for role, _ in repaired)):
            found.append((sum(cost for _, cost, _ in edits), "".join(letter for letter, _, _ in edits), repaired))
    return min(found, key=lambda f: f[:2])


NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def by_suffixes(turns):
    """From the last turn to the first: the least (cost, letters) from each ending of the repaired part."""

    def with_insertions(own):
        out = {}
        for ending in NEXT:
            ways, at, cost, letters, put = [], ending, 0, "", []
            for _ in range(4):
                if at in own:
                    c, a, rest = own[at]
                    ways.append((cost + c, letters + a, put + rest))
                at = "a" if at == "u" else "u"
                cost, letters, put = cost + 3, letters + "I", [*put, ("assistant" if at == "a" else "user", "")]
            out[ending] = min(ways, key=lambda w: w[:2])
        return out

    best = with_insertions({"": (0, "", []), "a": (0, "", [])})
    for (role, text), fault in reversed(list(zip(turns, faults_of(turns)))):
        own = {}
        for ending in NEXT:
            ways = []
            for letter, cost, turn in own_edits(role, text, fault):
                to = NEXT[ending].get(turn[0][:1]) if turn else ending
                if to is not None:
                    c, a, rest = best[to]
                    ways.append((cost + c, letter + a, [turn] * bool(turn) + rest))
            own[ending] = min(ways, key=lambda w: w[:2])
        best = with_insertions(own)
    return best[""]


def expected(conv, rows):
    """The report of rows (turn, role, text) in order."""
    turns = [(role, text) for _, role, text in rows]
    faults, numbers = faults_of(turns), [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [role[:1] for role, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, repaired = by_suffixes(turns)
    lines = "\n".join(f"{role}:{text}" for role, text in repaired)
    return (conv, gaps, *map(faults.count, "bdt"), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


roles = st.sampled_from(["system", "user", "assistant", "tool", " ", ""])
texts = st.sampled_from(["Fine.", "Good!", "cut off", "same", "", " \t", "x"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=3))
def test_the_plain_programs_agree(turns):
    assert by_enumeration(turns) == by_suffixes(turns)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=40))
def test_integer_weights_decide_like_cost_and_letters(turns):
    kinds = [(role[:1], fault) for (role, _), fault in zip(turns, faults_of(turns))]
    weights = conversations.least_weights(kinds, conversations.START)
    n = len(turns)
    weight = min(conversations.with_end(w, s, n) for s, w in enumerate(weights) if w is not None)
    cost, letters = conversations.letters_of(weight, n)
    kept = conversations.apply(letters, [r for r, _ in turns], [t for _, t in turns], conversations.START)
    assert (cost, letters, list(zip(*kept))) == by_suffixes(turns)


def random_rows(rng, conv, n):
    return [
        (conv, turn, rng.choice(["user", "assistant", "system", "user", "assistant", "tool"]), rng.choice(["a.", "b!", "c", "", f"{turn}.", f"{turn}"]))
        for turn in range(n)
    ]


def reports(df, times=None):
    rows = conversation_reports(repair_conversations(df, times))
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_conversations_across_blocks_and_tasks(spark, monkeypatch, block):
    monkeypatch.setattr(conversations, "BLOCK", block)
    rng = random.Random(block)
    talks = {conv: random_rows(rng, conv, rng.choice([1, 2, 7, 30])) for conv in range(40)}
    talks[17] = random_rows(rng, 17, 900)  # most of all rows, so in several tasks
    rows = [row for talk in talks.values() for row in talk]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = reports(df)
    assert found == sorted((expected(c, [r[1:] for r in talk]) for c, talk in talks.items()), key=repr)
    pieces = repair_conversations(df)
    assert pieces.where("conv_id = 17").count() > 1
    turns = sorted(repaired_turns(pieces).where("conv_id = 17").collect(), key=lambda r: (r.piece, r.place))
    assert [(r.role, r.text) for r in turns] == by_suffixes([r[2:] for r in talks[17]])[2]


def test_repeated_rows_spread_over_tasks(spark):
    rows = [(1, 0, "user", "Hello.")] * 3000 + [(1, 1, "assistant", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ((conv, gaps, blank, duplicate, truncated, illegal, cost, audit, _),) = reports(df)
    assert (duplicate, cost, illegal, gaps) == (2999, 4 * 2999, 2999, 0)
    assert audit == "K" + "D" * 2999 + "K"


def brute_query(rows):
    """The contract of the query, row by row."""
    talks = {}
    for conv, turn, role, text in rows:
        kept = talks.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault != 0:
            role = "user" if fault == 4 else role
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv, kept in talks.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        yield expected(conv, kept)


def test_query_on_odd_rows(spark):
    rng = random.Random(5)
    rows = [row for conv in range(60) for row in random_rows(rng, conv, rng.randint(1, 9))]
    rows += [(None, 0, "user", "no id."), (None, None, None, None), (70, None, "user", "a."), (71, 5, None, "x."), (72, 5, "user", None)]
    rows += [(73, -(2**63), "user", "a."), (73, 2**63 - 1, "assistant", "b."), (74, 0, "user", "long " * 50_000 + "."), (75, 1, "", "\x00.")]
    df = spark.createDataFrame([(*r, 1, "x", None) for r in rows], "conv_id long, turn long, role string, text string, times int, part string, block int")
    wanted = [(c, min(g, 2**63 - 1), *rest) for c, g, *rest in brute_query(rows)]
    assert reports(*damaged(df)) == sorted(wanted, key=repr)
    assert reports(*damaged(df.limit(0))) == []


def test_a_conversation_that_loses_all_rows_is_reported(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "a."), (lost + 1000, None, "user", "b.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in reports(*damaged(df))
