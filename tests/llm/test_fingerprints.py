"""Winnowing: against a plain loop, the guarantee on shared passages, and edits against the next document."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gustline.llm import fingerprints, queries
from gustline.llm.fingerprints import BASE, PRIME, Fingerprint, document_fingerprints, fingerprint, fingerprints_of_edits
from tests.llm.conftest import SF_DIR


def plain(text, gram, window):
    """(hash, position) chosen by a loop over windows."""
    if not text:
        return []
    hashes = []
    for i in range(max(len(text) - gram + 1, 1)):
        h = 0
        for c in text[i : i + gram]:
            h = (h * BASE + ord(c) + 1) % PRIME
        hashes.append(h)
    chosen = []
    for i in range(max(len(hashes) - window + 1, 1)):
        part = hashes[i : i + window]
        place = i + max(j for j, h in enumerate(part) if h == min(part))
        if not chosen or chosen[-1][1] != place:
            chosen.append((hashes[place], place))
    return chosen


def choices(marks):
    return list(zip(marks.hashes.tolist(), marks.positions.tolist()))


few = st.text(alphabet="ab é漢😀", max_size=200)


@settings(max_examples=300, deadline=None)
@given(few, st.integers(1, 9), st.integers(1, 9), st.sampled_from([1, 3, 1 << 20]))
def test_choices_equal_the_plain_loop(text, gram, window, stride):
    whole = fingerprints.STRIDE
    try:
        fingerprints.STRIDE = stride
        marks = fingerprint(text, gram, window)
    finally:
        fingerprints.STRIDE = whole
    assert choices(marks) == plain(text, gram, window)
    assert choices(Fingerprint.parse(str(marks))) == choices(marks)
    assert marks.likeness(marks) == 1.0


@settings(max_examples=300, deadline=None)
@given(few, few, few, few, st.text(alphabet="abc é漢", min_size=12, max_size=60))
def test_every_shared_passage_of_guaranteed_length_leaves_a_common_choice(a, b, c, d, passage):
    gram, window = 5, 8
    left, right = a + passage + b, c + passage + d
    pairs = fingerprint(left, gram, window).shared(fingerprint(right, gram, window))
    inside = len(passage) - gram
    assert any(0 <= p - len(a) <= inside and p - len(a) == q - len(c) for p, q in pairs)


def test_gaps_stay_within_a_window():
    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.integers(97, 123, 20_000)))
    marks = fingerprint(text)
    assert np.diff(marks.positions).max() <= fingerprints.WINDOW and marks.positions[0] < fingerprints.WINDOW
    density = len(marks.positions) / len(text)
    assert abs(density - 2 / (fingerprints.WINDOW + 1)) < 0.01
    assert choices(fingerprint("a" * 100)) == plain("a" * 100, 16, 32)


def expected(rows):
    """The contract for rows (doc_id, text, tie)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    out = []
    for i, (doc_id, text, _) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        own, changed, after = (fingerprint(t) for t in (text, edited, following))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(text), digest, str(own), str(changed), own.likeness(changed), own.likeness(after)))
    return sorted(out, key=repr)


def found(df):
    edits = fingerprints_of_edits(df)
    assert edits.columns[2] == "edited"
    return sorted((tuple(r) for r in edits.withColumn("edited", F.sha2("edited", 256)).collect()), key=repr)


def rows_of(df):
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    return [(r.doc_id, r.text or "", r.tie) for r in df.select("doc_id", "text", tie.alias("tie")).collect()]


def test_odd_documents(odd, empty):
    assert found(odd) == expected(rows_of(odd))
    assert found(empty) == []
    assert found(odd.where("doc_id = 4")) == expected([(4, "a", 0)])


def test_many_ranges(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdef", k=rng.randint(1, 7))) for _ in range(200)]
    rows = [(rng.choice([None, 7, *range(2000)]), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(1500)]
    rows += [(None, "")] * 300 + [(7, "hot " * 20)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    cut = fingerprints.ranges
    numbers = []
    monkeypatch.setattr(fingerprints, "ranges", lambda docs: numbers.append(cut(docs, 5)) or numbers[-1])
    assert found(df) == expected(rows_of(df))
    assert len(numbers[0]) > 20


def test_plain_fingerprints_need_no_order(odd):
    rows = document_fingerprints(odd).collect()
    assert sorted(r.fingerprint for r in rows) == sorted(str(fingerprint(t)) for _, t, _ in rows_of(odd))
    with pytest.raises(ValueError):
        document_fingerprints(odd, window=0)


def test_edited_texts_are_likelier_than_other_documents(spark):
    rows = [r for r in queries.op13_fingerprints(spark, SF_DIR).collect() if r.n_chars >= 400]
    assert len(rows) > 500
    assert sum(r.near_edited > 0.4 for r in rows) >= 0.97 * len(rows)
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.97 * len(rows)
    by_text = {}
    for r in rows:
        by_text.setdefault((r.n_chars, r.fingerprint), []).append(r.doc_id)
    assert max(map(len, by_text.values())) > 1  # the copies in the table
