"""Line templates against a brute-force reading of the same rules."""

import random
from collections import defaultdict

import pytest

from gustline.llm import line_templates, queries
from gustline.llm.line_templates import drop_recurring_lines, masked
from tests.llm.conftest import SF_DIR


def dropped(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 AS line", "8 AS leaf", "9 AS other")
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in drop_recurring_lines(df, **options).collect()}


def test_constant_and_variable_lines(spark):
    docs = [(i, f"own words of document {chr(97 + i) * 3}{chr(98 + i)}\nuser bob{i} logged in at 1{i}:00\nAll rights are reserved here.") for i in range(5)]
    found = dropped(spark, docs)
    assert found[0] == (docs[0][1], 3, 0)
    for i in range(1, 5):
        assert found[i] == (docs[i][1].split("\n")[0], 3, 2), i


def test_words_become_fields(spark):
    names = ["anna", "berta", "carla", "dora"]
    docs = [(i, f"the session of user {name} was closed by the server") for i, name in enumerate(names)]
    assert [found[2] for _, found in sorted(dropped(spark, docs).items())] == [0, 1, 1, 1]
    # Too little in common: 7 of 10 tokens.
    docs = [(i, f"the session of {n} {n} {n} by the server machine") for i, n in enumerate(names)]
    assert not any(n for _, _, n in dropped(spark, docs).values())


def test_fewer_documents_than_asked_for_and_repeats_within_one(spark):
    docs = [(1, "a line that comes twice\na line that comes twice\na line that comes twice"), (2, "a line that comes twice"), (3, "b")]
    assert not any(n for _, _, n in dropped(spark, docs).values())
    assert dropped(spark, docs, min_docs=2)[2] == ("", 1, 1)


def test_variants_spread_over_a_leaf_of_very_many_templates(spark):
    rng = random.Random(4)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n)]

    recurring, docs = [words(8) for _ in range(40)], []
    for i in range(3):
        own = [" ".join(["1", "2", "3", *words(8), "end"]) for _ in range(3000)]
        spread = [" ".join(["1", "2", "3", *line[:7], *words(1), "end"]) for line in recurring]
        # The last word is part of a line's path: variants of it are lines of their own.
        other_end = [" ".join(["1", "2", "3", *line, *words(1)]) for line in recurring]
        docs.append((i, "\n".join(own + spread + other_end)))
    assert {i: n for i, (_, _, n) in dropped(spark, docs).items()} == {0: 0, 1: 40, 2: 40}


def test_looking_templates_up_finds_what_comparing_all_does(monkeypatch):
    rng = random.Random(5)
    for width in (4, 7, 12):
        lines = [[rng.choice(["<*>", *"abcdefghij"]) for _ in range(width)] for _ in range(1500)]
        found = []
        for scanned in (10, 1 << 30):
            monkeypatch.setattr(line_templates, "SCANNED", scanned)
            templates = line_templates.Templates(width)
            found.append([templates.place(line, k, 0.75) for k, line in enumerate(lines)])
        assert found[0] == found[1] and len(set(found[0])) > 20


def test_odd_texts(odd, empty, odd_texts):
    found = drop_recurring_lines(odd, min_docs=2)
    assert found.columns[: len(odd.columns)] == odd.columns
    rows = found.collect()
    assert len(rows) == odd.count()
    texts = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    expected = dict(enumerate(odd_texts))
    expected[6] = ""  # the same line as document 5
    assert texts == expected
    assert drop_recurring_lines(empty).count() == 0


def test_all_documents(spark, corpus):
    rows = {r.doc_id: r for r in queries.op9_line_dedup(spark, SF_DIR).collect()}
    assert len(rows) == len(corpus) and any(r.n_dropped for r in rows.values())
    holders = defaultdict(set)
    for doc_id, text, _ in corpus:
        for line in text.split("\n"):
            holders[" ".join(masked(line.split()))].add(doc_id)
    for doc_id, text, _ in corpus:
        kept, lines = rows[doc_id].text.split("\n"), text.split("\n")
        assert rows[doc_id].n_lines == len(lines)
        left = iter(lines)
        assert not rows[doc_id].text or all(line in left for line in kept), "kept lines keep their order"
        for line in lines:
            own = holders[" ".join(masked(line.split()))]
            # What recurs as it stands goes, but from the first document.
            if len(line.split()) >= 3 and len(own) >= 3 and doc_id != min(own):
                assert line not in kept
    # A line whose tokens no other line of its length shares in three quarters stays.
    by_length = defaultdict(list)
    for doc_id, text, _ in corpus:
        for line in text.split("\n"):
            by_length[len(line.split())].append((doc_id, masked(line.split())))
    for doc_id, text, _ in corpus[::50]:
        for line in text.split("\n"):
            own = masked(line.split())
            similar = {d for d, t in by_length[len(own)] if sum(a == b for a, b in zip(own, t)) >= 0.75**2 * len(own)}
            if similar == {doc_id} and own:
                assert line in rows[doc_id].text.split("\n")
