"""Decontamination against brute force over words."""

import hashlib
import random
import re

import pytest

from gustline.llm.decontamination import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size):
    out = []
    for doc_id, text in docs:
        own, hit, ids = words(text), set(), set()
        for item_id, item in items:
            item = words(item)
            k = min(size, len(item))
            for s in range(len(item) - k + 1) if k and item_id is not None else ():
                for p in range(len(own) - k + 1):
                    if own[p : p + k] == item[s : s + k]:
                        hit.update(range(p, p + k))
                        ids.add(str(item_id))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(ids), sha, bool(hit)))
    return out


def rows(df):
    found = df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    return sorted(map(tuple, found), key=repr)


@pytest.mark.parametrize("seed,size", [(1, 4), (2, 10), (3, 3), (4, 1)])
def test_equals_brute_force(spark, seed, size):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choices(["a", "B", "c", "É", "é", "12"], k=n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 12]))) for i in range(12)] + [(3, text(6)), (3, text(6)), (None, "a a")]
    docs = [(i, ", ".join([text(9), rng.choice(items)[1] or "", text(7)])) for i in range(30)]
    docs += [(30, None), (31, ""), (5, "a"), (5, "a"), (None, items[-2][1]), (33, items[4][1])]
    found = decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS hash", "2 AS item_id", "3 AS start"),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS hash"),
        size,
    )
    assert rows(found) == sorted(brute(docs, items, size), key=repr)


def test_odd_texts(spark, odd, empty):
    items = [(1, "same words here again and again"), (2, "漢字 😀 é")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(decontaminate(odd, benchmark)) == sorted(brute(docs, items, 10), key=repr)
    assert decontaminate(empty, benchmark).count() == 0
    assert not any(r.contaminated for r in decontaminate(odd, benchmark.limit(0)).collect())


def test_no_python_in_the_plan(spark, odd):
    benchmark = spark.createDataFrame([(1, "same words here again")], "item_id long, text string")
    plan = decontaminate(odd, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
