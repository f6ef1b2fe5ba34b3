"""The Jaccard join against brute force over all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from gustline.llm import jaccard_join, queries
from tests.llm.conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(docs, size=5, percent=75):
    """doc_id, set size and component by comparing every pair that shares a shingle."""
    docs = [(i, frozenset(shingles(t, size))) for i, t in docs]
    holders = defaultdict(list)
    for k, (_, s) in enumerate(docs):
        for x in s:
            holders[x].append(k)
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, (_, s) in enumerate(docs):
        for other in {o for x in s for o in holders[x] if o < k}:
            t = docs[other][1]
            if 100 * len(s & t) >= percent * len(s | t):
                parent[top(k)] = top(other)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[top(k)] = min(i, least.get(top(k), i))
    return sorted((i, len(s), least[top(k)]) for k, (i, s) in enumerate(docs))


def rows(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_all_documents(spark, corpus):
    assert rows(queries.op1_jaccard_join(spark, SF_DIR)) == brute([(i, t) for i, t, _ in corpus])


@pytest.mark.parametrize("seed", [1, 2])
def test_families_near_the_threshold(spark, seed):
    rng = random.Random(seed)
    docs = []
    for family in range(6):
        base = [f"w{family}x{rng.randrange(60)}" for _ in range(rng.choice([6, 20, 60]))]
        for _ in range(40):
            own = [rng.choice("abc") if rng.random() < 0.03 else w for w in base]
            if rng.random() < 0.3:
                own = own[: rng.randrange(1, len(own) + 1)]
            docs.append((len(docs), " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard_join.near_duplicates(df)) == brute(docs)


def test_odd_texts(odd, empty):
    found = jaccard_join.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    docs = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None) == brute(docs)
    assert [(r.n_shingles, r.component_id) for r in found if r.doc_id is None] == [(1, None)]
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_tree_equals_set_arithmetic():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 400, 120)
    sets = [np.unique(np.where(rng.random(120) < rng.random() * 0.3, rng.integers(0, 400, 120), base)).astype("u8") for _ in range(80)]
    sets += [sets[0], sets[1][:50], np.array([7], "u8")]
    tree = jaccard_join.PrefixTree(sets)
    for probe in sets:
        expected = {
            i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 75 * len(np.union1d(s, probe))
        }
        assert set(tree.linked(probe, 75)) == expected


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(200, 260)] + [(9, 9), (3, 2)]
    found = {r.node: r.component for r in jaccard_join.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in [500, *range(200, 260)]} == {200}
    assert found[3] == found[2] == 2 and 9 not in found


def test_signatures_never_overstate_a_difference():
    rng = np.random.default_rng(9)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 400, dtype="u8")
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 400))) for _ in "ab")
        signs = [np.frombuffer(jaccard_join.signature(x), "u8") for x in (a, b)]
        lost = len(np.setxor1d(a, b)) - jaccard_join.difference(*signs)
        assert lost >= 0 and lost % 2 == 0


def test_signatures_tell_sets_apart_just_below_the_similarity():
    """Sets that share 70 of 100 elements differ too much for three quarters; hardly a pair passes."""
    rng = np.random.default_rng(10)
    passed = 0
    for _ in range(300):
        pool = np.unique(rng.integers(0, 1 << 63, 400, dtype="u8"))
        rng.shuffle(pool)
        a, b = pool[:340], pool[60:400]  # of 400, both hold 280
        signs = [np.frombuffer(jaccard_join.signature(x), "u8") for x in (a, b)]
        most = 680 - 2 * jaccard_join.needed(340, 340, 75)
        passed += jaccard_join.difference(*signs) <= most
    assert passed < 30


def test_reach_admits_the_first_common_element_of_every_link():
    rng = np.random.default_rng(11)
    linked = 0
    for _ in range(3000):
        pool = np.arange(rng.integers(2, 40))
        a, b = (np.flatnonzero(rng.random(len(pool)) < 0.85) for _ in "ab")
        common = np.intersect1d(a, b)
        if not len(common) or 100 * len(common) < 75 * len(np.union1d(a, b)):
            continue
        linked += 1
        i, j = (int(np.searchsorted(x, common[0])) for x in (a, b))
        assert i < jaccard_join.prefix_length(len(a), 75) and j < jaccard_join.prefix_length(len(b), 75)
        assert len(b) <= jaccard_join.reach(len(a), i, 75) and len(a) <= jaccard_join.reach(len(b), j, 75)
    assert linked > 100
