"""Packing: the plan by itself, and the pieces against the tokenizer's own ids."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from gustline.llm import packing, queries
from tests.llm.conftest import SF_DIR

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def check_places(rows, capacity):
    """No gap, no overlap, nothing beyond the capacity; returns the number of sequences."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def check_pieces(rows, docs, library, capacity):
    expected = Counter()
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            expected[doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected


def test_all_documents(spark, library, corpus):
    rows = queries.op6_packing(spark, SF_DIR).collect()
    check_pieces(rows, [(i, t) for i, t, _ in corpus], library, 4096)
    bound = -(-sum(r.length for r in rows) // 4096)
    assert check_places(rows, 4096) <= 1.02 * bound + 1


def test_odd_texts(odd, empty, library):
    rows = packing.pack_documents(odd, TOKENIZER, 64, 1).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd.collect()], library, 64)
    check_places(rows, 64)
    assert packing.pack_documents(empty, TOKENIZER, 64, 1).count() == 0


def test_ids_on_request(spark, library):
    docs = spark.createDataFrame([(1, "some words to pack")], "doc_id long, text string")
    row = packing.pack_documents(docs, TOKENIZER, 4096, 1, with_ids=True).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == [*library.encode("some words to pack").ids, 1]


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_piece(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1000, 4096])
    lengths = [rng.choice([rng.randint(1, capacity), capacity, 1, capacity // 3 or 1]) for _ in range(rng.randrange(2000))]
    histogram = Counter(lengths)
    patterns = packing.plan(dict(histogram), capacity)
    placed = Counter()
    for pattern, times in patterns:
        assert times > 0 and 0 < sum(n * m for n, m in pattern) <= capacity
        for length, each in pattern:
            placed[length] += each * times
    assert placed == histogram
    # Never worse than next-fit's bound of twice the least, and near it for many pieces.
    least = -(-sum(lengths) // capacity)
    assert sum(times for _, times in patterns) <= 2 * least + 1


def test_plan_is_near_the_least_for_many_lengths():
    rng = random.Random(1)
    lengths = Counter(min(4096, int(rng.lognormvariate(6.3, 1.1)) + 1) for _ in range(50_000))
    sequences = sum(times for _, times in packing.plan(lengths, 4096))
    assert sequences <= 1.005 * sum(n * m for n, m in lengths.items()) / 4096 + 1


def test_places_are_distinct():
    rng = random.Random(2)
    histogram = Counter(rng.randint(1, 50) for _ in range(3000))
    places = packing.Places(packing.plan(dict(histogram), 64))
    taken = set()
    for length, n in histogram.items():
        sequences, offsets = places.find(np.full(n, length), np.arange(n))
        for s, o in zip(sequences.tolist(), offsets.tolist()):
            new = {(s, o + i) for i in range(length)}
            assert not new & taken
            taken |= new


words = packing.WordIds(TOKENIZER)


@settings(max_examples=400, deadline=None)
@given(
    st.lists(
        st.text(alphabet=st.one_of(st.sampled_from("aZ İıſK.,!?'9 \n\té漢😀\u0307\u0301"), st.characters(codec="utf-8")), max_size=40),
        max_size=4,
    )
)
@example(["MESAİ.", "EVİ. VE", "İ,", "aİ. b", "İa."])
def test_any_text_has_the_librarys_ids(library, texts):
    for text, ids in zip(texts, words.of(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
