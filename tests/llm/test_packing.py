import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillmark.llm import packing
from quillmark.llm.common import read
from tests.llm import edges


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    found.encode_special_tokens = True
    return found


def test_ids_are_those_of_the_library(tokenizer):
    coder = packing.ByteBpe(public_tokenizers.path(packing.VOCABULARY))
    chance = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\t", ".", ",", "'s", "é", "漢", "😀", "12", "\xa0", "\x1c", "<|endoftext|>", "word."]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 40))) for _ in range(3000)]
    expected = [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [coder.encode(x) for x in texts] == expected


def test_cut():
    assert packing.cut(5) == [(0, 5)]
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 1), (1, 2048)]
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]


def test_knapsack_finds_the_best_pattern():
    price = np.zeros(13)
    price[[3, 5, 7]] = [3.1, 5.3, 7.2]
    value, taken = packing.price_patterns(price, 12)
    assert value[12] == pytest.approx(12.5)
    counts = packing.pattern_with(7, taken)
    assert counts == {7: 1, 5: 1}
    assert sum(k * n for k, n in packing.pattern_with(3, taken).items()) <= 12


def stocked(histogram, capacity=2048):
    stock = np.zeros(capacity + 1, np.int64)
    for l, n in histogram.items():
        stock[l] = n
    return stock


def number(chosen):
    return sum(n for _, n in chosen)


def test_the_program_is_solved_where_best_fit_is_not_enough():
    # 10,125: 4,500 of 683+683+682, 2,250 of 684+682+682 and 3,375 of 684+684.
    histogram = {682: 9000, 683: 9000, 684: 9000}
    found = packing.solve(stocked(histogram), 2048)
    assert found.dual <= 10_125 + 1e-6 <= found.primal + 1
    assert found.primal / found.dual < 1.001
    assert number(packing.plan(histogram)) <= 10_130
    assert number(packing.best_fit(stocked(histogram), 2048)) == 10_500


def test_prices_are_a_bound_for_every_plan():
    chance = random.Random(8)
    for _ in range(5):
        histogram = {chance.randint(2, 20): chance.randint(1, 60) for _ in range(4)}
        found = packing.solve(stocked(histogram, 20), 20)
        value, _ = packing.price_patterns(found.price, 20)
        assert value[20] <= 1 + 1e-9
        assert found.dual <= number(packing.plan(histogram, 20)) + 1e-6


@pytest.mark.parametrize("name", ["three", "humps", "flat"])
def test_never_more_than_best_fit(name):
    chance = np.random.default_rng(4)
    histogram = {
        "three": {682: 900, 683: 900, 684: 900},
        "humps": collections.Counter([*chance.integers(1025, 2048, 4000).tolist(), *chance.integers(5, 901, 3000).tolist()]),
        "flat": {l: 10 for l in range(1, 2048)},
    }[name]
    chosen = packing.plan(histogram)
    used = collections.Counter()
    for counts, n in chosen:
        assert sum(l * k for l, k in counts.items()) <= 2048
        for l, k in counts.items():
            used[l] += k * n
    assert used == collections.Counter(histogram)
    assert number(chosen) <= number(packing.best_fit(stocked(histogram), 2048))


def test_grouped_best_fit_is_best_fit_piece_by_piece():
    chance = random.Random(9)
    for _ in range(200):
        histogram = {chance.randint(1, 30): chance.randint(1, 9) for _ in range(8)}
        rooms = []
        for l in sorted(histogram, reverse=True):
            for _ in range(histogram[l]):
                fitting = [k for k, r in enumerate(rooms) if r >= l]
                if fitting:
                    rooms[min(fitting, key=rooms.__getitem__)] -= l
                else:
                    rooms.append(30 - l)
        chosen = packing.best_fit(stocked(histogram, 30), 30)
        assert number(chosen) == len(rooms)
        assert sorted(rooms) == sorted(30 - sum(l * k for l, k in c.items()) for c, n in chosen for _ in range(n))


@pytest.mark.parametrize("n", [0, 1, 50, 30_000])
def test_plan_uses_up_the_histogram_near_the_bound(n):
    chance = np.random.default_rng(n)
    lengths = np.minimum(2048, (chance.lognormal(6.5, 1, n) + 1).astype(int))
    histogram = collections.Counter(lengths.tolist())
    used = collections.Counter()
    sequences = 0
    for counts, times in packing.plan(histogram):
        assert sum(k * c for k, c in counts.items()) <= 2048
        sequences += times
        for k, c in counts.items():
            used[k] += c * times
    assert used == histogram
    assert sequences <= -(-int(lengths.sum()) // 2048) * 1.005 + 2


def check_rows(rows, expected):
    """Pieces are the documents' own, and sequences are gapless and fit."""
    assert sorted((r.doc_id is None, r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id) == sorted(
        x for x in expected if x[1]
    )
    filled = collections.defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(filled) <= -(-total // 2048) * 1.02 + 2


def brute(rows, tokenizer):
    out = []
    for r in rows:
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        for k, (a, n) in enumerate(packing.cut(len(ids) // 4)):
            out.append((r["doc_id"] is None, r["doc_id"], k, a, n, zlib.crc32(ids[4 * a : 4 * (a + n)])))
    return out


def test_documents(spark, sf, tokenizer):
    docs = read(spark, sf, "documents")
    check_rows(packing.pack_documents(docs).collect(), brute(docs.collect(), tokenizer))


def test_edges(spark, tokenizer):
    docs = edges.documents(spark)
    rows = packing.pack_documents(docs).collect()
    check_rows(rows, brute(docs.collect(), tokenizer))
    assert [(r.length, r.piece) for r in rows if r.doc_id in (4, 5)] == [(1, 0), (1, 0)]
    assert packing.pack_documents(edges.no_documents(spark)).count() == 0
