import random
import re
from collections import Counter

import numpy as np
import pytest

from quillmark.llm import collocations
from quillmark.llm.common import read
from tests.comparing import connect, differences
from tests.llm import edges


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, contained=100, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, 6):
                for at in range(len(words) - size + 1):
                    counts[lang, tuple(words[at : at + size])] += 1
    common = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= least}
    gone = set()
    for (lang, words), f in common.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                part = lang, words[at : at + size]
                if 100 * f >= contained * common[part]:
                    gone.add(part)
    out = []
    for (lang, words), a in common.items():
        if (lang, words) in gone:
            continue
        n = totals[lang]
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for l, r, k in cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), l, r, n))
    found, rank = [], Counter()
    for lang, score, a, phrase, l, r, n in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            found.append((lang, rank[lang], phrase.decode(), -a, l, r, n, -score))
    return found


def mined(docs, least, **more):
    df = collocations.mine_phrases(docs, least, **more)
    assert df.dtypes == [("lang", "string")] + [(c, "string" if c == "phrase" else "bigint") for c in df.columns[1:]]
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def made_up(seed, n, words=12):
    chance = random.Random(seed)
    stops = [" "] * 12 + [". ", ",", "\n", "\t", "  ", "\r\n", " \x1c "]
    names = [f"w{k}" for k in range(words)] + ["The", "THE", "the", "É", "é", "漢字", "a"]
    rows = []
    for _ in range(n):
        text = "".join(chance.choice(names[: chance.randint(2, len(names))]) + chance.choice(stops) for _ in range(chance.randint(0, 40)))
        rows.append((chance.choice(["en", "de", None, "und"]), text))
    return rows + [("en", None), (None, ""), ("de", " .. "), ("en", "new york city hall " * 40), ("en", "a a a a a a a")]


@pytest.mark.parametrize("shard", [1, 50, 1 << 20])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(collocations, "SHARD", shard)
    rows = made_up(1, 120)
    assert mined(frame(spark, rows), 4) == brute(rows, 4)


@pytest.mark.parametrize("contained, top", [(60, 2000), (100, 7)])
def test_other_settings(spark, contained, top):
    rows = made_up(2, 80, 5)
    assert mined(frame(spark, rows), 3, contained=contained, top=top) == brute(rows, 3, contained, top)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_sql(spark, sf_dir):
    assert differences(collocations.op12_collocations(spark, sf_dir), connect(sf_dir), collocations.ORACLE) == []


def test_edges(spark):
    docs = edges.documents(spark)
    assert mined(docs, 2) == brute([(r.lang, r.text) for r in docs.collect()], 2)
    assert mined(edges.no_documents(spark), 2) == []
    assert mined(frame(spark, [("en", "one two")]), 2) == []


def test_sums_beyond_64_bits(spark):
    big = spark.createDataFrame([(4 * 10**12, 5 * 10**12, 3 * 10**12 + 1, 2 * 10**12)], "a long, n long, l long, r long")
    assert big.selectExpr(f"{collocations.SCORE} AS x").first().x == 1000 * 4 * 5 * 10**24 // ((3 * 10**12 + 1) * 2 * 10**12)


def test_index_intervals():
    """Both directions stay in step and agree with counting, for any order of extensions."""
    chance = np.random.default_rng(1)
    text = np.append(chance.integers(0, 5, 400), 0)
    for order in ("rrrr", "llll", "rlrl", "llrr"):
        index = collocations.Index(text, 5)
        state = index.words()
        for side in order:
            state = index.extended(state, side == "l")
            size = state["phrase"].shape[1]
            windows = [tuple(text[k : k + size]) for k in range(len(text) - size + 1)]
            expected = Counter(w for w in windows if 0 not in w)
            assert dict(zip(map(tuple, state["phrase"].tolist()), state["count"].tolist())) == expected
            places = [tuple(p) for p in state["phrase"].tolist()]
            # Intervals in the forward order ascend with the phrase, backward ones with its reverse.
            assert [p for _, p in sorted(zip(state["lo"], places))] == sorted(places)
            assert [p for _, p in sorted(zip(state["back"], places))] == sorted(places, key=lambda p: p[::-1])


def test_runs():
    text = np.array([1, 2, 0, 3, 0, 4, 5, 6, 0])
    every = np.ones(9, bool)
    assert collocations.runs(text, every, 2).tolist() == [1, 2, 0, 4, 5, 6, 0]
    assert collocations.runs(text, every, 4).tolist() == [0]
    assert collocations.runs(text, np.array([1, 1, 1, 1, 1, 0, 1, 1, 1], bool), 2).tolist() == [1, 2, 0, 5, 6, 0]
    assert collocations.runs(np.zeros(0, int), np.zeros(0, bool), 2).tolist() == [0]
