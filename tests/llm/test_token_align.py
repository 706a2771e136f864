import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from quillmark.llm import token_align
from quillmark.llm.common import read
from tests.llm import edges


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path(token_align.MODEL_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_align.MODEL_B))


def byte_table():
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table, spare = {chr(b): b for b in keep}, 256
    for b in range(256):
        if b not in keep:
            table[chr(spare)], spare = b, spare + 1
    return table


TABLE = byte_table()


def tokens(libraries, text):
    """(id, start, end) of both sides by whole-text encoding and decoded bytes alone."""
    a, b = libraries
    if not text:
        return [], []
    raw = (" " + text).encode()
    one = [(t.id, bytes(TABLE[c] for c in a.id_to_token(t.id))) for t in (type("T", (), {"id": i}) for i in a.encode(" " + text, add_special_tokens=False).ids)]
    two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    out = []
    for side in (one, two):
        if b"".join(x for _, x in side) != raw:
            return [], []
        at, placed = 0, []
        for i, x in side:
            placed.append((i, at, at + len(x)))
            at += len(x)
        out.append(placed)
    return tuple(out)


def brute(libraries, texts):
    sides = [tokens(libraries, x) for x in texts]
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in sides]
    held = Counter(p for some in links for p in set(some))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (a, b), some in zip(sides, links):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, at = [], 0
        for cut in cuts:
            inside = [",".join(str(x[0]) for x in side if at < x[2] <= cut) for side in (a, b)]
            groups.append("|".join(inside))
            at = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(held[p] == best[p[0]] for p in some)
        out.append((len(a), len(b), len(groups), len(some), n_best, sum(held[p] for p in some), digest))
    return out


def result(df):
    return sorted((r.doc_id or 0, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def hard_texts(n):
    chance = random.Random(3)
    parts = ["a", "the", " ", "  ", "▁", "é", "漢字", "😀", "👩‍👩‍👧", "\n", "\n\n", "\t", ".", "'s", "ing", "2024", "<s>", "<|endoftext|>", "<0x41>", "\x00", "\x1c", " ", "　", "ﬁ", "é", "ཀ", "𐍈"]
    return ["".join(chance.choice(parts) for _ in range(chance.randint(0, 24))) for _ in range(n)] + [" x", "x ", " ", "  ", "\n"]


def test_hard_texts(spark, libraries):
    texts = hard_texts(600)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = sorted((k, *x) for k, x in enumerate(brute(libraries, texts)))
    assert result(token_align.align_documents(docs)) == expected


@pytest.mark.parametrize("hot", [0, 50, token_align.HOT])
def test_any_number_of_broadcast_pairs(spark, sf, libraries, monkeypatch, hot):
    monkeypatch.setattr(token_align, "HOT", hot)
    docs = read(spark, sf, "documents").where("n_chars < 1500")
    rows = docs.select("doc_id", "text").collect()
    expected = sorted((r.doc_id, *x) for r, x in zip(rows, brute(libraries, [r.text for r in rows])))
    assert result(token_align.align_documents(docs)) == expected


def test_edges(spark, libraries):
    rows = [r for r in edges.rows() if len(r[1] or "") < 5000]
    docs = spark.createDataFrame(rows, edges.SCHEMA)
    expected = sorted((r[0] or 0, *x) for r, x in zip(rows, brute(libraries, [r[1] for r in rows])))
    assert result(token_align.align_documents(docs)) == expected
    assert token_align.align_documents(edges.no_documents(spark)).count() == 0


def test_long_text_and_groups(spark, libraries):
    text = " ".join(f"t{i % 977}é" for i in range(30_000)) + "x" * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = token_align.linked_documents(docs, groups=True).first()
    a, b = tokens(libraries, text)
    assert (row.n_a, row.n_b) == (len(a), len(b))
    assert [int(x) for g in row.groups.split(";") for x in g.split("|")[0].split(",")] == [x[0] for x in a]
    assert [int(x) for g in row.groups.split(";") for x in g.split("|")[1].split(",")] == [x[0] for x in b]


def test_words_forgotten_in_between(libraries, monkeypatch):
    monkeypatch.setattr(token_align, "WORDS", 5)
    both = token_align.Aligner(public_tokenizers.path(token_align.MODEL_A), public_tokenizers.path(token_align.MODEL_B))
    texts = [f"a b{k % 7} c{k % 3} dé" for k in range(40)]
    assert [both.documents([x])[0] for x in texts] == both.documents(texts)
