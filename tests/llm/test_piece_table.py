import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from quillmark.llm import piece_table
from quillmark.llm.common import read
from tests.llm import edges


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piece_table.MODEL))


@pytest.fixture(scope="module")
def coder():
    return piece_table.PieceTable(public_tokenizers.path(piece_table.MODEL))


def test_same_ids_and_texts_as_the_library(coder, model):
    chance = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "▁", "e", "é", "漢", "😀", "\n", "\t", ".", ",", "ing", "23", "<s>", "\x00", "or", "er"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 50))) for _ in range(4000)]
    texts += [" " * n for n in range(70)] + ["a" * n for n in range(60)] + ["a" + " " * n + "b" for n in range(40)]
    for text in texts:
        ids = model.encode(text)
        found, decoded = coder.coded(text)
        assert found == ",".join(map(str, ids)), repr(text)
        assert decoded == coder.decode(found) == model.decode(ids)


def digests(model, text):
    ids = model.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))


@pytest.mark.parametrize("source", ["table", "edges"])
def test_documents(spark, sf, model, source):
    docs = read(spark, sf, "documents") if source == "table" else edges.documents(spark)
    rows = piece_table.encode_documents(docs).collect()
    found = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    assert found == sorted((r.doc_id or 0, *digests(model, r.text)) for r in docs.collect())


def test_empty_table_and_ids(spark):
    assert piece_table.encode_documents(edges.no_documents(spark)).count() == 0
    assert "ids" in piece_table.encode_documents(edges.documents(spark), ids=True).columns
