import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillmark.functions.language import detect_language
from quillmark.functions.text import clean_text
from quillmark.operators import language_model as L

TRAIN = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "the house, The END", "en"), (4, None, "de"), (5, "xx", None)]
SCORED = [(1, "the END of the house"), (2, "Hund Katze Maus"), (3, None), (4, "1234 ..."), (5, "q" * 5000), (6, "ÄÖÜ straße"), (None, "the")]


def grams(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return [f" {w} "[k : k + 3] for w in words for k in range(len(w))]


def brute(train, scored):
    langs = sorted({x for _, _, x in train if x})
    counts = {x: Counter(g for _, t, y in train if y == x for g in grams(t)) for x in langs}
    docs = Counter(x for _, _, x in train if x)
    kinds = len(set().union(*counts.values()))
    out = []
    for i, t in scored:
        costs = []
        for x in langs:
            below = sum(counts[x].values()) + 0.5 * (kinds + 1)
            log = lambda p: round(1e6 * math.log(p))
            costs.append((-log(docs[x] / sum(docs.values())) - sum(log((counts[x][g] + 0.5) / below) for g in grams(t)), x))
        costs.sort()
        out.append((i, costs[0][1], costs[1][0] - costs[0][0]))
    return out


def test_equals_brute_force(spark):
    train = spark.createDataFrame(TRAIN, "doc_id int, text string, lang string")
    scored = spark.createDataFrame(SCORED, "doc_id int, text string")
    found = [tuple(r) for r in L.identify(scored, L.train(train)).collect()]
    order = lambda r: (r[0] is None, r[0])
    # Words of rows without a key are summed under a null key, which joins nothing.
    expected = [r for r in brute(TRAIN, SCORED) if r[0] is not None]
    assert sorted([r for r in found if r[0] is not None], key=order) == sorted(expected, key=order)
    assert len(found) == len(SCORED)


def test_better_than_stop_words_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    unseen = docs.where(held_out & F.col("lang").isNotNull())
    found = L.identify(unseen, L.train(docs.where(~held_out))).join(unseen, "doc_id")
    ours = found.agg(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    rule = unseen.select(F.avg((detect_language(clean_text(F.col("text"))) == F.col("lang")).cast("double"))).first()[0]
    print(f"held-out accuracy: trigrams {ours:.4f}, stop words {rule:.4f}")
    assert ours > 0.95 and ours > rule


def test_no_languages(spark):
    nothing = spark.createDataFrame([(1, "a", None)], "doc_id int, text string, lang string")
    with pytest.raises(ValueError, match="no languages"):
        L.train(nothing)
    one = spark.createDataFrame([(1, "a", "en")], "doc_id int, text string, lang string")
    assert [tuple(r) for r in L.identify(one, L.train(one)).collect()] == [(1, "en", None)]
