import math
import re
from collections import Counter

import pytest

from quillmark.operators import sentence_model as S

NAMES = ["Smith", "Jones", "Miller", "Brown", "Lee"]


def corpus():
    """Texts with an abbreviation before names, plain ends before a few starters, and numbers."""
    out = []
    for k in range(120):
        name = NAMES[k % 5]
        out.append(f"The house of dr. {name} was old. It had no garden there! Nobody went to dr. {name} on day {k}. of the year. The end came e.g. late. It was so. An old late year was so far there again and far away.")
    return out


def brute(texts):
    tokens = [[w for w in t.split(" ") if w] for t in texts]
    flat = [w for ws in tokens for w in ws]
    base = lambda w: re.sub(r"\.$", "", w.lower())
    with_period = Counter(base(w) for w in flat if w.endswith("."))
    without = Counter(base(w) for w in flat if not w.endswith("."))
    share = sum(with_period.values()) / len(flat)
    ln = lambda n, p: n * math.log(p) if n else 0.0
    short = {}
    for w, a in with_period.items():
        if re.fullmatch(r"[^\W\d_](?:[^\W\d_]|[.-])*", w):
            b, inner = without[w], w.count(".")
            letters = len(w) - inner
            ratio = -2 * (ln(a, share) + ln(b, 1 - share) - ln(a, 0.99) - ln(b, 1 - 0.99))
            score = ratio * math.exp(-letters) * (inner + 1) * float(letters) ** -b
            if score >= 0.3:
                short[w] = score
    return short


@pytest.fixture(scope="module")
def model(spark):
    return S.train(spark.createDataFrame(list(enumerate(corpus())), "doc_id int, text string"))


def test_abbreviations_equal_brute_force(model):
    found = {r.word: r.score for r in model.abbreviations.collect()}
    expected = brute(corpus())
    assert set(found) == set(expected) and {"dr", "e.g"} <= set(found)
    assert all(found[w] == pytest.approx(s) for w, s in expected.items())


def test_starters(model):
    found = {r.word for r in model.starters.collect()}
    assert {"it", "nobody"} <= found and not found & {"smith", "house", "late"}


def counts(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.sentences for r in sorted(S.sentence_counts(docs, model).collect())]


def test_decisions(spark, model):
    texts = [
        "He saw dr. Smith today. It was late.",
        "He saw the dr. It was late.",
        "On the 3. of May. A. Jones came.",
        "Why? Because! Yes.",
        "no end at all",
        "",
        None,
        "unknown. word. Ends.",
    ]
    assert counts(spark, model, texts) == [2, 2, 2, 3, 1, 0, 0, 3]


def test_empty_corpus(spark):
    model = S.train(spark.createDataFrame([], "doc_id int, text string"))
    assert model.abbreviations.count() == 0 and model.starters.count() == 0
    assert counts(spark, model, ["One. Two."]) == [2]
