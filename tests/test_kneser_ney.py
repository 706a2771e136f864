import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillmark.operators import kneser_ney as kn
from quillmark.operators import lm

TRAIN = ["the cat sat. the cat ran! the dog sat.", "a cat. one", "of the of the of the of the", "the cat sat on the mat."]
SCORED = [*TRAIN, "the bird sat. cat", "single", "", "of x y. on the cat", None]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def sentences(text):
    import re

    return re.sub(r"([.!?]+) ", r"\1\n", text or "").split("\n")


def grams(sentence):
    words = sentence.lower().split()
    padded = [kn.START, kn.START, *words, kn.END]
    return list(zip(padded, padded[1:], padded[2:])) if words else []


class Brute:
    """The textbook recursion over plain counters."""

    def __init__(self, texts):
        self.three = Counter(g for t in texts for s in sentences(t) for g in grams(s))
        self.two = Counter((b, c) for _, b, c in self.three)
        self.one = Counter(c for _, c in self.two)
        self.d = []
        for table in (self.one, self.two, self.three):
            n = Counter(table.values())
            self.d.append(n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5)
        self.after3, self.after2 = defaultdict(dict), defaultdict(dict)
        for (a, b, c), n in self.three.items():
            self.after3[a, b][c] = n
        for (b, c), n in self.two.items():
            self.after2[b][c] = n

    def p(self, a, b, c):
        size = len(self.one)
        low = max(self.one[c] - self.d[0], 0) / len(self.two) + self.d[0] * size / len(self.two) / (size + 1)
        for context, d in ((self.after2.get(b), self.d[1]), (self.after3.get((a, b)), self.d[2])):
            if context:
                total = sum(context.values())
                low = max(context.get(c, 0) - d, 0) / total + d * len(context) / total * low
        return low


@pytest.fixture(scope="module")
def model(spark):
    return kn.train(frame(spark, TRAIN))


def test_perplexity_equals_brute_force(spark, model):
    brute = Brute(TRAIN)
    assert model.discounts == pytest.approx(tuple(brute.d)) and model.vocabulary == len(brute.one)
    rows = kn.window_perplexity(frame(spark, SCORED), model).collect()
    assert len(rows) == sum(len(sentences(t)) for t in SCORED)
    for row in rows:
        found = sentences(SCORED[row.doc_id])
        for r in (0, 1, 2):
            inside = [g for s in found[max(0, row.sentence_index - r) : row.sentence_index + r + 1] for g in grams(s)]
            logs = [round(1e6 * math.log(brute.p(*g))) for g in inside]
            wanted = math.exp(-sum(logs) / (len(logs) * 1e6)) if logs else 0.0
            assert row[f"window_{2 * r + 1}_perplexity"] == pytest.approx(wanted, rel=1e-9)


def test_every_context_sums_to_one(spark, model):
    """Over the vocabulary and one unknown word, in Spark, for seen and unseen contexts."""
    words = [r.c for r in model.tables["words"].collect()] + ["unknown word"]
    seen = [(r.a, r.b) for r in model.tables["contexts_3"].collect()]
    contexts = seen + [("cat", "the"), ("x", "cat"), ("x", "y")]
    rows = spark.createDataFrame([(a, b, c) for a, b in set(contexts) for c in words], "a string, b string, c string")
    sums = kn.probabilities(rows, model).groupBy("a", "b").agg(F.sum("p").alias("p"), F.min("p").alias("least")).collect()
    assert len(sums) == len(set(contexts))
    for r in sums:
        assert r.p == pytest.approx(1.0, abs=1e-12) and r.least > 0


def test_held_out_text_is_less_surprising_than_under_added_counts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").select("doc_id", "text")
    held_out = F.col("doc_id") % 4 == 0
    known, unseen = docs.where(~held_out), docs.where(held_out)
    ours = kn.sentence_log_probability(unseen, kn.train(known)).agg(F.sum("log_p"), F.sum("n_gram")).first()
    other = lm.sentence_log_probability(unseen, lm.train_bigrams(known, k=0.1))
    other = other.agg(F.sum(F.col("log_in") + F.col("log_cross")), F.sum(F.col("n_in") + F.col("n_cross"))).first()
    ours, other = (math.exp(-log / (1e6 * n)) for log, n in (ours, other))
    print(f"held-out perplexity: Kneser-Ney {ours:.0f}, add-k {other:.0f}")
    assert ours < 0.8 * other


def test_empty_corpus_and_reload(spark, tmp_path):
    nothing = kn.train(frame(spark, [None, " "]))
    rows = kn.window_perplexity(frame(spark, ["one two"]), nothing).collect()
    assert [r.window_1_perplexity for r in rows] == [1.0]
    path = str(tmp_path / "model")
    first = kn.train(frame(spark, TRAIN).repartition(3), path=path)
    again = kn.KneserNey.load(spark, path)
    scored = lambda m: sorted(map(tuple, kn.window_perplexity(frame(spark, SCORED), m).collect()))
    assert scored(first) == scored(again)


def test_trigrams_of_known_texts_are_one_row_a_shard(spark, monkeypatch):
    """Scoring the training corpus stores a row for each different trigram of a shard, and no lookups."""
    stored, kept = {}, kn.stage

    def counted(df, name, *more):
        out = kept(df, name, *more)
        stored[name] = out.count()
        return out

    docs = frame(spark, TRAIN * 20).coalesce(1)
    model = kn.train(docs)
    monkeypatch.setattr(kn, "stage", counted)
    rows = kn.sentence_log_probability(docs, model).collect()
    assert sum(r.n_gram for r in rows) == 20 * sum(len(grams(s)) for t in TRAIN for s in sentences(t))
    different = len({g for t in TRAIN for s in sentences(t) for g in grams(s)})
    assert stored and max(stored.values()) == different
    assert not [name for name in stored if name.startswith("looked-up")]
