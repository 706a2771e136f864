import math
from collections import Counter

from pyspark.sql import functions as F

from quillmark.operators.lm import BigramModel, sentence_log_probability, train_bigrams, window_perplexity
from quillmark.operators.skew import balanced_lookup, hot_keys

TRAIN = ["the cat sat. the cat ran! the dog sat.", "a cat. one", "of the of the of the of the"]
SCORED = [*TRAIN, "the bird sat. cat", "single", "", "one. Two. three. of the of. x y", None]


def python_perplexity(sentences, i, r, pairs, contexts, vocabulary, k):
    inside = [w for s in sentences[max(0, i - r) : i + r + 1] for w in s.lower().split()]
    if not inside:
        return 0.0
    if len(inside) == 1:
        return 1.0
    logs = [
        round(1e6 * (math.log(pairs[p] + k) - math.log(contexts[p[0]] + k * vocabulary)))
        for p in zip(inside, inside[1:])
    ]
    return math.exp(-sum(logs) / (len(logs) * 1e6))


def split(text):
    import re

    return re.sub(r"([.!?]+) ", r"\1\n", text or "").split("\n")


def test_perplexity_equals_brute_force(spark):
    pairs = Counter()
    for text in TRAIN:
        words = text.lower().split()
        pairs.update(zip(words, words[1:]))
    contexts = Counter()
    for (a, _), n in pairs.items():
        contexts[a] += n
    vocabulary = len({w for p in pairs for w in p})

    train = spark.createDataFrame(list(enumerate(TRAIN)), "doc_id int, text string")
    scored = spark.createDataFrame(list(enumerate(SCORED)), "doc_id int, text string")
    model = train_bigrams(train, k=0.1)
    assert model.vocabulary == vocabulary
    rows = window_perplexity(scored, model).collect()
    assert len(rows) == sum(len(split(t)) for t in SCORED)
    for row in rows:
        for r in (0, 1, 2):
            wanted = python_perplexity(
                split(SCORED[row.doc_id]), row.sentence_index, r, pairs, contexts, vocabulary, 0.1
            )
            assert abs(row[f"window_{2 * r + 1}_perplexity"] - wanted) < 1e-9 * max(wanted, 1)


def test_model_reloads_and_partitioning_does_not_matter(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(40)
    path = str(tmp_path / "model")
    model = train_bigrams(docs, path=path)
    again = BigramModel.load(spark, path)
    one = {tuple(r) for r in window_perplexity(docs.coalesce(1), model).collect()}
    many = {tuple(r) for r in window_perplexity(docs.repartition(9), again).collect()}
    assert one == many


def skewed(spark):
    """A third of the rows share a key, a third have none, the rest vary."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    return spark.range(9000).select("id", key.alias("k"))


def test_balanced_lookup_equals_a_plain_join(spark):
    rows = skewed(spark)
    table = rows.filter("k is not null and id % 2 = 0").select("k").distinct()
    table = table.withColumn("v", F.length("k"))
    got = balanced_lookup(rows, table, ["k"], "v", hot_keys(rows, ["k"], 10), ["id"])
    assert sorted(got.collect()) == sorted(rows.join(table, "k", "left").select("id", "k", "v").collect())


def test_balanced_lookup_spreads_hot_and_null_keys(spark):
    rows = skewed(spark)
    table = rows.filter("k is not null").select("k").distinct().withColumn("v", F.lit(1))
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = balanced_lookup(rows, table, ["k"], "v", hot_keys(rows, ["k"], 10), ["id"])
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 9000 and len(sizes) == 8 and max(sizes) < 2 * 9000 / 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_answers_are_stored_before_the_shards_are_shuffled(spark):
    """Only the shards and the stored answers meet in the last plan; no lookup of pairs is left in it."""
    docs = spark.createDataFrame([(1, "A b c. B c."), (2, "C a. A b."), (3, None)], "doc_id bigint, text string")
    rows = sentence_log_probability(docs, train_bigrams(docs))
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.n_word for r in rows.where("sentence_index = 0").collect()} == {1: 3, 2: 2, 3: 0}
