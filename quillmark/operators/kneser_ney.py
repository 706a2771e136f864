"""Trigram language model with interpolated Kneser-Ney smoothing.

The three orders are three count tables: how often a trigram occurs, after how many
different words a pair occurs, and after how many different words a word occurs. Each
order gives up a discount per kind, estimated from its counts of one and two, and spreads
it over the next lower order; the lowest spreads it evenly over the vocabulary and one
unknown word. A context that was never seen hands over to the lower order whole.

Texts go by shards of numbered words (``shards.py``), and tables by whole numbers. Scoring
takes each different trigram of a shard once: those of the training corpus meet the model's
tables in one chain of joins, and only the rest is looked up order by order. What is found
goes back to the shard, which sums it up by sentence. Log probabilities are whole millionths,
so sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.operators.shards import Shard, entries, numbered, shards, summed, together, vocabulary
from quillmark.operators.skew import balanced_lookup, hot_keys
from quillmark.operators.windows import window_name
from quillmark.sources.staging import new_folder, stage
from quillmark.sources.tables import read_json, write_json

UNIT = 1_000_000
#: Commonest keys that are broadcast in a lookup.
HOT = 1000
#: Marks in front of and behind a sentence.
START, END = "\x02", "\x03"
#: Their numbers in every shard are 1 and 2.
MARKS = (START, END)
TABLES = {
    "trigrams": ["a", "b", "c"], "contexts_3": ["a", "b"], "bigrams": ["b", "c"], "contexts_2": ["b"], "words": ["c"],
}


def trigrams(shard: Shard) -> list[np.ndarray]:
    """The trigrams of each sentence with words, its end included; see ``scored_in``."""
    number = np.cumsum(shard.n_word > 0) - 1
    long = shard.n_word[shard.n_word > 0] + 1
    c = np.full(int(long.sum()), 2)
    c[np.arange(len(shard.tokens)) + number[shard.of]] = shard.tokens
    first = np.cumsum(long) - long
    at = np.arange(len(c)) - np.repeat(first, long)
    a, b = (np.where(at < k, 1, np.roll(c, k)) for k in (2, 1))
    return [a, b, c]


def scored_in(shard: Shard) -> np.ndarray:
    """In which sentence each trigram stands."""
    return np.repeat(np.arange(len(shard.n_word)), np.where(shard.n_word > 0, shard.n_word + 1, 0))


@dataclass(frozen=True)
class KneserNey:
    """Stored count tables with unique keys, and the numbers they share.

    ``trigrams``: a, b, c, n. ``bigrams``: b, c, n and ``words``: c, n with kinds in front.
    ``contexts_3``: a, b and ``contexts_2``: b, each with ``x`` (total, kinds behind).
    ``by_id`` holds them as stored, by the ids of ``spelled`` (word, id).
    """

    by_id: dict[str, DataFrame]
    spelled: DataFrame
    discounts: tuple[float, float, float]
    vocabulary: int
    pairs: int

    @property
    def tables(self) -> dict[str, DataFrame]:
        """The tables by words."""
        return {name: _renamed(self.by_id[name], keys, self.spelled) for name, keys in TABLES.items()}

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KneserNey:
        sizes = read_json(spark, f"{path}/sizes")
        by_id = {name: spark.read.parquet(f"{path}/{name}") for name in TABLES}
        spelled = spark.read.parquet(f"{path}/vocabulary")
        return cls(by_id, spelled, tuple(sizes["discounts"]), sizes["vocabulary"], sizes["pairs"])


def _renamed(table: DataFrame, keys: list[str], spelled: DataFrame) -> DataFrame:
    for k in keys:
        names = spelled.select(F.col("id").alias(k), F.col("word").alias(f"{k}_word"))
        table = table.join(names, k).drop(k).withColumnRenamed(f"{k}_word", k)
    return table.select(*keys, *[c for c in table.columns if c not in keys])


def _discount(table: DataFrame) -> float:
    """n1 / (n1 + 2 n2) from how many entries count 1 and 2; a half if none counts 1."""
    ones, twos = table.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    return ones / (ones + 2.0 * twos) if ones else 0.5


def _contexts(table: DataFrame, *keys: str) -> DataFrame:
    return table.groupBy(*keys).agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).select(
        *keys, F.struct("total", "kinds").alias("x")
    )


def train(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    max_sentences: int | None = None,
    table: DataFrame | None = None,
) -> KneserNey:
    """Count a corpus. Null and blank texts add nothing; repeated rows count each time.

    ``table`` are its shards with the ``MARKS`` in front, if already made.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, "kneser-ney")
    keep = lambda table, name: stage(table, name, f"{path}/{name}")
    table = shards(df, key, text, max_sentences, MARKS) if table is None else table
    spelled = keep(vocabulary(table), "vocabulary")
    found = entries(numbered(table, spelled), trigrams, ["a", "b", "c"])
    threes = keep(found.groupBy("a", "b", "c").agg(F.sum("n").alias("n")), "trigrams")
    bigrams = keep(threes.groupBy("b", "c").agg(F.count("*").alias("n")), "bigrams")
    words = keep(bigrams.groupBy("c").agg(F.count("*").alias("n")), "words")
    keep(_contexts(threes, "a", "b"), "contexts_3")
    keep(_contexts(bigrams, "b"), "contexts_2")
    sizes = {
        "discounts": [_discount(t) for t in (words, bigrams, threes)],
        "vocabulary": words.count(),
        "pairs": bigrams.count(),
    }
    write_json(spark, sizes, f"{path}/sizes")
    return KneserNey.load(spark, path)


def _named(table: DataFrame, name: str) -> DataFrame:
    return table.withColumnRenamed("x" if name.startswith("contexts") else "n", name)


def probabilities(grams: DataFrame, model: KneserNey, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add ``p`` to rows of distinct trigrams (a, b, c); unknown words share one place.

    ``tables`` are those of the model by other text keys than words.
    """
    tables = tables or model.tables
    rows = grams
    for name, columns in TABLES.items():
        hot = hot_keys(grams, columns, HOT)
        rows = balanced_lookup(rows, _named(tables[name], name), columns, name, hot, ["a", "b", "c"])
        rows = stage(rows, f"looked-up-{name}")
    return rows.select(*grams.columns, _probability(model).alias("p"))


def _probability(model: KneserNey) -> Column:
    """From columns that are named like the tables and hold what these know, null if nothing."""
    d1, d2, d3 = (F.lit(float(d)) for d in model.discounts)
    unknown = F.lit(1.0 / (model.vocabulary + 1.0))
    pairs, kinds = F.lit(float(max(model.pairs, 1))), F.lit(float(model.vocabulary))

    def kept(name: str, discount: Column) -> Column:
        return F.greatest(F.coalesce(F.col(name), F.lit(0)) - discount, F.lit(0.0))

    def mixed(name: str, context: str, discount: Column, lower: Column) -> Column:
        total, behind = F.col(f"{context}.total").cast("double"), F.col(f"{context}.kinds").cast("double")
        own = kept(name, discount) / total + discount * behind / total * lower
        return F.when(F.col(context).isNull(), lower).otherwise(own)

    lowest = kept("words", d1) / pairs + d1 * kinds / pairs * unknown
    return unknown if not model.pairs else mixed("trigrams", "contexts_3", d3, mixed("bigrams", "contexts_2", d2, lowest))


def _log(p: Column) -> Column:
    return F.round(F.ln(p) * F.lit(float(UNIT))).cast("bigint")


def known_trigrams(model: KneserNey) -> DataFrame:
    """The trigrams of the model (ids a, b, c) with their ``log_p``."""
    known = {name: _named(table, name) for name, table in model.by_id.items()}
    lower = known["bigrams"].join(known["contexts_2"], "b").join(known["words"], "c")
    rows = known["trigrams"].join(known["contexts_3"], ["a", "b"]).join(lower, ["b", "c"])
    return rows.select("a", "b", "c", _log(_probability(model)).alias("log_p"))


def sentence_log_probability(
    df: DataFrame,
    model: KneserNey,
    key: str = "doc_id",
    text: str = "text",
    max_sentences: int | None = None,
    table: DataFrame | None = None,
) -> DataFrame:
    """Per sentence: words, trigrams (its end included) and summed log probability.

    ``table`` are the shards of ``df`` with the ``MARKS`` in front, if already made.
    """
    table = shards(df, key, text, max_sentences, MARKS) if table is None else table
    known = numbered(table, model.spelled)
    # Stored by itself: what its joins have shuffled is gone before the trigrams of the shards are.
    there = stage(known_trigrams(model), "trigrams-known")
    wanted = entries(known, trigrams, ["a", "b", "c"]).drop("n").join(there, ["a", "b", "c"], "left")
    # Numbers are needed only where no answer was found.
    open_ = [F.when(F.col("log_p").isNull(), F.col(k)).alias(k) for k in "abc"]
    wanted = stage(wanted.select("shard", "place", *open_, "log_p"), "trigrams-answers")
    answers, rest = wanted.where("log_p IS NOT NULL").select("shard", "place", "log_p"), wanted.where("log_p IS NULL")
    if not rest.isEmpty():
        text_keys = lambda t, keys: t.withColumns({k: F.col(k).cast("string") for k in keys})
        tables = {name: text_keys(model.by_id[name], keys) for name, keys in TABLES.items()}
        rest = text_keys(rest.drop("log_p"), "abc")
        grams = stage(rest.select("a", "b", "c").distinct(), "trigrams-wanted")
        scored = probabilities(grams, model, tables).select("a", "b", "c", _log(F.col("p")).alias("log_p"))
        answers = answers.unionByName(rest.join(scored, ["a", "b", "c"]).select("shard", "place", "log_p"))

    def sums(shard: Shard, log_p: np.ndarray) -> dict[str, np.ndarray]:
        at, total = scored_in(shard), len(shard.n_word)
        # Whole numbers far below 2^53, so these sums are exact.
        return {"n_gram": np.bincount(at, minlength=total), "log_p": np.bincount(at, log_p, total)}

    answers = answers.withColumnRenamed("log_p", "found")
    return together(summed(known, answers, key, trigrams, sums, "n_gram bigint, log_p bigint"), key)


def window_perplexity(
    df: DataFrame,
    model: KneserNey,
    key: str = "doc_id",
    text: str = "text",
    radii: Iterable[int] = (0, 1, 2),
    max_sentences: int | None = None,
    table: DataFrame | None = None,
) -> DataFrame:
    """Perplexity of each window of sentences: exp of minus the mean log probability.

    Every word and every sentence end counts; windows without words give 0.
    """
    sums = sentence_log_probability(df, model, key, text, max_sentences, table)
    columns = []
    for r in radii:
        frame = W.partitionBy(key).orderBy("sentence_index").rowsBetween(-r, r)
        n, log = F.sum("n_gram").over(frame), F.sum("log_p").over(frame)
        value = F.when(n == 0, F.lit(0.0)).otherwise(F.exp(-log / (n * F.lit(float(UNIT)))))
        columns.append(value.alias(f"{window_name(r)}_perplexity"))
    return sums.select(key, "sentence_index", *columns)
