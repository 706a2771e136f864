"""Language of a document by naive Bayes over the character trigrams of its words.

A table of labelled documents gives for each language how often each trigram of a word
(with a space on either side) occurs; half an occurrence is added to every one. A document
takes the language under which its trigrams and the share of the language are likeliest.

Words are counted per document before anything is joined. Each distinct word is scored
once against the trigram table, and its scores join the documents with the commonest words
broadcast, so no key that shuffles holds more than a small share of the rows. Log
probabilities are whole millionths, so sums are exact in any order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.skew import balanced_lookup, hot_keys
from quillmark.sources.staging import stage

UNIT = 1_000_000
ADDED = 0.5
HOT = 1000
#: Languages are columns of scores, so there must not be many.
MOST_LANGUAGES = 200
WORD = "\\p{L}+"


def trigrams(word: Column) -> Column:
    """Runs of three characters of a word between spaces, in time linear in its length."""
    letters = F.split(F.concat(F.lit(" "), word, F.lit(" ")), "")
    n = F.size(letters)
    sides = F.arrays_zip(
        F.slice(letters, 1, n - 2).alias("a"), F.slice(letters, 2, n - 2).alias("b"), F.slice(letters, 3, n - 2).alias("c")
    )
    return F.transform(sides, lambda x: F.concat(x["a"], x["b"], x["c"]))


def word_counts(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, word, n): lower-cased words of letters, counted with map-side combine."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0))
    return df.select(*keys, F.explode(words).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities in millionths: per trigram, of an unknown trigram, of each language."""

    grams: DataFrame
    languages: list[str]
    unknown: list[int]
    priors: list[int]


def _millionths(p: Column) -> Column:
    return F.round(F.ln(p) * F.lit(float(UNIT))).cast("bigint")


def train(df: DataFrame, text: str = "text", language: str = "lang") -> LanguageModel:
    """Learn from documents with a language; null texts only count for its share."""
    known = df.where(F.col(language).isNotNull()).select(F.col(language).alias("lang"), F.col(text).alias("text"))
    shares = known.groupBy("lang").agg(F.count("*").alias("docs")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if not shares or len(shares) > MOST_LANGUAGES:
        raise ValueError(f"{len(shares) or 'no'} languages; at least 1 and at most {MOST_LANGUAGES} are needed")
    languages = [r.lang for r in shares]
    found = word_counts(known, ["lang"]).select("lang", "n", F.explode(trigrams(F.col("word"))).alias("gram"))
    columns = [f"n_{k}" for k in range(len(languages))]
    grams = found.groupBy("gram").agg(
        *[F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(c) for lang, c in zip(languages, columns)]
    )
    grams = stage(grams, "language-grams")
    sums = grams.agg(F.count("*"), *[F.coalesce(F.sum(c), F.lit(0)) for c in columns]).first()
    kinds, totals = sums[0], sums[1:]
    # One more kind stands for all trigrams that were never seen.
    below = [n + ADDED * (kinds + 1.0) for n in totals]
    scores = [_millionths((F.col(c) + F.lit(ADDED)) / F.lit(b)) for c, b in zip(columns, below)]
    grams = stage(grams.select("gram", F.array(*scores).alias("scores")), "language-model")
    fixed = df.sparkSession.range(1).select(
        F.array(*[_millionths(F.lit(ADDED) / F.lit(b)) for b in below]).alias("unknown"),
        F.array(*[_millionths(F.lit(float(r.docs)) / F.lit(float(sum(x.docs for x in shares)))) for r in shares]).alias("priors"),
    ).first()
    return LanguageModel(grams, languages, list(fixed.unknown), list(fixed.priors))


def identify(df: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, language, margin): the likeliest language and how far the next one is behind.

    Ties go to the name that is less. Texts without words take the commonest language;
    with one language the margin is null. Rows that share a key count as one text.
    """
    counts = stage(word_counts(df, [key], text), "language-words")
    span = range(len(model.languages))
    words = counts.groupBy("word").agg(F.sum("n").alias("n"))
    listed = stage(words.select("word", "n", F.explode(trigrams(F.col("word"))).alias("gram")), "language-listed")
    found = balanced_lookup(listed, model.grams, ["gram"], "scores", hot_keys(listed, ["gram"], HOT), ["word", "gram"], ["word", "n"])
    unknown = F.array(*[F.lit(x) for x in model.unknown])
    found = found.withColumn("scores", F.coalesce("scores", unknown))
    scored = found.groupBy("word").agg(F.first("n").alias("n"), F.array(*[F.sum(F.col("scores")[k]) for k in span]).alias("scores"))
    scored = stage(scored, "language-scored")
    hot = scored.orderBy(F.desc("n"), "word").limit(HOT).select("word")
    placed = balanced_lookup(counts, scored.select("word", "scores"), ["word"], "scores", hot, [key, "word"], [key, "n"])
    sums = placed.groupBy(key).agg(*[F.sum(F.col("n") * F.col("scores")[k]).alias(f"s_{k}") for k in span])
    rows = df.select(key).distinct().join(sums, key, "left")
    each = F.array(
        *[
            F.struct((-(F.coalesce(f"s_{k}", F.lit(0)) + F.lit(model.priors[k]))).alias("cost"), F.lit(model.languages[k]).alias("language"))
            for k in span
        ]
    )
    ranked = F.array_sort(each)
    margin = F.try_element_at(ranked, F.lit(2))["cost"] - ranked[0]["cost"]
    return rows.select(key, ranked[0]["language"].alias("language"), margin.alias("margin"))
