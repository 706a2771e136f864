"""Sentence ends from counts over the corpus, without a list of abbreviations.

A word is an abbreviation if its final period belongs to it: the log-likelihood ratio of
"nearly always with a period" against "as often as any word" has to be high, where short
words and words with inner periods count more, and every occurrence without a period
counts against a long word. A word is a sentence starter if it follows sentence ends far
more often than chance would have it.

A period after an abbreviation or an initial ends a sentence only in front of a
capitalised starter, one after a number only if no lower-case letter follows; every other
period, exclamation and question mark does. All evidence comes from aggregates with
map-side combine; the tables join the tokens with the commonest keys broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.skew import balanced_lookup, hot_keys
from quillmark.operators.windows import clean_documents
from quillmark.sources.staging import stage

#: Least scores of an abbreviation and of a starter, and the share of periods after an abbreviation.
ABBREVIATION, STARTER, NEARLY_ALWAYS = 0.3, 30.0, 0.99
HOT = 1000


def token_rows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, place, token, next) of cleaned texts; the last token of a text has no next."""
    cleaned = clean_documents(df.select(key, text), text, language=False)
    listed = F.filter(F.split("_clean", " "), lambda w: w != "")
    sides = F.arrays_zip(listed.alias("token"), F.slice(listed, 2, 1 << 30).alias("next"))
    rows = cleaned.select(key, F.posexplode(sides).alias("place", "x"))
    return rows.select(key, "place", "x.token", "x.next")


def base(token: Column) -> Column:
    """A token in lower case without its final period."""
    return F.regexp_replace(F.lower(token), "\\.$", "")


def _log_share(n: Column, p: Column) -> Column:
    """n * ln(p), 0 for n = 0."""
    return F.when(n == 0, F.lit(0.0)).otherwise(n * F.ln(p))


@dataclass(frozen=True)
class SentenceModel:
    """Stored tables of abbreviations (word, score) and starters (word, score)."""

    abbreviations: DataFrame
    starters: DataFrame


def word_evidence(tokens: DataFrame) -> DataFrame:
    """(word, with_period, without, score) of every word that stands before a period."""
    counts = tokens.groupBy(base(F.col("token")).alias("word")).agg(
        F.count_if(F.col("token").endswith(".")).alias("with_period"), F.count_if(~F.col("token").endswith(".")).alias("without")
    )
    counts = stage(counts, "sentence-words")
    total, periods = counts.agg(F.sum(F.col("with_period") + F.col("without")), F.sum("with_period")).first()
    share = F.lit(float(periods or 0) / max(total or 0, 1))
    a, b = F.col("with_period").cast("double"), F.col("without").cast("double")
    chance = _log_share(a, share) + _log_share(b, 1 - share)
    always = _log_share(a, F.lit(NEARLY_ALWAYS)) + _log_share(b, F.lit(1 - NEARLY_ALWAYS))
    inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    letters = (F.length("word") - inner).cast("double")
    score = -2 * (chance - always) * F.exp(-letters) * (inner + 1) * F.pow(letters, -b)
    return counts.where((F.col("with_period") > 0) & F.col("word").rlike("^\\p{L}[\\p{L}.-]*$")).withColumn("score", score)


def train(df: DataFrame, key: str = "doc_id", text: str = "text") -> SentenceModel:
    """Learn from all texts; null and blank ones add nothing."""
    tokens = stage(token_rows(df, key, text), "sentence-tokens")
    evidence = word_evidence(tokens)
    short = stage(evidence.where(F.col("score") >= ABBREVIATION).select("word", "score"), "abbreviations")
    # Sentence ends that need no model: marks after words that are no abbreviations or numbers.
    ends = tokens.where(F.col("token").rlike("[.!?]$") & ~F.col("token").rlike("^[0-9.,]+\\.$") & F.col("next").isNotNull())
    ends = ends.select(base(F.col("token")).alias("word"), base(F.col("next")).alias("next")).groupBy("word", "next").agg(F.count("*").alias("n"))
    ends = ends.join(short.select("word"), "word", "left_anti")
    after = ends.groupBy("next").agg(F.sum("n").alias("n_after"))
    words = tokens.groupBy(base(F.col("token")).alias("next")).agg(F.count("*").alias("n_word"))
    after = stage(after.join(words, "next"), "after-ends")
    n, breaks = tokens.count(), after.agg(F.sum("n_after")).first()[0]
    a, b, ab, n = F.lit(float(breaks or 1)), F.col("n_word").cast("double"), F.col("n_after").cast("double"), F.lit(float(max(n, 1)))
    p, p1, p2 = b / n, ab / a, (b - ab) / F.greatest(n - a, F.lit(1.0))
    rest = n - a - b + ab
    same = _log_share(ab, p) + _log_share(a - ab, 1 - p) + _log_share(b - ab, p) + _log_share(rest, 1 - p)
    apart = _log_share(ab, p1) + _log_share(a - ab, 1 - p1) + _log_share(b - ab, p2) + _log_share(rest, 1 - p2)
    scored = after.withColumn("score", -2 * (same - apart)).where((F.col("score") >= STARTER) & (ab / b > a / n))
    scored = scored.where(F.col("next").rlike("^\\p{L}"))
    return SentenceModel(short, stage(scored.select(F.col("next").alias("word"), "score"), "starters"))


def ends(df: DataFrame, model: SentenceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, place) of every token that ends a sentence; the last token of a text does."""
    rows = token_rows(df, key, text).where(F.col("token").rlike("[.!?]$") | F.col("next").isNull())
    rows = rows.select(key, "place", "token", "next", base(F.col("token")).alias("word"), base(F.col("next")).alias("after"))
    rows = stage(rows, "sentence-candidates")
    for column, table, found in (("word", model.abbreviations, "short"), ("after", model.starters, "starts")):
        table = table.select(F.col("word").alias(column), F.lit(True).alias(found))
        rows = balanced_lookup(rows, table, [column], found, hot_keys(rows, [column], HOT), [key, "place"])
    period = F.col("token").endswith(".")
    initial = F.col("token").rlike("^\\p{Lu}\\.$")
    held = F.col("short").isNotNull() | initial
    starter = F.col("starts").isNotNull() & F.col("next").rlike("^\\p{Lu}")
    number = F.col("token").rlike("^[0-9.,]+\\.$") & F.col("next").rlike("^\\p{Ll}")
    done = F.when(F.col("next").isNull() | ~period, True).when(held, starter).otherwise(~number)
    return rows.where(done).select(key, "place")


def sentence_counts(df: DataFrame, model: SentenceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sentences) of every document; texts without words have none."""
    found = ends(df, model, key, text).groupBy(key).agg(F.count("*").alias("sentences"))
    return df.select(key).distinct().join(found, key, "left").select(key, F.coalesce("sentences", F.lit(0)).alias("sentences"))
