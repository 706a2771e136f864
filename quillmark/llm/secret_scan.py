"""Secrets in texts: three patterns, and character Markov models for what they miss.

Two first-order Markov models over ASCII characters, one of random strings and one of
ordinary identifiers, score runs of letters and digits in long tokens by the mean
log-likelihood ratio of their different character pairs. Names joined from short words by
slashes, underscores and the like have no long run; one character repeated has one pair.
The random strings to learn from are the values that the patterns label; the ordinary ones
are the words and identifiers of documents without matches, those with long runs left out:
these are what is judged, and may be unlabelled secrets. Both are counted over all
documents; only pair counts, at most 128 x 128 for each model, reach the driver.

Everything is column expressions. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import SPACES, stage, texts

#: The patterns of the base kinds, in the order in which they are listed.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_VALUE = 12

#: Tokens that the models judge.
TOKEN = "[A-Za-z0-9+/_=-]{20,}"
#: The runs in them that are scored, and how many different pairs a run needs.
RUN = "[A-Za-z0-9]{16,}"
DISTINCT = 8
#: Weight of the second character's own frequency in the probability of a pair.
BACK_OFF = 2.0
#: Share of ordinary tokens that may score above the threshold while learning.
FALSE_RATE = 0.0005


def _spans(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """array<struct<start, kind, end, hit>> of the leftmost matches that do not overlap.

    The pieces between matches give the positions; they are only cut where there are any.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.expr("CAST(array() AS array<struct<start: bigint, kind: int, end: bigint, hit: string>>)")
    begin = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    zipped = F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda p, h: F.struct(p.alias("piece"), h.alias("hit")))
    found = F.aggregate(zipped, begin, step, lambda acc: acc["out"])
    return F.when(F.size(hits) > 0, found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and then kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = _spans(text, ASSIGN, 0)
    # A match whose value is short is dropped, with the text that it used up.
    kept = F.filter(assign, lambda s, i: F.length(F.get(values, i)) >= ASSIGN_VALUE)
    assign = F.when(F.size(assign) > 0, kept).otherwise(assign)
    return F.array_sort(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def _pairs(token: Column) -> Column:
    """Codes of neighbouring characters, 128 * first + second, of an ASCII token."""
    code = lambda i: F.ascii(F.substring(token, i, F.lit(1)))
    return F.transform(F.sequence(F.lit(1), F.length(token) - 1), lambda i: code(i) * 128 + code(i + 1))


def train(docs: DataFrame) -> tuple[list[float], float]:
    """(log-likelihood ratio of each character pair, threshold of the mean ratio).

    The threshold is a quantile of the ordinary words of eight characters and more, whose
    means spread wider than those of the longer runs that are judged, and at least 0, where
    both models are equally likely. Without random strings or without ordinary words nothing
    can be told apart; the threshold is then infinite and only the patterns count.
    """
    rows = texts(docs).withColumn("base", base_spans(F.col("text")))
    # The value of an assignment follows the last separator or quote.
    value = F.regexp_extract(F.col("hit"), "([A-Za-z0-9+/_.=-]{12,})$", 1)
    random = rows.select(F.explode("base.hit").alias("hit")).select(F.lit(1).alias("y"), value.alias("token"))
    rest = F.filter(
        F.split("text", SPACES, -1),
        lambda w: w.rlike("^[A-Za-z0-9+/_=-]{4,}[.,]?$") & ~w.rlike(RUN),
    )
    ordinary = rows.where(F.size("base") == 0).select(F.explode(rest).alias("token")).select(
        F.lit(0).alias("y"), F.regexp_replace("token", "[.,]$", "").alias("token")
    )
    tokens = stage(random.where("token != ''").unionByName(ordinary).groupBy("y", "token").agg(F.count("*").alias("n")), "markov")
    counts: tuple[dict, dict] = ({}, {})
    for r in tokens.select("y", "n", F.explode(_pairs(F.col("token"))).alias("p")).groupBy("y", "p").agg(F.sum("n").alias("n")).collect():
        counts[r.y][r.p] = r.n
    if not counts[0] or not counts[1]:
        return [0.0] * 128 * 128, math.inf

    def logs(found: dict) -> list[float]:
        first, second = [0.0] * 128, [0.5] * 128
        for p, n in found.items():
            first[p // 128] += n
            second[p % 128] += n
        total = sum(second)
        return [
            math.log((found.get(128 * a + b, 0) + BACK_OFF * second[b] / total) / (first[a] + BACK_OFF))
            for a in range(128)
            for b in range(128)
        ]

    ratio = [round(a - b, 5) for a, b in zip(logs(counts[1]), logs(counts[0]))]
    scored = tokens.where("y = 0 AND length(token) >= 8").select(mean_ratio(F.col("token"), ratio).alias("s"))
    high = scored.select(F.percentile_approx("s", 1 - FALSE_RATE, 100_000)).first()[0]
    return ratio, max(0.0, high if high is not None else math.inf)


def mean_ratio(token: Column, ratio: list[float]) -> Column:
    """Mean log-likelihood ratio of the token's different character pairs."""
    table = F.split(F.lit(",".join(map(str, ratio))), ",").cast("array<double>")
    sums = F.aggregate(
        F.array_distinct(_pairs(token)),
        F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n")),
        lambda a, p: F.struct((a["total"] + F.get(table, p)).alias("total"), (a["n"] + 1).alias("n")),
    )
    return F.transform(F.array(sums), lambda s: s["total"] / s["n"])[0]


def is_random(token: Column, ratio: list[float], threshold: float) -> Column:
    """Whether a run of the token scores above the threshold and has enough pairs."""
    runs = F.regexp_extract_all(token, F.lit(RUN), F.lit(0))
    many = lambda r: F.size(F.array_distinct(_pairs(r))) >= DISTINCT
    return F.exists(runs, lambda r: many(r) & (mean_ratio(r, ratio) > threshold))


def find_secrets(docs: DataFrame, model: tuple[list[float], float] | None = None) -> DataFrame:
    """Adds ``base`` and ``found``, arrays of spans, to rows with doc_id and text.

    Null and empty texts have no spans. Spans of the models are those that reach beyond
    the base span they overlap, if any. All other columns stay.
    """
    ratio, threshold = model or train(docs)
    rows = docs.withColumn("base", base_spans(F.coalesce("text", F.lit(""))))
    if math.isinf(threshold):
        return rows.withColumn("found", F.col("base"))
    tokens = _spans(F.coalesce("text", F.lit("")), TOKEN, 3)
    free = lambda t: ~F.exists("base", lambda b: (b["start"] <= t["start"]) & (t["end"] <= b["end"]))
    added = F.filter(tokens, lambda t: free(t) & is_random(t["hit"], ratio, threshold))
    return rows.withColumn("found", F.array_sort(F.concat("base", added)))


def as_text(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, model: tuple[list[float], float] | None = None, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by the mask; ``n_chars`` follows the text."""
    rows = find_secrets(docs, model)
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        # Spans of different kinds may overlap; only the first of such spans puts a mask.
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        out = F.concat(acc["out"], gap, F.when((s["start"] >= acc["at"]), F.lit(mask)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.length("text")))
    text = F.when(F.size("found") > 0, F.aggregate("found", begin, step, rest)).otherwise(F.col("text"))
    kept = [c for c in docs.columns if c not in ("text", "n_chars")]
    out = rows.select(*kept, text.alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document; null and empty texts have none, repeated rows stay."""
    docs = texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = find_secrets(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(as_text("base"), 256).alias("base_sha256"),
        as_text("found").alias("spans"),
    )
