"""Document fingerprints: SimHash of 128 bits, and a search within a Hamming radius.

Terms are pairs of neighbouring words (a single word if there is only one), each with its
length as weight, since short words are common ones. Every term votes with its weight on
each bit of its two 64-bit hashes. Two votes share one long (32 bits each), so 64 sums
count all votes in whole-stage code. A bit is set if more than half the weight voted for it.

The search keeps permuted tables: fingerprints are cut into blocks, and two within radius
r agree in all but r blocks at least, so some table whose key joins the remaining blocks
holds both. All of it is column expressions; nothing is ever collected but the bucket
bounds, at most ``MAX_BUCKETS`` numbers.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.llm.common import SPACES, stage

MAX_BUCKETS = 4096
#: Longest weight of a term; keeps a document's sums below 2^32 up to 100 million terms.
MAX_WEIGHT = 40
LOW = 0xFFFFFFFF
PAIR = 0x100000001
RADIUS = 3


def _votes() -> list[Column]:
    """Aggregates over the columns term and weight: 2 x 32 packed sums and the total."""
    hashes = (F.xxhash64("term"), F.xxhash64(F.lit(1), "term"))
    sums = [
        F.sum(F.shiftrightunsigned(h, s).bitwiseAND(F.lit(PAIR)) * F.col("weight")).alias(f"v{k}_{s}")
        for k, h in enumerate(hashes)
        for s in range(32)
    ]
    return [*sums, F.sum("weight").alias("total")]


def _word(k: int) -> Column:
    """The k-th 64 bits of the fingerprint from the packed sums."""
    sums = f"array({', '.join(f'v{k}_{s}' for s in range(32))})"
    low = f"transform({sums}, (v, i) -> if(2 * (v & {LOW}L) > total, shiftleft(1L, i), 0L))"
    high = f"transform({sums}, (v, i) -> if(2 * shiftrightunsigned(v, 32) > total, shiftleft(1L, i + 32), 0L))"
    return F.expr(f"aggregate(concat({low}, {high}), 0L, (a, b) -> a | b)")


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key with ``f0`` and ``f1``, the two halves of its fingerprint.

    The keys must tell rows apart. Texts without words get the fingerprint zero. If the
    rows are already placed by one of the keys, nothing is shuffled.
    """
    words = F.split(F.lower(F.col(text)), SPACES, -1)
    exploded = rows.select(*keys, words.alias("w")).select(
        *keys,
        F.explode(
            F.expr("transform(w, (x, i) -> if(size(w) = 1, x, concat_ws(' ', x, get(w, i + 1))))")
        ).alias("term"),
    )
    weighed = exploded.withColumn("weight", F.least(F.length("term"), F.lit(MAX_WEIGHT)).cast("long"))
    return weighed.groupBy(*keys).agg(*_votes()).select(*keys, _word(0).alias("f0"), _word(1).alias("f1"))


def as_text(f0: str, f1: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f0), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def distance(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))


def likeness(a0: str, a1: str, b0: str, b1: str) -> Column:
    return 1 - distance(F.col(a0), F.col(a1), F.col(b0), F.col(b1)) / 128.0


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most the key, by a search in two steps of about the root."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]).cast("long") for g in groups])
    before = F.size(F.filter(heads, lambda b: b <= key))
    inner = F.array(*[F.array(*[F.lit(b).cast("long") for b in g]) for g in groups])
    own = F.size(F.filter(F.get(inner, before - 1), lambda b: b <= key))
    return F.when(before == 0, 0).otherwise((before - 1) * step + own)


def with_next(docs: DataFrame) -> DataFrame:
    """Documents in buckets of the id with ``rank`` from the largest id down and ``next_text``.

    After the last document comes the first. Buckets are quantiles of the id, so each
    holds about the same number of rows; a copy of the next bucket's first document stands
    at the end of each (``ghost``), so one shuffle of the texts is all. Rows of one id are
    ordered by their text; a null id is last. Null texts are empty.
    """
    spark = docs.sparkSession
    n = min(MAX_BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    ids = docs.select("doc_id", key.alias("key"))
    cuts = ids.select(F.percentile_approx("key", [k / n for k in range(1, n)], 20 * n)).first()[0]
    bounds = sorted(set(cuts or []))
    first = ids.groupBy(bucket_of(F.col("key"), bounds).alias("bucket")).agg(F.max("key").alias("key")).collect()
    first = sorted(((r.bucket, r.key) for r in first), reverse=True)
    ghosts = [(later[1], own[0]) for own, later in zip(first, first[1:] + first[:1])]
    ghosts = F.broadcast(spark.createDataFrame(ghosts, "key bigint, ghost_bucket int"))
    placed = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
        .join(ghosts, "key", "left")
        .withColumn("own", bucket_of(F.col("key"), bounds))
        .select(
            "doc_id",
            "text",
            "key",
            F.explode(
                F.expr(
                    "if(ghost_bucket IS NULL, array(struct(own AS bucket, false AS ghost)), "
                    "array(struct(own AS bucket, false AS ghost), struct(ghost_bucket AS bucket, true AS ghost)))"
                )
            ).alias("at"),
        )
        .select("doc_id", "text", "key", "at.bucket", "at.ghost")
    )
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc("key"), "text")
    return placed.select(
        "bucket",
        "ghost",
        "doc_id",
        "text",
        F.row_number().over(order).alias("rank"),
        F.lead("text").over(order).alias("next_text"),
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and of the next document's text.

    The edited text keeps the first half (the longer one) and takes the start of the next
    document for the rest. An empty table stays empty; repeated rows are rows of their own.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["bucket", "rank", "ghost", "doc_id", "n_chars", "edited_sha256"]
    both = rows.select(
        *keys,
        F.explode(
            F.expr("array(struct(0 AS kind, text AS t), struct(1 AS kind, if(ghost, '', edited) AS t))")
        ).alias("x"),
    ).select(*keys, "x.kind", "x.t")
    prints = fingerprints(both, [*keys, "kind"], "t")
    pick = lambda c, k: F.max(F.when(F.col("kind") == k, F.col(c)))
    wide = prints.groupBy(*keys).agg(
        pick("f0", 0).alias("f0"), pick("f1", 0).alias("f1"), pick("f0", 1).alias("e0"), pick("f1", 1).alias("e1")
    )
    order = Window.partitionBy("bucket").orderBy("rank")
    return wide.select(
        "*", F.lead("f0").over(order).alias("n0"), F.lead("f1").over(order).alias("n1")
    ).where("NOT ghost").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("f0", "f1").alias("fingerprint"),
        as_text("e0", "e1").alias("edited_fingerprint"),
        likeness("f0", "f1", "e0", "e1").alias("near_edited"),
        likeness("f0", "f1", "n0", "n1").alias("near_next"),
        "f0",
        "f1",
    )


def blocks(f0: str, f1: str, n: int) -> list[Column]:
    """The 128 bits in n pieces of nearly equal width, as text."""
    bits = F.concat(F.lpad(F.bin(f0), 64, "0"), F.lpad(F.bin(f1), 64, "0"))
    ends = [128 * k // n for k in range(n + 1)]
    return [F.substring(bits, a + 1, b - a) for a, b in zip(ends, ends[1:])]


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, n_blocks: int | None = None) -> DataFrame:
    """(q0, q1, f0, f1, n) of all pairs of different query and stored fingerprints within the radius.

    Both sides are folded to distinct fingerprints first; ``n`` counts the stored rows.
    With ``n_blocks`` = radius + 1 there is one table per block; more blocks give more
    tables with longer keys. Complete for every radius below ``n_blocks``.
    """
    n_blocks = n_blocks or radius + 1
    chosen = list(combinations(range(n_blocks), n_blocks - radius))

    def tables(df: DataFrame, a: str, b: str) -> DataFrame:
        cut = blocks(a, b, n_blocks)
        keys = [F.xxhash64(F.lit(t), *[cut[k] for k in c]) for t, c in enumerate(chosen)]
        return df.withColumn("key", F.explode(F.array(*keys)))

    stored = prints.groupBy("f0", "f1").agg(F.count("*").alias("n"))
    asked = queries.select(F.col("f0").alias("q0"), F.col("f1").alias("q1")).distinct()
    near = distance(F.col("q0"), F.col("q1"), F.col("f0"), F.col("f1"))
    return (
        tables(stored, "f0", "f1")
        .join(tables(asked, "q0", "q1"), "key")
        .where(near <= radius)
        .select("q0", "q1", "f0", "f1", "n")
        .dropDuplicates(["q0", "q1", "f0", "f1"])
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest rows, and for ids divisible by 100 the other documents within the radius."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = stage(edited_fingerprints(docs), "fingerprints")
    asked = found.where("doc_id % 100 = 0")
    counts = within(asked, found).groupBy("q0", "q1").agg(F.sum("n").alias("n"))
    counted = asked.join(counts, (F.col("f0") == F.col("q0")) & (F.col("f1") == F.col("q1")), "left")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rest = found.where("doc_id % 100 != 0 OR doc_id IS NULL")
    return rest.select(*columns, F.lit(None).cast("long").alias("n_near")).unionByName(
        counted.select(*columns, (F.col("n") - 1).alias("n_near"))
    )
