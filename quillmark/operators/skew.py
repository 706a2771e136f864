"""Lookups that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 4096


def _present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def hot_keys(rows: DataFrame, keys: list[str], most: int = 1000) -> DataFrame:
    """The ``most`` commonest keys, counted with map-side combine.

    Every key holding more than ``1/most`` of the rows is among them, and the
    result never has more than ``most`` rows, so it is safe to broadcast.
    """
    counts = rows.filter(_present(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.orderBy(F.desc("_n"), *keys).limit(most).select(*keys)


def balanced_lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    value: str,
    hot: DataFrame,
    spread_by: list[str],
    keep: list[str] | None = None,
) -> DataFrame:
    """Left join ``value`` from ``table``, which has unique text keys.

    Hot keys are answered by a broadcast of at most ``hot`` rows. They and rows
    with a null key then travel under a made-up key, so that no shuffle
    partition collects them. Nothing is dropped. The made-up key replaces the
    first key column itself: a separate constant salt column would be folded
    into a filter and leave the shuffle unsalted.
    """
    keep = keep or rows.columns
    answers = hot.join(table.join(F.broadcast(hot), keys, "left_semi"), keys, "left").select(
        *keys, F.col(value).alias("_hot_value"), F.lit(True).alias("_hot")
    )
    tagged = rows.join(F.broadcast(answers), keys, "left")
    cold = F.col("_hot").isNull() & _present(keys)
    salt = F.concat(
        F.lit("\x00"), F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("string")
    )
    tagged = tagged.select(
        *keep,
        "_hot_value",
        cold.alias("_is_cold"),
        F.when(cold, F.col(keys[0])).otherwise(salt).alias("_key_0"),
        *[F.when(cold, F.col(k)).alias(f"_key_{i}") for i, k in enumerate(keys) if i],
    )
    lookup = table.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)],
        F.col(value).alias("_cold_value"),
    )
    joined = tagged.join(lookup, [f"_key_{i}" for i in range(len(keys))], "left")
    found = F.when(F.col("_is_cold"), F.col("_cold_value")).otherwise(F.col("_hot_value"))
    return joined.select(*keep, found.alias(value))
