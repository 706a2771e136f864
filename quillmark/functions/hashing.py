"""Seeded hashes that do not depend on partitioning, engine or run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def row_hash(keys: list[str], seed: int, salt: str) -> Column:
    """Unsigned 32-bit hash of the key columns."""
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(seed)), F.lit(salt)]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def uniform(keys: list[str], seed: int, salt: str) -> Column:
    """Hash scaled to [0, 1)."""
    return row_hash(keys, seed, salt) / F.lit(float(HASH_RANGE))
