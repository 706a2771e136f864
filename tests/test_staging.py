import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillmark.sources import staging


def shuffled(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for d in dirs for p in Path(d.getPath()).rglob("shuffle_*")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffled(spark)
    df = spark.range(10_000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()
    rows = staging.stage(df, "counts")
    for _ in range(50):  # files are removed in the background
        left = shuffled(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert sorted((r.k, r["count"]) for r in rows.collect()) == sorted((k, len(range(k, 10_000, 7))) for k in range(7))


@pytest.mark.parametrize("own", [None, "false", "true"])
def test_the_setting_of_the_session_comes_back(spark, own):
    spark.conf.unset(staging.CLEANUP)
    plain = spark.conf.get(staging.CLEANUP, None)
    if own is not None:
        spark.conf.set(staging.CLEANUP, own)
    with staging.shuffles_removed(spark), staging.shuffles_removed(spark):
        assert spark.conf.get(staging.CLEANUP) == "true"
    assert spark.conf.get(staging.CLEANUP, None) == (plain if own is None else own)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        with staging.shuffles_removed(spark):
            spark.read.parquet("/tmp/no-such-table")
    assert spark.conf.get(staging.CLEANUP, None) == (plain if own is None else own)
    spark.conf.unset(staging.CLEANUP)
