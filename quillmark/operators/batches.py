"""User-supplied row logic: Arrow batches, with row positions if wanted, and table functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.sources.staging import stage

#: Lower bits of a running id that count rows within their partition.
WITHIN = (1 << 33) - 1


def row_index(df: DataFrame, *order: str, name: str = "row_index") -> DataFrame:
    """Adds the position of each row in the order of the given columns, from 0.

    Rows are dealt into ranges of the order and sorted within each; a range's rows start
    where the counts of the ranges before it end, so only one count per range is added up
    in one place. Ties follow a hash of the whole row, which also lets the rows of one
    common key fall into several ranges; rows equal in every column are interchangeable.
    Nulls come first. The dealt rows are written, so a lost executor moves no position.
    """
    if not order:
        raise ValueError("name at least one column to order by")
    taken = {c.lower() for c in df.columns}
    if name.lower() in taken:
        raise ValueError(f"the table has a column {name} already")
    part, local, tie, before = (f"__{c}" for c in ("part", "local", "tie", "before"))
    keys = [F.col(c).asc_nulls_first() for c in order] + [F.col(tie).asc()]
    dealt = df.withColumn(tie, F.xxhash64(*df.columns)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(
        dealt.withColumn(part, F.spark_partition_id()).withColumn(
            local, F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN))
        ),
        "indexed",
    )
    counts = placed.groupBy(part).agg(F.count("*").alias("n"))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    # One row per range: as many as there are shuffle partitions.
    return placed.join(F.broadcast(starts), part).select(*df.columns, (F.col(before) + F.col(local)).alias(name))


def apply_batches(
    df: DataFrame,
    fn: Callable[..., pd.DataFrame],
    schema: str,
    with_indices: bool = False,
    order: Iterable[str] = (),
) -> DataFrame:
    """Run ``fn`` on batches of rows; it may return any number of rows.

    Batches are cut by ``spark.sql.execution.arrow.maxRecordsPerBatch``, so
    ``fn`` must not depend on which rows come together. Row positions do not
    exist in a distributed table: with ``with_indices`` they are those in the
    given ``order``, and ``fn`` gets them as a second argument.
    """
    if with_indices:
        df = row_index(df, *order, name="__row_index")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if with_indices:
                yield fn(batch.drop(columns="__row_index"), batch["__row_index"])
            else:
                yield fn(batch)

    return df.mapInPandas(run, schema)


def register_table_function(spark: SparkSession, name: str, fn: Callable[..., Iterable[tuple]], schema: str) -> None:
    """Makes ``fn`` a table function of SQL, for use behind LATERAL; rows travel by Arrow.

    ``fn`` gets the arguments of one row and yields any number of tuples of the schema.
    """

    class Rows:
        def eval(self, *args):
            yield from fn(*args)

    spark.udtf.register(name, F.udtf(Rows, returnType=schema, useArrow=True))
