"""Reading and writing corpora and result tables."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = {
    ".parquet": "parquet",
    ".json": "json",
    ".jsonl": "json",
    ".csv": "csv",
    ".orc": "orc",
    ".arrow": "arrow",
}


#: Tasks that read an Arrow folder at most; more files share tasks.
MAX_TASKS = 10_000


def format_of(path: str) -> str:
    for ending, name in FORMATS.items():
        if path.rstrip("/").endswith(ending):
            return name
    return "parquet"


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Pass the table through if it has the columns; looks at the schema only."""
    for column in columns:
        if column not in df.columns:
            raise ValueError(f"column {column!r} not found, available columns: {df.columns}")
    return df


def _arrow_stream(handle):
    """Arrow files come with or without the random-access footer."""
    import pyarrow as pa

    try:
        reader = pa.ipc.open_file(handle)
        return reader.schema, (reader.get_batch(i) for i in range(reader.num_record_batches))
    except pa.ArrowInvalid:
        handle.seek(0)
        reader = pa.ipc.open_stream(handle)
        return reader.schema, iter(reader)


def _open(path: str):
    import pyarrow.fs as fs

    filesystem, name = fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(name)


def read_arrow(spark: SparkSession, path: str) -> DataFrame:
    """Read Arrow IPC files, about one file per task, batch by batch.

    Spark lists the files without reading them. The driver only opens the
    first one, for its schema. The number of tasks is given outright, because
    adaptive execution would merge partitions that hold nothing but paths.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_schema

    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.arrow")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )
    first = files.orderBy("path").first()
    if first is None:
        raise FileNotFoundError(f"no .arrow files in {path}")
    with _open(first["path"]) as handle:
        arrow_schema, _ = _arrow_stream(handle)
    schema = from_arrow_schema(arrow_schema)
    names = schema.names

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with _open(file) as handle:
                    _, found = _arrow_stream(handle)
                    for rows in found:
                        yield rows.select(names)

    tasks = min(files.count(), MAX_TASKS)
    return files.repartitionByRange(tasks, "path").mapInArrow(load, schema)


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Read by the given format, or the one the file name ends in."""
    fmt = fmt or format_of(path)
    if fmt == "arrow":
        return read_arrow(spark, path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        # Texts may hold quotes and line breaks.
        reader = reader.options(header=True, multiLine=True, escape='"', inferSchema=schema is None)
    return reader.load(path)


def load_corpus(
    spark: SparkSession,
    path: str,
    text: str = "text",
    label: str | None = "label",
    fmt: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a corpus and check that its configured columns exist."""
    df = read_table(spark, path, fmt, schema)
    return require_columns(df, *[c for c in (text, label) if c is not None])


def load_split(spark: SparkSession, path: str, split: str = "train") -> DataFrame:
    """One split of a ``split=`` partitioned table, else its first by name.

    Partition values come from the folder names, so finding the first split
    reads no column.
    """
    df = require_columns(spark.read.parquet(path), "split")
    names = df.select("split").distinct()
    chosen = names.agg(
        F.coalesce(F.max(F.when(F.col("split") == split, F.col("split"))), F.min("split")).alias("s")
    ).first()["s"]
    return df.filter(F.col("split") == chosen)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_json(spark: SparkSession, values: dict[str, Any], path: str) -> None:
    """Store one small nested value, e.g. a report, as a single JSON record."""
    row = spark.createDataFrame([(json.dumps(values, sort_keys=True),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()["value"])


def write_report(report: DataFrame, path: str) -> None:
    """The report is a few rows, so one file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def now() -> str:
    return datetime.now(timezone.utc).isoformat()
