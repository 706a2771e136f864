import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmark.operators.batches import apply_batches
from quillmark.operators.corpus import conversation_corpus
from quillmark.sources.tables import (
    load_corpus,
    load_split,
    read_arrow,
    read_json,
    read_table,
    write_json,
    write_table,
)

ROWS = [("a \"quoted\", text\nwith a break", 1), ("plain", 0), ("ümlaut", 1)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, tmp_path, fmt):
    path = str(tmp_path / f"corpus.{fmt}")
    df = spark.createDataFrame(ROWS, "text string, label int")
    writer = df.coalesce(1).write.format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    writer.save(path)
    got = load_corpus(spark, path)
    assert sorted((r.text, r.label) for r in got.collect()) == sorted(ROWS)


def test_arrow_files_are_read_by_as_many_tasks(spark, tmp_path):
    for i in range(12):
        table = pa.table({"text": [f"t{i}"], "label": [i]})
        with pa.ipc.new_file(str(tmp_path / f"d-{i:05d}.arrow"), table.schema) as writer:
            writer.write_table(table)
    rows = read_arrow(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r.label for r in rows) == list(range(12))
    assert len({r.task for r in rows}) == 12


@pytest.mark.parametrize("kind", ["file", "stream"])
def test_arrow_folder(spark, tmp_path, kind):
    folder = tmp_path / "set.arrow"
    folder.mkdir()
    table = pa.table({"text": [r[0] for r in ROWS], "label": [r[1] for r in ROWS]})
    for i in range(2):
        target = str(folder / f"data-{i:05d}.arrow")
        make = pa.ipc.new_file if kind == "file" else pa.ipc.new_stream
        with pa.OSFile(target, "wb") as sink, make(sink, table.schema) as writer:
            writer.write_table(table, max_chunksize=2)
    (folder / "state.json").write_text("{}")
    got = load_corpus(spark, str(folder))
    assert sorted((r.text, r.label) for r in got.collect()) == sorted(ROWS * 2)


def test_missing_path_and_columns(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, str(tmp_path / "absent.parquet"))
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame(ROWS, "body string, label int").write.parquet(path)
    with pytest.raises(ValueError, match="available columns"):
        load_corpus(spark, path)
    assert load_corpus(spark, path, text="body").count() == 3


def test_load_split(spark, tmp_path):
    df = spark.createDataFrame([(1, "val"), (2, "train"), (3, "test")], "doc_id int, split string")
    write_table(df, str(tmp_path / "a"), ("split",))
    assert [r.doc_id for r in load_split(spark, str(tmp_path / "a")).collect()] == [2]
    write_table(df.filter("split <> 'train'"), str(tmp_path / "b"), ("split",))
    assert [r.doc_id for r in load_split(spark, str(tmp_path / "b")).collect()] == [3]


def test_json_values(spark, tmp_path):
    value = {"a": [1, 2], "b": {"c": "x\ny"}}
    write_json(spark, value, str(tmp_path / "v"))
    assert read_json(spark, str(tmp_path / "v")) == value


def test_conversations(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(tuple(r) for r in conversation_corpus(df).collect()) == [
        ("1-1", "u", 0),
        ("1-2", "a", 1),
    ]


def test_apply_batches_may_change_the_row_count(spark):
    def twice(pdf):
        import pandas as pd

        return pd.concat([pdf, pdf])

    assert apply_batches(spark.range(10), twice, "id long").agg(F.sum("id")).first()[0] == 90
