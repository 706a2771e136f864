import re

import pytest
from pyspark.sql import functions as F

from quillmark.functions import text as T
from quillmark.functions.language import detect_language, language_id, map_language
from quillmark.operators.windows import context_windows, sentence_table

EDGES = [
    "<P class=x>hi</P>",
    "<article>k</article>",
    "a<!-- c -->b",
    "a<!-- c\nd -->b",
    "![alt](u) x [text](url) y",
    "`code` and ```fenced\ncode``` end",
    "**bold** *it* **a *b* c** 5 * 6",
    "a b c　d\u0085e\u001cf g",
    "  x  ",
    "<script>var a;</script>",
    "![broken](",
    "[[a]](b)",
]


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


def python_clean(text):
    text = re.sub(T.TAG_PATTERN.replace(T.SPACE, r"\s"), "", text, flags=re.IGNORECASE)
    for pattern, keep in (
        (T.IMAGE_PATTERN, ""),
        (T.LINK_PATTERN, r"\1"),
        (T.CODE_PATTERN, ""),
        (T.BOLD_PATTERN, r"\1"),
        (T.ITALIC_PATTERN, r"\1"),
    ):
        text = re.sub(pattern, keep, text)
    return re.sub(r"\s+", " ", text).strip()


def test_cleaning_equals_python_rules(spark, sf):
    texts = EDGES + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.c for r in rows.select("i", T.clean_text(F.col("t")).alias("c")).collect()}
    assert {i: python_clean(t) for i, t in enumerate(texts)} == got


def test_known_tags_go_and_others_stay(spark):
    assert one(spark, "<P class=x>hi</P><article>k</article>", T.strip_html) == "hi<article>k</article>"
    assert one(spark, "a<!-- c\nd -->b", T.strip_html) == "a<!-- c\nd -->b"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("One. Two! Three?", ["One.", "Two!", "Three?"]),
        ("Wait... what?! Yes", ["Wait...", "what?!", "Yes"]),
        ("Dr. Smith met Mr. Dr. Jones. Good.", ["Dr. Smith met Mr. Dr. Jones.", "Good."]),
        ('He said "no." Then left.', ['He said "no."', "Then left."]),
        ("no stop at all", ["no stop at all"]),
        ("", [""]),
        ("3.14 is pi. ok", ["3.14 is pi.", "ok"]),
        ("Are you sure? No. I disagree.", ["Are you sure?", "No.", "I disagree."]),
        ("No. Quiero ir.", ["No.", "Quiero ir."]),
        ("See No. 5 and Fig. 12 now. Yes.", ["See No. 5 and Fig. 12 now.", "Yes."]),
        ("Es war ca. 30 Jahre. Nr. 7 fehlt.", ["Es war ca. 30 Jahre.", "Nr. 7 fehlt."]),
    ],
)
def test_sentences(spark, text, expected):
    assert one(spark, text, T.split_sentences) == expected


def test_joined_windows_split_into_the_same_sentences(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = context_windows(docs, language=False).select(
        F.size(T.split_sentences(F.col("window_5"))).alias("n"),
        F.size(
            F.flatten(
                F.transform(T.split_sentences(F.col("window_5")), lambda s: T.split_sentences(s))
            )
        ).alias("again"),
        "sentence_index",
        F.count("*").over(__import__("pyspark").sql.Window.partitionBy("doc_id")).alias("total"),
    )
    expected = F.least(F.col("sentence_index"), F.lit(2)) + F.least(
        F.col("total") - 1 - F.col("sentence_index"), F.lit(2)
    ) + 1
    assert rows.filter((F.col("n") != expected) | (F.col("again") != F.col("n"))).count() == 0


def test_windows_are_centred_and_clipped(spark):
    df = spark.createDataFrame([(1, "A a. B b. C c. D d.")], "doc_id int, text string")
    rows = context_windows(df, radii=(0, 1, 3), language=False).orderBy("sentence_index").collect()
    assert [r.window_1 for r in rows] == ["A a.", "B b.", "C c.", "D d."]
    assert [r.window_3 for r in rows] == ["A a. B b.", "A a. B b. C c.", "B b. C c. D d.", "C c. D d."]
    assert all(r.window_7 == "A a. B b. C c. D d." for r in rows)


@pytest.mark.parametrize("text", [None, "", "   ", "`x`", "<!-- c -->", "  "])
def test_blank_documents_give_one_empty_row(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    rows = context_windows(df).collect()
    assert [(r.window_1, r.window_3, r.window_5, r.language, r.sentence_index) for r in rows] == [
        ("", "", "", "en", 0)
    ]


@pytest.mark.parametrize("n, cap, kept", [(101, 100, 100), (100, 100, 100), (101, None, 101), (1, 100, 1)])
def test_sentence_cap(spark, n, cap, kept):
    df = spark.createDataFrame([(1, "Word here. " * n)], "doc_id int, text string")
    assert context_windows(df, max_sentences=cap).count() == kept


def test_sentence_table_shape(spark):
    df = spark.createDataFrame([(7, "One. Two.", 1)], "doc_id long, text string, label int")
    table = sentence_table(df)
    assert table.columns == [
        "window_1", "window_3", "window_5", "language", "label", "doc_id", "sentence_index",
    ]
    assert {r.doc_id for r in table.collect()} == {"doc_7"}


@pytest.mark.parametrize(
    "text, code",
    [
        ("the cat and the dog were in the house", "en"),
        ("der Hund und die Katze sind nicht in dem Haus", "de"),
        ("le chat est dans la maison avec les chiens", "fr"),
        ("el perro y los gatos están por la casa del pueblo", "es"),
        ("o cão não está em uma casa mas ele também tem", "pt"),
        ("zzz qqq xxx", "en"),
        ("", "en"),
    ],
)
def test_language(spark, text, code):
    assert one(spark, text, detect_language) == code


def test_language_accuracy_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    right = docs.select((detect_language(T.clean_text(F.col("text"))) == F.col("lang")).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.95


def test_language_mapping_and_ids(spark):
    codes = ["ca", "it", "nl", "de", "xx", None]
    rows = spark.createDataFrame([(c,) for c in codes], "c string")
    assert [r[0] for r in rows.select(map_language(F.col("c"))).collect()] == [
        "es", "en", "en", "de", "en", "en",
    ]
    ids = spark.createDataFrame([(c,) for c in ("en", "de", "fr", "es", "pt", "xx")], "c string")
    assert [r[0] for r in ids.select(language_id(F.col("c"))).collect()] == [0, 1, 2, 3, 4, -1]
