import re
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark.functions.lexicons import AUXILIARIES, PRONOUNS, by_language
from quillmark.operators.windows import context_windows, text_features, window_features


def expected(window):
    sentences = re.sub(r"([.!?]+) ", r"\1\n", window).split("\n")
    words = window.lower().split()
    lengths = [len(s.split()) for s in sentences]
    vowels = re.compile("[aeiouy]+")
    stops = sum(window.count(c) for c in ".!?")
    lexical = [w for w in words if re.search(r"[^\W_]", w)]
    poly = sum(len(vowels.findall(w)) >= 3 for w in words)
    out = {
        "type_token_ratio": len(set(words)) / len(words) if words else 0.0,
        "punct_density": 1.0 if stops else 0.0,
        "exclamations": window.count("!"),
        "ellipsis": window.count("..."),
        "avg_sentence_length": statistics.mean(lengths),
        "sentence_length_std": statistics.stdev(lengths) if len(lengths) > 1 else 0.0,
        "ari": 0.0,
        "smog_index": 0.0,
    }
    if lexical:
        chars = len(window.replace(" ", ""))
        out["ari"] = 4.71 * chars / len(lexical) + 0.5 * len(lexical) / len(sentences) - 21.43
        if len(sentences) >= 3:
            out["smog_index"] = 1.043 * (30 * poly / len(sentences)) ** 0.5 + 3.1291
    return out


word = st.sampled_from(["the", "Banana", "is", "animation", "x", "$$$", "--", "he", "Energy", "a.b", "!"])
ends = st.sampled_from([".", "!", "?", "...", "....", "!!!", "?!", ""])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.lists(word, min_size=1, max_size=8), ends), max_size=7), min_size=5, max_size=20))
def test_window_features_equal_plain_python(spark, documents):
    texts = [" ".join(" ".join(ws) + end for ws, end in doc) for doc in documents]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = window_features(df, windows=True).collect()
    assert {r.doc_id for r in rows} == set(range(len(texts)))
    for row in rows:
        for w in ("window_1", "window_3", "window_5"):
            for name, value in expected(row[w]).items():
                assert abs(row[f"{w}_{name}"] - value) < 1e-9, (row[w], name)


def test_text_features_equal_window_features(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60)
    left = window_features(docs)
    right = text_features(context_windows(docs)).select(left.columns)

    def rows(df):
        values = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
        return sorted(tuple(r) for r in df.select(*values).collect())

    assert rows(left) == rows(right)


def test_feature_names_and_count(spark):
    df = spark.createDataFrame([(1, "Hello there. I am here!")], "doc_id int, text string")
    columns = window_features(df).columns
    features = [c for c in columns if c not in ("doc_id", "language", "sentence_index")]
    # 13 per window without perplexity, and the language id.
    assert len(features) == 3 * 13 + 1


def test_tags(spark):
    df = spark.createDataFrame([(1, "She is with Anna, and they were $$ happy!")], "doc_id int, text string")
    row = window_features(df, groups=("pos",)).first()
    # she is with Anna , and they were $$ happy !
    assert row.window_1_pos_PRON == 2 / 11
    assert row.window_1_pos_AUX == 2 / 11
    assert row.window_1_pos_PROPN == 1 / 11
    assert row.window_1_pos_PUNCT == 2 / 11
    assert row.window_1_pos_X == 1 / 11


def test_every_language_has_both_lexicons():
    assert set(by_language(AUXILIARIES)) == set(by_language(PRONOUNS)) == {"en", "de", "fr", "es", "pt"}


def test_blank_text_has_zero_features(spark):
    df = spark.createDataFrame([(1, None)], "doc_id int, text string")
    row = window_features(df).first().asDict()
    assert all(v == 0 for k, v in row.items() if k.startswith("window_"))


def test_no_shuffle_and_pruned_scan(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = spark.range(0, 100, 1, 40).select(
        F.col("id").alias("doc_id"), F.lit("One. Two.").alias("text"), F.lit("x").alias("other")
    )
    rows.write.parquet(path)
    plan = window_features(spark.read.parquet(path).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "other" not in plan and "Python" not in plan


def test_a_sentence_is_measured_for_the_wanted_groups_alone(spark):
    """Patterns that no group reads do not run, and none runs twice on a sentence."""
    from quillmark.functions.features import POLYSYLLABLE, SYMBOL_RUN
    from quillmark.operators.windows import window_features

    docs = spark.createDataFrame([(1, "One two. Three, four & five! Six...")], "doc_id int, text string")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 24))
    assert POLYSYLLABLE not in plan(window_features(docs, groups=("sentence_length",)))
    whole = plan(window_features(docs))
    assert POLYSYLLABLE in whole and whole.count(SYMBOL_RUN) == 1
    every = window_features(docs).collect()
    some = window_features(docs, groups=("sentence_length",)).collect()
    assert [r.window_5_avg_sentence_length for r in some] == [r.window_5_avg_sentence_length for r in every]
