from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from quillmark.config import (
    EXPERT_COLUMNS,
    WINDOW_FEATURES,
    ExpertSettings,
    FeatureSettings,
    MetaSettings,
    Settings,
    SplitSettings,
)
from quillmark.functions.hashing import row_hash
from quillmark.operators import meta, tuning
from quillmark.operators.experts import score_out_of_fold
from quillmark.operators.windows import context_windows
from quillmark.plans.pipeline import PHASES, PipelineRun, run_pipeline
from quillmark.sources.staging import stage
from tests.corpora import letters

SETTINGS = Settings(
    expert=ExpertSettings(num_features=1 << 10, max_iter=5, reg_params=(0.01, 0.1), folds=2),
    # So few trees have to take large steps away from the share of the label.
    meta=MetaSettings(trials=2, max_depth=(2, 3), learning_rate=(0.5, 0.9), rounds=(2, 4), round_step=2, rungs=(2,)),
    feature=FeatureSettings(sample_from_train=60, chunks=4),
)


@pytest.fixture(scope="module")
def corpus(spark):
    return letters(spark, 120)


@pytest.fixture(scope="module")
def run(corpus, tmp_path_factory):
    return run_pipeline(corpus, str(tmp_path_factory.mktemp("run") / "out"), SETTINGS)


def test_run_learns_and_evaluates_on_held_out_documents(run):
    got = {r.model: r for r in run.evaluation().filter("language = 'all'").collect()}
    assert set(got) == {"s1", "s3", "s5", "meta"}
    assert got["s3"].f1 > 0.8 and got["meta"].f1 > 0.8
    rows = run.table("sentences")
    per_doc = rows.groupBy("doc_id").agg(F.count_distinct("split").alias("n"))
    assert per_doc.filter("n > 1").count() == 0
    assert run.table("test_rows").count() == rows.filter("split = 'test'").count()


def test_feature_columns(run):
    columns = meta.feature_columns(run.table("meta_rows"))
    wanted = [f"window_{w}_{n}" for w in (1, 3, 5) for n in WINDOW_FEATURES]
    assert set(columns) == {*wanted, "language_id", *EXPERT_COLUMNS}
    assert len(columns) == 46


def test_resume_skips_finished_phases(run, spark):
    assert set(PHASES) <= set(run.manifest.completed())
    before = run.table("evaluation").inputFiles()
    again = PipelineRun(spark, run.path, SETTINGS).run(None)
    assert again.table("evaluation").inputFiles() == before


def test_report(run):
    rows = run.report().collect()
    assert {r.section for r in rows} == {"summary", "validation", "fragility", "importance", "test"}
    assert sum(r.section == "importance" for r in rows) <= 20
    flips = {r.metric: r.value for r in rows if r.section == "fragility"}
    assert set(flips) == {"s1_flip_rate", "s3_flip_rate", "s5_flip_rate"}


def test_detection_of_new_texts(run, spark):
    texts = [(1, "I think education matters cuz society needs it... and yeah experts agree"), (2, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = run.detector().detect(docs).collect()
    assert {r.doc_id for r in rows} == {1, 2} and all(0 <= r.prob_ai <= 1 for r in rows)
    verdicts = run.detector().detect_documents(docs).collect()
    assert all(r.prob_ai_mean <= r.prob_ai_max for r in verdicts)


def test_training_rows_get_out_of_fold_scores(run):
    keys = ["doc_id", "sentence_index"]
    held_out = run.table("out_of_fold").withColumnRenamed("prob_ai_s1", "unseen")
    rows = run.table("meta_rows").join(held_out.select(*keys, "unseen"), keys)
    assert rows.count() > 0 and rows.filter("unseen <> prob_ai_s1").count() == 0


def test_sentence_level_split(corpus, spark, tmp_path):
    settings = Settings(split=SplitSettings(level="sentence"))
    other = PipelineRun(spark, str(tmp_path / "out"), settings)
    other._prepare(corpus)
    rows = other.table("sentences")
    assert rows.count() == other.table("unsplit").count()
    assert {r.split for r in rows.select("split").distinct().collect()} == {"train", "val", "test"}


def test_out_of_fold_scores(spark, corpus):
    rows = context_windows(corpus)
    scored = score_out_of_fold(rows, settings=SETTINGS.expert)
    assert scored.count() == rows.count()
    assert scored.filter(~F.col("prob_ai_s1").between(0, 1)).count() == 0
    folds = scored.groupBy("doc_id").agg(F.count_distinct("fold").alias("n"))
    assert folds.filter("n > 1").count() == 0


def test_draws_are_seeded_and_in_range():
    space = MetaSettings()
    draws = [tuning.propose([], space, 1, k) for k in range(30)]
    assert draws == [tuning.propose([], space, 1, k) for k in range(30)]
    assert draws[0] != tuning.propose([], space, 2, 0)
    for d in draws:
        assert 3 <= d["max_depth"] <= 10 and 0.01 <= d["learning_rate"] <= 0.3
        assert 200 <= d["rounds"] <= 1000 and d["rounds"] % 50 == 0


def test_settings_round_trip():
    assert Settings.from_dict(SETTINGS.to_dict()) == SETTINGS


def test_changed_texts_or_settings_start_over(spark, tmp_path):
    first = letters(spark, 60)
    changed = first.withColumn("text", F.concat("text", F.lit(" One more sentence stands here.")))
    keys = lambda run: sorted(map(tuple, run.table("test_rows").select("doc_id", "sentence_index", "window_1_ari").collect()))
    fresh = keys(run_pipeline(changed, str(tmp_path / "fresh"), SETTINGS))
    # A folder that holds another run, finished with other texts.
    path = str(tmp_path / "used")
    before = keys(run_pipeline(first, path, SETTINGS))
    assert before != fresh
    assert keys(run_pipeline(changed, path, SETTINGS)) == fresh


def test_repeated_keys_are_refused(spark, tmp_path):
    docs = letters(spark, 20)
    with pytest.raises(ValueError, match="unique"):
        run_pipeline(docs.unionByName(docs.limit(1)), str(tmp_path / "x"), SETTINGS)


def test_texts_are_not_joined_while_preparing(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(PipelineRun, "_write", lambda self, df, name, partition_by=(): plans.append(df) or df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        PipelineRun(spark, str(tmp_path / "p"), SETTINGS)._prepare(letters(spark, 20))
        for df in plans:
            assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registered_queries_use_the_default_settings(spark, sf, monkeypatch):
    from quillmark.config import Settings
    from quillmark.plans import pipeline, queries

    monkeypatch.setattr(pipeline, "run_pipeline", lambda corpus, path, settings: (path, settings))
    path, settings = queries._pipeline(spark, sf)
    assert settings == Settings()
    # The same input and settings go on in the same folder.
    assert queries._pipeline(spark, sf)[0] == path


def test_folds_share_the_counts_of_a_window(spark, run, monkeypatch):
    """The text of each window is worked on once, not once for every fold."""
    from quillmark.operators import experts

    made = []
    monkeypatch.setattr(experts, "stage", lambda df, name, *a, **k: (made.append(name), stage(df, name, *a, **k))[1])
    rows = run.table("sentences").where("split = 'train'")
    scored = score_out_of_fold(rows, settings=SETTINGS.expert)
    assert made.count("counts") == 3 and scored.count() == rows.count()
    inside = rows.where(F.pmod(row_hash(["doc_id"], 42, "fold"), F.lit(2)) == 0)
    outside = rows.join(inside.select("doc_id").distinct(), "doc_id", "left_anti")
    one = replace(SETTINGS.expert, reg_params=SETTINGS.expert.reg_params[:1])
    apart = experts.train_expert(outside, inside, "s3", "window_3", "label", one)
    keys = ["doc_id", "sentence_index"]
    wanted = experts.score_experts(inside, {"s3": apart.model}).select(*keys, F.col("prob_ai_s3").alias("p"))
    both = scored.join(wanted, keys)
    assert both.count() == inside.count() and both.where(F.abs(F.col("p") - F.col("prob_ai_s3")) > 1e-6).isEmpty()


def test_experts_and_folds_share_stored_counts(spark, run, monkeypatch):
    """Fits and scores of all folds read the counts that were stored; no text is worked on again."""
    from quillmark.operators import experts

    keys = ["doc_id", "sentence_index"]
    rows = run.table("sentences").where("split = 'train'")
    counts = experts.fold_counts(rows, keys, settings=SETTINGS.expert)
    wanted = score_out_of_fold(rows, settings=SETTINGS.expert).select(*keys, "fold", F.col("prob_ai_s5").alias("p"))
    monkeypatch.setattr(experts, "stage", lambda *_, **__: pytest.fail("counted again"))
    scored = score_out_of_fold(rows, settings=SETTINGS.expert, counts=counts)
    both = scored.join(wanted, [*keys, "fold"])
    assert both.count() == rows.count() == scored.count()
    assert both.where(F.abs(F.col("p") - F.col("prob_ai_s5")) > 1e-6).isEmpty()


def test_bigrams_are_counted_beside_the_experts(spark, corpus, tmp_path, monkeypatch):
    """They are noted before the features begin, and a run that goes on finds them."""

    def stopped(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(PipelineRun, "_features", stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        run_pipeline(corpus, str(tmp_path / "run"), SETTINGS)
    half = PipelineRun(spark, str(tmp_path / "run"), SETTINGS)
    assert {"experts", "numbered_bigrams"} <= set(half.manifest.completed()) and "features" not in half.manifest.completed()
    monkeypatch.setattr("quillmark.operators.lm.train_bigrams", stopped)
    assert half._bigrams().vocabulary > 0
