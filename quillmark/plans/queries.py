"""Named queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.config import (
    DropoutSettings,
    ExpertSettings,
    MetaSettings,
    SplitSettings,
)
from quillmark.functions import text as T
from quillmark.functions.features import WindowCounts, punctuation, sentence_stats
from quillmark.functions.hashing import row_hash
from quillmark.functions.language import language_id
from quillmark.operators import corpus, experts, kneser_ney, language_model, lm, meta, metrics, sampling, sentence_model
from quillmark.operators.batches import apply_batches, register_table_function, row_index
from quillmark.operators.shards import shards
from quillmark.operators.windows import (
    assemble_features,
    clean_documents,
    context_windows,
    covered,
    neighbour_rows,
    sentence_table,
    spread,
    text_features,
    window_features,
)
from quillmark.plans import incremental
from quillmark.sources.staging import checkpoint_dir, new_folder, stage
from quillmark.sources.tables import load_corpus, load_split, write_table
from quillmark.streaming.features import file_stream, stream_batches, stream_features

KEYS = ["doc_id", "sentence_index"]
# Model settings for the registered queries: the defaults, as in a real run.
EXPERT = ExpertSettings()
META = MetaSettings()
# Rows of the sampling queries.
SAMPLE = 1000
TOP = 20
CHUNKS = 16

Query = Callable[[SparkSession, str], DataFrame]


# --- inputs ---------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select("doc_id", "text")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_texts(spark, sf), "doc_id")


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    texts = _texts(spark, sf)
    return spread(corpus.attach_labels(texts, _labels(spark, sf)), "doc_id", like=texts)


def _labelled_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with their split."""
    texts = _texts(spark, sf)
    labels = sampling.split_rows(_labels(spark, sf), ["doc_id"])
    return spread(texts.join(labels, "doc_id"), "doc_id", like=texts)


def _conversations(spark: SparkSession, sf: str) -> DataFrame:
    turns = _table(spark, sf, "conversations")
    return spread(corpus.conversation_corpus(turns), "doc_id")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled sentences, cut once and stored."""
    rows = context_windows(_labelled(spark, sf), radii=(0,))
    return stage(rows.select("doc_id", "sentence_index", "label", "language"), "sentences")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled sentences with three simple scores, standing in for experts.

    Each score grows with the mean sentence length of its window; the ensemble
    is their weighted mean.
    """
    rows = window_features(_labelled(spark, sf), groups=("sentence_length",))
    scores = {
        name: F.col(f"{window}_avg_sentence_length")
        / (F.col(f"{window}_avg_sentence_length") + F.lit(16.0))
        for name, window in (("s1", "window_1"), ("s3", "window_3"), ("s5", "window_5"))
    }
    rows = rows.select(
        "doc_id",
        "sentence_index",
        "label",
        "language",
        *[v.alias(f"prob_ai_{k}") for k, v in scores.items()],
    )
    return linear_score(rows, "prob_ai").withColumn("pred", metrics.decide(F.col("prob_ai")))


def linear_score(df: DataFrame, name: str = "_p") -> DataFrame:
    total = (
        F.lit(0.25) * F.col("prob_ai_s1")
        + F.lit(0.25) * F.col("prob_ai_s3")
        + F.lit(0.5) * F.col("prob_ai_s5")
    )
    return df.withColumn(name, total)


# --- sources --------------------------------------------------------------


def q_load_corpus(spark, sf):
    df = load_corpus(spark, f"{sf}/documents.parquet", label=None)
    return df.select("doc_id", "text", F.length("text").alias("n_chars"))


def q_load_split(spark, sf):
    rows = sampling.split_rows(_labels(spark, sf), ["doc_id"])
    path = new_folder(spark, "splits")
    write_table(rows, path, ("split",))
    return load_split(spark, path).select("doc_id", "label", "split")


def q_label_domain(spark, sf):
    return corpus.label_domain(_labels(spark, sf))


# --- text -----------------------------------------------------------------


def q_strip_html(spark, sf):
    pages = spread(_table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", T.strip_html(F.col("html")).alias("text"))


def q_clean_text(spark, sf):
    return _documents(spark, sf).select("doc_id", T.clean_text(F.col("text")).alias("text"))


def q_detect_language(spark, sf):
    return clean_documents(_documents(spark, sf)).select("doc_id", "language")


def q_language_id(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "lang")
    return docs.select("doc_id", language_id(F.col("lang")).alias("language_id"))


def q_split_sentences(spark, sf):
    cleaned = clean_documents(_documents(spark, sf), language=False)
    return cleaned.select(
        "doc_id", F.posexplode(T.split_sentences(F.col("_clean"))).alias("sentence_index", "sentence")
    )


def q_context_windows(spark, sf):
    return context_windows(_documents(spark, sf), language=False)


def q_first_sentences(spark, sf):
    """The sentence cap as an operator: the limit is the feature."""
    return context_windows(_documents(spark, sf), radii=(0,), max_sentences=100, language=False)


def q_sentence_table(spark, sf):
    return sentence_table(_labelled(spark, sf))


def q_blank_documents(spark, sf):
    """Only the white space of every document, which leaves blank texts."""
    blank = _documents(spark, sf).select(
        "doc_id", F.regexp_replace("text", r"[^\t-\r ]+", "").alias("text")
    )
    return context_windows(blank)


def q_labelled_sentences(spark, sf):
    return context_windows(_labelled(spark, sf), radii=(0,), language=False).select(
        "doc_id", "sentence_index", "label", F.col("window_1").alias("sentence")
    )


# --- features -------------------------------------------------------------


def _feature_query(group: str) -> Query:
    def query(spark, sf):
        return rounded(
            window_features(_documents(spark, sf), groups=(group,), with_language_id=False)
        )

    return query


def q_punctuation(spark, sf):
    rows = neighbour_rows(
        clean_documents(_documents(spark, sf), language=False),
        0,
        lambda s: sentence_stats(s, F.lit("en"), pos=False),
    )
    values = punctuation(WindowCounts(covered(0)), extra=True)
    return rounded(
        rows.select("doc_id", "sentence_index", *[v.alias(k) for k, v in values.items()])
    )


def q_window_features(spark, sf):
    return rounded(window_features(_documents(spark, sf)))


def q_feature_table(spark, sf):
    """Every feature that needs no trained classifier, of all documents, side by side."""
    docs = _documents(spark, sf)
    table = shards(docs)
    perplexity = lm.window_perplexity(docs, lm.train_bigrams(docs, table=table), table=table)
    return assemble_features(rounded(window_features(docs)), rounded(perplexity, 4))


def q_text_features(spark, sf):
    """Features of stored window texts, as for rows picked by a sample."""
    rows = context_windows(_conversations(spark, sf))
    windows = ("window_1", "window_3", "window_5")
    return rounded(text_features(rows, windows).drop(*windows))


def q_bigram_perplexity(spark, sf):
    docs = _documents(spark, sf)
    table = shards(docs)
    return rounded(lm.window_perplexity(docs, lm.train_bigrams(docs, table=table), table=table), 4)


def q_sentence_model(spark, sf):
    """Abbreviations and sentence starters found in all documents, with their scores."""
    model = sentence_model.train(_documents(spark, sf))
    parts = (("abbreviation", model.abbreviations), ("starter", model.starters))
    a, b = (t.select(F.lit(kind).alias("kind"), "word", F.round("score", 4).alias("score")) for kind, t in parts)
    return a.unionByName(b)


def q_sentence_ends(spark, sf):
    """How many sentences every document has by the model of all documents."""
    docs = _documents(spark, sf)
    return sentence_model.sentence_counts(docs, sentence_model.train(docs))


def q_language_model(spark, sf):
    """Language of every document, learned from those outside one fold of four."""
    docs = spread(_table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    held_out = row_hash(["doc_id"], 42, "language") % 4 == 0
    found = language_model.identify(docs, language_model.train(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "language", "margin")


def q_kneser_ney(spark, sf):
    """Window perplexity of all documents under a smoothed trigram model of them."""
    docs = _documents(spark, sf)
    table = shards(docs, first=kneser_ney.MARKS)
    return rounded(kneser_ney.window_perplexity(docs, kneser_ney.train(docs, table=table), table=table), 4)


def q_assemble_features(spark, sf):
    turns = _conversations(spark, sf)
    left = window_features(turns, groups=("lexical", "sentence_length"))
    table = shards(turns)
    right = lm.window_perplexity(turns, lm.train_bigrams(turns, table=table), table=table)
    return assemble_features(rounded(left), rounded(right, 4))


def q_feature_matrix(spark, sf):
    rows = window_features(_conversations(spark, sf), groups=("lexical", "punctuation"))
    matrix = meta.feature_matrix(rows)
    return rounded(
        matrix.select(*[F.col(c).cast("double").alias(c) if t == "float" else c for c, t in matrix.dtypes])
    )


def q_apply_batches(spark, sf):
    def shout(rows):
        return rows.assign(n_upper=rows["text"].str.count("[A-Z]"))[["doc_id", "n_upper"]]

    return apply_batches(_documents(spark, sf), shout, "doc_id bigint, n_upper bigint")


def q_row_index(spark, sf):
    """Position of each line item by ship date; line items of one day by order and line."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_shipdate")
    return row_index(lines, "l_shipdate", "l_orderkey", "l_linenumber").drop("l_shipdate")


def q_batches_with_indices(spark, sf):
    """Batch function that is told where its rows stand in the order of the document ids."""

    def place(batch, index):
        return batch.assign(place=index)[["doc_id", "place"]]

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    return apply_batches(docs, place, "doc_id bigint, place bigint", with_indices=True, order=["doc_id"])


def q_table_function(spark, sf):
    """Sources of documents with the lines of their texts, by a table function in SQL."""

    def lines(text):
        for k, line in enumerate((text or "").split("\n")):
            yield k, len(line)

    register_table_function(spark, "text_lines", lines, "line int, n_chars int")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return spark.sql(
        "SELECT d.source, count(*) AS n_lines, CAST(sum(l.n_chars) AS BIGINT) AS n_chars "
        "FROM {docs} d, LATERAL text_lines(d.text) l GROUP BY d.source",
        docs=docs,
    )


def q_author_profile(spark, sf):
    """Flagship: mean features per language and label over all sentences."""
    rows = window_features(
        _labelled(spark, sf), groups=("lexical", "punctuation", "sentence_length")
    )
    return rounded(
        rows.groupBy("language", "label").agg(
            F.count("*").alias("sentences"),
            F.avg("window_5_type_token_ratio").alias("type_token_ratio"),
            F.avg("window_1_punct_density").alias("punct_density"),
            F.avg("window_1_exclamations").alias("exclamations"),
            F.avg("window_5_avg_sentence_length").alias("avg_sentence_length"),
            F.avg("window_5_sentence_length_std").alias("sentence_length_std"),
        )
    )


# --- sampling -------------------------------------------------------------


def q_stratified_split(spark, sf):
    rows = _sentences(spark, sf).select(*KEYS, "label")
    return sampling.split_rows(rows, KEYS)


def q_random_split(spark, sf):
    turns = _conversations(spark, sf).select("doc_id", "label")
    return sampling.split_rows(turns, ["doc_id"], SplitSettings(stratify=False))


def _grouped(spark, sf) -> DataFrame:
    docs = _labelled_splits(spark, sf)
    rows = context_windows(docs, radii=(0,), language=False)
    return rows.select(*KEYS, "label", "split")


def q_grouped_split(spark, sf):
    return _grouped(spark, sf)


def q_split_leakage(spark, sf):
    return sampling.split_leakage(q_stratified_split(spark, sf))


def q_stratified_sample(spark, sf):
    rows = _sentences(spark, sf).select(*KEYS, "label")
    return sampling.sample_rows(rows, KEYS, SAMPLE)


def q_meta_split(spark, sf):
    rows = _sentences(spark, sf).select(*KEYS, "label")
    return sampling.meta_split(rows, KEYS)


def q_meta_training_set(spark, sf):
    rows = stage(_grouped(spark, sf), "grouped", partition_by=("split",))
    train, val = rows.filter("split = 'train'"), rows.filter("split = 'val'")
    return sampling.meta_training_set(train, val, KEYS, SAMPLE)


def q_expert_dropout(spark, sf):
    rows = _scored(spark, sf).select(*KEYS, "label", "prob_ai_s1", "prob_ai_s3", "prob_ai_s5")
    return rounded(sampling.expert_dropout(rows, KEYS))


def q_expert_dropout_replace(spark, sf):
    rows = _scored(spark, sf).select(*KEYS, "label", "prob_ai_s1", "prob_ai_s3", "prob_ai_s5")
    return rounded(sampling.expert_dropout(rows, KEYS, DropoutSettings(mode="replace")))


# --- counts and evaluation ------------------------------------------------


def q_corpus_counts(spark, sf):
    return corpus.corpus_counts(_grouped(spark, sf))


def q_class_balance(spark, sf):
    return rounded(corpus.class_balance(_conversations(spark, sf)))


def q_threshold_preds(spark, sf):
    return rounded(_scored(spark, sf).select(*KEYS, "prob_ai", "pred"))


def q_classification_metrics(spark, sf):
    return rounded(metrics.classification_metrics(_scored(spark, sf)))


def q_roc_auc(spark, sf):
    return rounded(metrics.roc_auc(_scored(spark, sf), score="prob_ai"))


def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_scored(spark, sf))


def q_class_report(spark, sf):
    return rounded(metrics.class_report(_scored(spark, sf)))


def q_metrics_per_language(spark, sf):
    return rounded(metrics.metrics_per_language(_scored(spark, sf)))


def q_evaluate_models(spark, sf):
    models = {"s1": "prob_ai_s1", "s3": "prob_ai_s3", "s5": "prob_ai_s5", "meta": "prob_ai"}
    return rounded(metrics.evaluate_models(_scored(spark, sf), models))


def q_fragility(spark, sf):
    return rounded(metrics.flip_rates(_scored(spark, sf), linear_score))


def q_top_features(spark, sf):
    """Features by how far apart the class means lie, in units of the mean."""
    rows = window_features(
        _labelled(spark, sf), groups=("lexical", "punctuation", "sentence_length")
    )
    names = [c for c in meta.feature_columns(rows) if c != "language_id"]
    means = rows.agg(
        *[F.avg(F.when(F.col("label") == y, F.col(c))).alias(f"{c}_{y}") for c in names for y in (0, 1)]
    )
    gaps = [
        F.struct(
            F.lit(c).alias("feature"),
            F.round(F.abs(F.col(f"{c}_1") - F.col(f"{c}_0")), 6).alias("importance"),
        )
        for c in names
    ]
    return meta.top_features(means.select(F.inline(F.array(*gaps))), TOP)


# --- restart --------------------------------------------------------------


def _done(spark, sf) -> DataFrame:
    """Finished work: the rows of the labelled documents, with their chunk."""
    docs = _labelled(spark, sf).withColumn("chunk", incremental.chunk_of("doc_id", CHUNKS))
    return context_windows(docs, radii=(0,), language=False).select(*KEYS, "chunk")


def q_incremental_remaining(spark, sf):
    work = context_windows(_documents(spark, sf), radii=(0,), language=False).select(*KEYS)
    return incremental.remaining(work, _done(spark, sf), KEYS)


def q_resume_point(spark, sf):
    return incremental.resume_point(_done(spark, sf))


def q_progress_status(spark, sf):
    total = context_windows(_documents(spark, sf), radii=(0,), language=False)
    return rounded(incremental.progress(_done(spark, sf), total))


def q_concat_chunks(spark, sf):
    """Labelled documents first, then a second run that finds the rest."""
    path = new_folder(spark, "chunks")

    def rows(docs: DataFrame) -> DataFrame:
        return context_windows(docs, radii=(0,), language=False)

    first = _labelled(spark, sf).select("doc_id", "text")
    incremental.process_remaining(first, path, rows, chunks=CHUNKS)
    incremental.process_remaining(_documents(spark, sf), path, rows, chunks=CHUNKS)
    return incremental.gather_chunks(spark, path).select(*KEYS, "window_1", "chunk")


def q_gather_chunks(spark, sf):
    path = new_folder(spark, "chunks")
    incremental.process_remaining(
        _conversations(spark, sf),
        path,
        lambda docs: window_features(docs, groups=("lexical",), with_language_id=False),
        chunks=CHUNKS,
    )
    return rounded(incremental.gather_chunks(spark, path))


def q_completed_phases(spark, sf):
    """A source counts as a phase; it is complete once two fifths of its
    documents are labelled."""
    docs = _table(spark, sf, "documents").select("doc_id", "source")
    phases = (
        docs.join(_labels(spark, sf), "doc_id", "left")
        .groupBy(F.col("source").alias("phase"))
        .agg(
            F.max("doc_id").alias("at"),
            (F.count("label") * 5 >= F.count("*") * 2).alias("completed"),
        )
    )
    return incremental.completed_phases(phases)


def _document_files(spark, sf):
    """Path and schema for a stream. As a glob the path may be one file or a
    folder of files."""
    schema = _table(spark, sf, "documents").select("doc_id", "text").schema
    return f"{sf}/{{documents}}.parquet", schema


def q_stream_features(spark, sf):
    source, schema = _document_files(spark, sf)
    out, check = new_folder(spark, "stream"), new_folder(spark, "stream-check")
    cores = spark.sparkContext.defaultParallelism
    stream = file_stream(spark, source, schema, partitions=4 * cores)

    def transform(rows: DataFrame) -> DataFrame:
        return window_features(rows, groups=("lexical", "punctuation"), with_language_id=False)

    stream_features(stream, transform, out, check).awaitTermination()
    return rounded(spark.read.parquet(out))


def q_stream_batches(spark, sf):
    source, schema = _document_files(spark, sf)
    out, check = new_folder(spark, "batches"), new_folder(spark, "batches-check")
    model = lm.train_bigrams(_documents(spark, sf))
    cores = spark.sparkContext.defaultParallelism
    stream = file_stream(spark, source, schema, partitions=4 * cores)
    stream_batches(stream, lambda rows: lm.window_perplexity(rows, model), out, check).awaitTermination()
    return rounded(spark.read.parquet(out).drop("batch"), 4)


# --- models ---------------------------------------------------------------


def _model_rows(spark, sf) -> DataFrame:
    """Stored labelled sentence windows with a document-level split."""
    docs = _labelled_splits(spark, sf)
    return stage(context_windows(docs), "windows", partition_by=("split",))


def _parts(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(rows.filter(F.col("split") == s) for s in ("train", "val", "test"))


def _expert_models(rows: DataFrame):
    train, val, _ = _parts(rows)
    return experts.train_experts(train, val, settings=EXPERT)


def q_expert_metrics(spark, sf):
    rows = _model_rows(spark, sf)
    found = _expert_models(rows)
    scored = experts.score_experts(_parts(rows)[2], {n: e.model for n, e in found.items()})
    return metrics.evaluate_models(scored, {n: f"prob_ai_{n}" for n in found})


def q_expert_scores(spark, sf):
    rows = _model_rows(spark, sf)
    found = _expert_models(rows)
    scored = experts.score_experts(rows, {n: e.model for n, e in found.items()})
    return scored.select(*KEYS, "label", "split", "prob_ai_s1", "prob_ai_s3", "prob_ai_s5")


def q_expert_scores_oof(spark, sf):
    rows = _model_rows(spark, sf)
    scored = experts.score_out_of_fold(rows, settings=EXPERT)
    return scored.select(*KEYS, "label", "fold", "prob_ai_s1", "prob_ai_s3", "prob_ai_s5")


def _pipeline(spark, sf):
    """The whole run over the labelled documents, with the default settings.

    Its folder is named by a digest of input and settings, so every query of a cluster
    goes on with the same run, and only the first one waits for it.
    """
    from quillmark.config import Settings
    from quillmark.plans.pipeline import fingerprint, run_pipeline

    docs, settings = _labelled(spark, sf), Settings(expert=EXPERT, meta=META)
    path = f"{checkpoint_dir(spark)}/run-{fingerprint(docs, settings)[:32]}"
    return run_pipeline(docs, path, settings)


def _meta_rows(run) -> DataFrame:
    """Rows of the ensemble with their real expert scores: train, val and test."""
    test = run.table("test_rows")
    known = run.table("meta_rows").select(*test.columns, "split")
    return known.unionByName(test.withColumn("split", F.lit("test")))


def q_search_trials(spark, sf):
    """All trials of the model-based search."""
    return _pipeline(spark, sf).table("trials")


def q_meta_scores(spark, sf):
    run = _pipeline(spark, sf)
    return run.meta_model().score(_meta_rows(run)).select(*KEYS, "label", "split", "prob_ai")


def q_meta_metrics(spark, sf):
    run = _pipeline(spark, sf)
    return meta.meta_metrics(run.meta_model().score(run.table("test_rows")))


def q_meta_fragility(spark, sf):
    run = _pipeline(spark, sf)
    return meta.fragility(_meta_rows(run).filter("split = 'val'"), run.meta_model())


def q_feature_importance(spark, sf):
    return _pipeline(spark, sf).meta_model().importance(spark)


def q_detect(spark, sf):
    """Score every conversation turn, sentence by sentence."""
    run = _pipeline(spark, sf)
    return run.detector().detect(_conversations(spark, sf).drop("label")).select(
        *KEYS, "language", "prob_ai_s1", "prob_ai_s3", "prob_ai_s5", "prob_ai"
    )


def q_detect_documents(spark, sf):
    run = _pipeline(spark, sf)
    return run.detector().detect_documents(_conversations(spark, sf).drop("label"))


def q_report(spark, sf):
    return _pipeline(spark, sf).report()


def q_run_pipeline(spark, sf):
    return _pipeline(spark, sf).evaluation()


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): fn for name, fn in list(globals().items()) if name.startswith("q_")
}
QUERIES.update(
    readability=_feature_query("readability"),
    type_token_ratio=_feature_query("lexical"),
    sentence_length=_feature_query("sentence_length"),
    pos_shares=_feature_query("pos"),
)
