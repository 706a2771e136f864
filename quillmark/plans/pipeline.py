"""The whole run: prepare, experts, features, meta-classifier, evaluation.

Every phase writes tables below one folder and notes itself in a manifest, so
a stopped run resumes after its last finished phase and no phase recomputes
what an earlier one wrote.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.config import EXPERT_COLUMNS, EXPERTS, Settings
from quillmark.operators import boosting, corpus, experts, lm, meta, metrics, sampling, tuning
from quillmark.operators.windows import (
    assemble_features,
    sentence_table,
    spread,
    window_features,
)
from quillmark.plans.incremental import Manifest, chunk_of, process_remaining
from quillmark.sources.staging import stage
from quillmark.sources.tables import now, read_json, write_json, write_report

KEYS = ["doc_id", "sentence_index"]
PHASES = ("prepare", "experts", "features", "meta", "evaluate")
VERSION = "1.0.0"
#: Documents up to which all chunks are written at once.
SMALL = 50_000


class Detector:
    """Trained models, ready to score new documents."""

    def __init__(
        self,
        settings: Settings,
        models: dict[str, PipelineModel],
        meta_model: meta.MetaModel,
        bigrams: lm.BigramModel | None,
    ):
        self.settings, self.models = settings, models
        self.meta_model, self.bigrams = meta_model, bigrams

    def features(self, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Window texts and every enabled feature of each sentence."""
        wanted, cut = self.settings.feature, self.settings.window.max_sentences
        rows = window_features(
            documents,
            text,
            self.settings.window.radii,
            cut,
            windows=True,
            **({} if wanted.stylometric else {"groups": ()}),
        )
        if wanted.predictions:
            rows = experts.score_experts(rows, self.models)
        if self.bigrams is not None:
            perplexity = lm.window_perplexity(
                documents.select(key, text), self.bigrams, key, text, self.settings.window.radii, cut
            )
            rows = assemble_features(rows, perplexity, (key, "sentence_index"))
        return rows

    def detect(self, documents: DataFrame) -> DataFrame:
        """Probability of class 1 for every sentence, as ``prob_ai``."""
        return self.meta_model.score(self.features(documents))

    def detect_documents(self, documents: DataFrame, key: str = "doc_id") -> DataFrame:
        """Mean and highest sentence probability of each document."""
        return (
            self.detect(documents)
            .groupBy(key)
            .agg(
                F.count("*").alias("sentences"),
                F.avg("prob_ai").alias("prob_ai_mean"),
                F.max("prob_ai").alias("prob_ai_max"),
            )
            .withColumn("pred", metrics.decide(F.col("prob_ai_mean")))
        )


def fingerprint(documents: DataFrame, settings: Settings) -> str:
    """A digest of the settings and of the input's rows, whatever their order."""
    s = settings
    rows = documents.select(s.key, s.text, s.label)
    row = rows.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("h")
    ).first()
    content = f"{row.n}|{row.h}|{rows.schema.simpleString()}|{sorted(s.to_dict().items())}"
    return hashlib.sha256(content.encode()).hexdigest()


class PipelineRun:
    def __init__(self, spark: SparkSession, path: str, settings: Settings):
        self.spark, self.path, self.settings = spark, path.rstrip("/"), settings
        self.resume = True
        self.manifest = Manifest(spark, f"{self.path}/manifest")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def _write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        return stage(df, name, f"{self.path}/{name}", partition_by)

    def run(self, documents: DataFrame | None, resume: bool = True) -> "PipelineRun":
        """Run every phase that is not complete.

        Phases count for the same settings and input alone; without ``resume``, or when
        either has changed, everything below the folder is made anew.
        """
        if documents is not None:
            self.manifest.fingerprint = fingerprint(documents, self.settings)
            if not resume:
                self.manifest.clear()
        done = self.manifest.completed()
        self.resume = bool(done)
        for phase in PHASES:
            if phase in done:
                continue
            getattr(self, f"_{phase}")(documents)
            self.manifest.mark(phase)
        return self

    # --- phases -----------------------------------------------------------

    def _prepare(self, documents: DataFrame) -> None:
        """Keyed documents with their split, and the sentence table."""
        s = self.settings
        docs = documents.select(
            F.col(s.key).alias("doc_id"), F.col(s.text).alias("text"), F.col(s.label).alias("label")
        )
        corpus.check_labels(docs)
        corpus.check_unique(docs, "doc_id")
        by_document = s.split.level == "doc"
        if by_document:
            # Thresholds on hashes of the key: the texts stay where they are.
            docs = sampling.split_rows(docs, ["doc_id"], s.split)
        docs = self._write(docs, "documents")
        rows = sentence_table(
            spread(docs, "doc_id"),
            radii=s.window.radii,
            max_sentences=s.window.max_sentences,
            carry=("split",) if by_document else (),
        )
        # The stored table names documents "doc_<key>"; joins use the key.
        rows = rows.withColumn("doc_id", F.expr("substring(doc_id, 5)"))
        if by_document:
            self._write(rows, "sentences", ("split",))
            return
        rows = self._write(rows, "unsplit")
        self._write(sampling.split_rows(rows, KEYS, s.split), "sentences", ("split",))

    def _part(self, table: DataFrame, split: str) -> DataFrame:
        return table.filter(F.col("split") == split)

    def _experts(self, documents: DataFrame) -> None:
        """One classifier per window; saved ones are kept."""
        rows = self.table("sentences")
        train, val = self._part(rows, "train"), self._part(rows, "val")
        done = self.manifest.completed()
        settings, seed = self.settings.expert, self.settings.seed
        unseen = self.settings.feature.expert_scores == "out_of_fold"
        # Grams are counted once for the experts and for those that score the training rows.
        counts = experts.fold_counts(train, KEYS, settings=settings, seed=seed) if unseen else None

        def fit(name: str) -> experts.Expert:
            counted = experts.window_counts(counts, name).drop("fold") if unseen else None
            return experts.train_expert(train, val, name, EXPERTS[name], "label", settings, counted)

        # Bigrams need no expert: counting them fills cores that the steps of the fits leave idle.
        with ThreadPoolExecutor(1) as beside, ThreadPoolExecutor(experts.SIDE_BY_SIDE) as pool:
            bigrams = None if self._bigrams_counted() else beside.submit(self._count_bigrams)
            fits = {name: pool.submit(fit, name) for name in EXPERTS if f"expert_{name}" not in done}
            # Noted one after the other: appends to the manifest share a folder.
            for name, found in fits.items():
                found = found.result()
                experts.save_experts({name: found}, f"{self.path}/experts")
                write_json(self.spark, found.metrics, f"{self.path}/expert_metrics/{name}")
                self.manifest.mark(f"expert_{name}")
            if unseen:
                scored = experts.score_out_of_fold(train, settings=settings, seed=seed, counts=counts)
                self._write(scored.select(*KEYS, *EXPERT_COLUMNS), "out_of_fold")
            if bigrams is not None:
                bigrams.result()
                self.manifest.mark("numbered_bigrams")

    def _bigrams_counted(self) -> bool:
        """Whether there is nothing left to count for perplexity."""
        return not self.settings.feature.perplexity or "numbered_bigrams" in self.manifest.completed()

    def _count_bigrams(self) -> lm.BigramModel:
        s, path = self.settings, f"{self.path}/numbered_bigrams"
        docs = self.table("documents")
        if "split" in docs.columns:
            docs = self._part(docs, "train")
        return lm.train_bigrams(docs, k=s.feature.lm_smoothing, path=path, max_sentences=s.window.max_sentences)

    def _bigrams(self) -> lm.BigramModel | None:
        if not self.settings.feature.perplexity:
            return None
        if self._bigrams_counted():
            return lm.BigramModel.load(self.spark, f"{self.path}/numbered_bigrams")
        model = self._count_bigrams()
        self.manifest.mark("numbered_bigrams")
        return model

    def _features(self, documents: DataFrame) -> None:
        """Features of the sampled training rows, the validation and test rows.

        Whole documents are measured, because a window needs its neighbours;
        documents without a wanted row are dropped before any text work.
        """
        s = self.settings
        rows = self.table("sentences").select(*KEYS, "label", "split")
        chosen = sampling.meta_training_set(
            self._part(rows, "train"),
            self._part(rows, "val"),
            KEYS,
            s.feature.sample_from_train,
            s.seed,
            s.feature.use_val,
            "label" if s.split.stratify and s.feature.stratified_sampling else None,
        )
        chosen = chosen.withColumn("part", F.lit("train")).unionByName(
            self._part(rows, "test").withColumn("part", F.lit("test"))
        )
        chosen = self._write(chosen.select(*KEYS, "part"), "chosen")
        docs = self.table("documents").select(
            F.col("doc_id").cast("string").alias("doc_id"), "text", "label"
        )
        scan = docs
        docs = docs.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
        docs = spread(docs, "doc_id", like=scan)
        maker = Detector(s, experts.load_experts(f"{self.path}/experts"), None, self._bigrams())

        def extract(work: DataFrame) -> DataFrame:
            found = maker.features(work).drop("window_1", "window_3", "window_5")
            return found.withColumn("chunk", chunk_of("doc_id", s.feature.chunks))

        # Chunks make the run restartable; the key anti-join heals any gap.
        # A small corpus is one commit: its chunks take less time than noting them.
        small = self.table("documents").count() <= SMALL
        done = process_remaining(
            docs, f"{self.path}/chunks", extract, chunks=s.feature.chunks, resume=self.resume,
            per_commit=s.feature.chunks if small else 16,
        )
        # Every chosen row must have been measured; none may get lost unseen.
        missing = chosen.join(done.select(*KEYS), KEYS, "left_anti").count()
        if missing:
            raise RuntimeError(f"{missing} chosen rows have no features in {self.path}/chunks")
        features = done.join(chosen, KEYS)
        if s.feature.predictions and s.feature.expert_scores == "out_of_fold":
            unseen = self.table("out_of_fold")
            unseen = unseen.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in EXPERT_COLUMNS])
            features = features.join(unseen, KEYS, "left").select(
                *[
                    F.coalesce(f"_{c}", c).alias(c) if c in EXPERT_COLUMNS else F.col(c)
                    for c in features.columns
                ]
            )
        train = features.filter("part = 'train'").drop("part")
        self._write(
            sampling.meta_split(train, KEYS, s.meta.validation, s.seed), "meta_rows", ("split",)
        )
        self._write(features.filter("part = 'test'").drop("part"), "test_rows")

    def _meta(self, documents: DataFrame) -> None:
        s = self.settings
        rows = self.table("meta_rows")
        columns = meta.feature_columns(rows)
        train, val = self._part(rows, "train"), self._part(rows, "val")
        if s.dropout.enabled:
            train = self._write(sampling.expert_dropout(train, KEYS, s.dropout), "augmented")
        # Binned once, for all trials and the final fit.
        rows = boosting.prepare(train, val, columns, max_bins=s.meta.max_bins)
        trials = tuning.search(train, val, columns, s.meta, seed=s.seed, prepared=rows)
        self._write(meta.trials_table(self.spark, trials), "trials")
        model = meta.fit_meta(
            train, val, columns, meta.best_params(trials),
            patience=s.meta.patience if s.meta.early_stopping else None,
            seed=s.seed, max_bins=s.meta.max_bins, prepared=rows,
        )
        found = meta.meta_metrics(model.score(val)).first().asDict()
        flips = meta.fragility(val, model, s.dropout.neutral).first().asDict()
        model.save(f"{self.path}/meta", {**found, "fragility": flips}, s.meta.saved_top_n)

    def _evaluate(self, documents: DataFrame) -> None:
        scored = self.meta_model().score(self.table("test_rows"))
        models = {n: f"prob_ai_{n}" for n in EXPERTS if f"prob_ai_{n}" in scored.columns}
        result = metrics.evaluate_models(scored, {**models, "meta": "prob_ai"})
        self._write(result, "evaluation")
        write_report(self.report(), f"{self.path}/report")

    # --- results ----------------------------------------------------------

    def counts(self) -> DataFrame:
        return corpus.corpus_counts(self.table("sentences"))

    def meta_model(self) -> meta.MetaModel:
        return meta.MetaModel.load(self.spark, f"{self.path}/meta")

    def detector(self) -> Detector:
        models = experts.load_experts(f"{self.path}/experts")
        return Detector(self.settings, models, self.meta_model(), self._bigrams())

    def evaluation(self) -> DataFrame:
        """Held-out metrics of each expert and of the ensemble."""
        return self.table("evaluation")

    def importance(self) -> DataFrame:
        return meta.top_features(self.meta_model().importance(self.spark), self.settings.meta.top_n)

    def report(self) -> DataFrame:
        """Tidy report: (section, name, slice, metric, value) plus texts."""
        spark = self.spark
        columns = "section string, name string, slice string, metric string, value double, note string"
        info = read_json(spark, f"{self.path}/meta/info")
        rows = [
            ("summary", "version", None, None, None, VERSION),
            ("summary", "status", None, None, None, "completed"),
            ("summary", "created", None, None, None, now()),
            ("summary", "settings", None, None, None, str(self.settings.to_dict())),
        ]
        for name in EXPERTS:
            found = read_json(spark, f"{self.path}/expert_metrics/{name}")
            rows += [("validation", name, "all", k, float(v), None) for k, v in found.items()]
        found = dict(info["metrics"])
        flips = found.pop("fragility")
        rows += [
            ("validation", "meta", "all", k, None if v is None else float(v), None)
            for k, v in found.items()
        ]
        rows += [("fragility", "meta", "all", k, float(v), None) for k, v in flips.items()]
        rows += [
            ("importance", name, None, "gain", float(gain), None)
            for name, gain in info["top_features"]
        ]
        fixed = spark.createDataFrame(rows, columns)
        names = ("accuracy", "f1", "precision", "recall", "roc_auc")
        entries = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names]
        test = self.evaluation().select(
            F.lit("test").alias("section"),
            F.col("model").alias("name"),
            F.col("language").alias("slice"),
            F.inline(F.array(*entries)),
            F.lit(None).cast("string").alias("note"),
        )
        return fixed.unionByName(test)


def run_pipeline(
    documents: DataFrame,
    path: str,
    settings: Settings | None = None,
    resume: bool = True,
) -> PipelineRun:
    """Run every unfinished phase over labelled documents."""
    run = PipelineRun(documents.sparkSession, path, settings or Settings())
    return run.run(documents, resume)
