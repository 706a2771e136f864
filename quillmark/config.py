"""Settings for a run.

One immutable object carries every knob; nothing reads global state.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# The feature vocabulary and the default parameters below must
# keep these names, orders and numbers, because stored tables depend on them.
EXPERTS = {"s1": "window_1", "s3": "window_3", "s5": "window_5"}
EXPERT_COLUMNS = ("prob_ai_s1", "prob_ai_s3", "prob_ai_s5")
POS_TAGS = ("PUNCT", "X", "AUX", "PRON", "PROPN")
WINDOW_FEATURES = (
    "smog_index",
    "ari",
    "type_token_ratio",
    "punct_density",
    "exclamations",
    "ellipsis",
    "avg_sentence_length",
    "sentence_length_std",
    "pos_PUNCT",
    "pos_X",
    "pos_AUX",
    "pos_PRON",
    "pos_PROPN",
    "perplexity",
)
LANGUAGE_IDS = {"en": 0, "de": 1, "fr": 2, "es": 3, "pt": 4}
LANGUAGE_MAP = {
    "en": "en",
    "de": "de",
    "fr": "fr",
    "es": "es",
    "pt": "pt",
    "ca": "es",
    "it": "en",
    "nl": "en",
}
DEFAULT_LANGUAGE = "en"


@dataclass(frozen=True)
class SplitSettings:
    train: float = 0.80
    val: float = 0.10
    test: float = 0.10
    seed: int = 42
    stratify: bool = True
    # "doc" keeps a document in one split; "sentence" splits rows one by one.
    level: str = "doc"

    def __post_init__(self):
        total = self.train + self.val + self.test
        if abs(total - 1.0) > 1e-8:
            raise ValueError(f"split fractions must sum to 1, got {total}")
        if self.level not in ("doc", "sentence"):
            raise ValueError(f"level must be 'doc' or 'sentence', got {self.level!r}")


@dataclass(frozen=True)
class WindowSettings:
    radii: tuple[int, ...] = (0, 1, 2)
    # None keeps every sentence; 100 gives the classic first-100 cap.
    max_sentences: int | None = None


@dataclass(frozen=True)
class ExpertSettings:
    num_features: int = 1 << 18
    max_iter: int = 20
    reg_params: tuple[float, ...] = (0.0, 0.01)
    folds: int = 3
    # None scores whole windows; an integer truncates to that many tokens.
    max_tokens: int | None = None


@dataclass(frozen=True)
class FeatureSettings:
    sample_from_train: int = 10_000
    use_val: bool = True
    stratified_sampling: bool = True
    chunks: int = 64
    stylometric: bool = True
    perplexity: bool = True
    predictions: bool = True
    lm_smoothing: float = 0.1
    # Where the expert scores of training rows come from: "out_of_fold" models
    # never saw the document, "in_sample" uses the final experts on all rows.
    expert_scores: str = "out_of_fold"

    def __post_init__(self):
        if self.expert_scores not in ("out_of_fold", "in_sample"):
            raise ValueError(f"unknown expert_scores {self.expert_scores!r}")


@dataclass(frozen=True)
class DropoutSettings:
    enabled: bool = True
    rate: float = 0.30
    neutral: float = 0.50
    weights: tuple[int, int, int] = (1, 1, 2)
    mode: str = "concat"
    seed: int = 123


@dataclass(frozen=True)
class MetaSettings:
    validation: float = 0.15
    trials: int = 30
    max_depth: tuple[int, int] = (3, 10)
    learning_rate: tuple[float, float] = (0.01, 0.3)
    subsample: tuple[float, float] = (0.5, 1.0)
    colsample: tuple[float, float] = (0.5, 1.0)
    min_gain: tuple[float, float] = (0.0, 5.0)
    min_child: tuple[int, int] = (1, 10)
    rounds: tuple[int, int] = (200, 1000)
    round_step: int = 50
    # "model" learns from earlier trials, "random" draws each one on its own.
    search: str = "model"
    startup: int = 10
    batch: int = 5
    # Tree counts at which only the best share of trials goes on. Without any, every trial
    # is grown to its end: its rounds, or where early stopping ends it.
    rungs: tuple[int, ...] = ()
    keep: float = 0.34
    early_stopping: bool = True
    patience: int = 20
    max_bins: int = 64
    top_n: int = 50
    saved_top_n: int = 20

    def __post_init__(self):
        if self.search not in ("model", "random"):
            raise ValueError(f"unknown search {self.search!r}")


@dataclass(frozen=True)
class Settings:
    key: str = "doc_id"
    text: str = "text"
    label: str = "label"
    seed: int = 42
    split: SplitSettings = field(default_factory=SplitSettings)
    window: WindowSettings = field(default_factory=WindowSettings)
    expert: ExpertSettings = field(default_factory=ExpertSettings)
    feature: FeatureSettings = field(default_factory=FeatureSettings)
    dropout: DropoutSettings = field(default_factory=DropoutSettings)
    meta: MetaSettings = field(default_factory=MetaSettings)

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict) -> "Settings":
        """Build from nested plain values, e.g. a parsed YAML or JSON file."""
        sections = {
            "split": SplitSettings,
            "window": WindowSettings,
            "expert": ExpertSettings,
            "feature": FeatureSettings,
            "dropout": DropoutSettings,
            "meta": MetaSettings,
        }
        built = {}
        for name, value in values.items():
            if name in sections:
                value = sections[name](
                    **{k: tuple(v) if isinstance(v, list) else v for k, v in value.items()}
                )
            built[name] = value
        return cls(**built)
