"""Documents to sentence rows with context windows, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.features import FEATURE_GROUPS, GROUP_FIELDS, TextCounts, WindowCounts, sentence_stats
from quillmark.functions.language import detect_language, language_id
from quillmark.functions.text import clean_text, collapse_spaces, let, split_sentences


def window_name(radius: int) -> str:
    return f"window_{2 * radius + 1}"


def spread(
    df: DataFrame, *keys: str, per_core: int = 4, like: DataFrame | None = None
) -> DataFrame:
    """Spread a few large file splits over the cluster before heavy work.

    Text work is CPU bound, so an input read as few tasks is hashed out by key
    (evenly without one). An input that already has enough splits is left as it
    is, because moving whole texts would cost more than it gains. After a join,
    pass the scan it started from as ``like``: its splits can be counted
    without running the join, and a small input that the planner chose to
    broadcast is spread again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    source = df if like is None else like
    if df.isStreaming or 2 * source.rdd.getNumPartitions() >= per_core * cores:
        return df
    return df.repartition(per_core * cores, *keys)


def clean_documents(df: DataFrame, text: str = "text", language: bool = True) -> DataFrame:
    """Replace the text column by ``_clean`` and, if wanted, add ``language``.

    The language is found once per document, on its cleaned text.
    """
    keep = [c for c in df.columns if c not in (text, "language")]
    cleaned = df.select(*keep, clean_text(F.col(text)).alias("_clean"))
    if not language:
        return cleaned
    return cleaned.select("*", detect_language(F.col("_clean")).alias("language"))


def _offset_name(offset: int) -> str:
    return "at" if offset == 0 else f"{'before' if offset < 0 else 'after'}_{abs(offset)}"


def neighbour_rows(
    df: DataFrame,
    reach: int,
    measure: Callable[[Column], Column] | None = None,
    max_sentences: int | None = None,
) -> DataFrame:
    """One row per sentence with its neighbours as columns.

    The rows carry only ``2 * reach + 1`` sentences, never the whole document,
    so the output grows linearly with the text even for very long documents.
    ``measure`` maps a sentence to what should be carried; it runs once each.
    """
    sentences = split_sentences(F.col("_clean"), max_sentences)
    if measure is not None:
        sentences = F.transform(sentences, lambda s: measure(s))

    def rows(all_: Column) -> Column:
        def row(here: Column, i: Column) -> Column:
            around = [
                (here if d == 0 else F.get(all_, i + F.lit(d))).alias(_offset_name(d))
                for d in range(-reach, reach + 1)
            ]
            return F.struct(i.alias("sentence_index"), *around)

        return F.transform(all_, row)

    keep = [c for c in df.columns if c != "_clean"]
    return df.select(*keep, F.inline(let(sentences, rows)))


def covered(radius: int) -> list[Column]:
    return [F.col(_offset_name(d)) for d in range(-radius, radius + 1)]


def context_windows(
    df: DataFrame,
    text: str = "text",
    radii: Iterable[int] = (0, 1, 2),
    max_sentences: int | None = None,
    language: bool = True,
) -> DataFrame:
    """One row per sentence: the other columns, ``sentence_index`` and the windows.

    A window of radius r joins a sentence with up to r neighbours on each side,
    clipped at the ends. Null or blank text gives one row of empty windows.
    """
    radii = tuple(radii)
    cleaned = clean_documents(df, text, language)
    rows = neighbour_rows(cleaned, max(radii), max_sentences=max_sentences)
    keep = [c for c in cleaned.columns if c != "_clean"]
    return rows.select(
        *keep,
        "sentence_index",
        *[F.concat_ws(" ", *covered(r)).alias(window_name(r)) for r in radii],
    )


def sentence_table(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "label",
    radii: Iterable[int] = (0, 1, 2),
    max_sentences: int | None = None,
    carry: Iterable[str] = (),
) -> DataFrame:
    """The stored sentence table: windows, language, label, doc id and position."""
    radii = tuple(radii)
    source = df.select(
        F.concat(F.lit("doc_"), F.col(key).cast("string")).alias("doc_id"),
        F.col(label).alias("label"),
        F.col(text).alias("text"),
        *carry,
    )
    rows = context_windows(source, "text", radii, max_sentences)
    return rows.select(
        *[window_name(r) for r in radii],
        "language",
        "label",
        "doc_id",
        "sentence_index",
        *carry,
    )


def window_features(
    df: DataFrame,
    text: str = "text",
    radii: Iterable[int] = (0, 1, 2),
    max_sentences: int | None = None,
    groups: Iterable[str] = tuple(FEATURE_GROUPS),
    windows: bool = False,
    with_language_id: bool = True,
) -> DataFrame:
    """Stylometric features of every window, straight from the documents.

    A narrow projection: no join, no shuffle. ``windows=True`` also keeps the
    window texts.
    """
    radii, groups = tuple(radii), tuple(groups)
    needs_language = "pos" in groups or with_language_id
    cleaned = clean_documents(df, text, needs_language)
    language = F.col("language") if needs_language else F.lit(None).cast("string")
    wanted = {field for group in groups for field in GROUP_FIELDS[group]} | ({"text"} if windows else set())
    rows = neighbour_rows(
        cleaned,
        max(radii),
        lambda s: sentence_stats(s, language, pos="pos" in groups, wanted=wanted),
        max_sentences,
    )
    columns = [F.col(c) for c in cleaned.columns if c != "_clean"]
    columns.append(F.col("sentence_index"))
    for radius in radii:
        counts = WindowCounts(covered(radius))
        if windows:
            columns.append(counts.text().alias(window_name(radius)))
        for group in groups:
            columns.extend(
                value.alias(f"{window_name(radius)}_{name}")
                for name, value in FEATURE_GROUPS[group](counts).items()
            )
    if with_language_id:
        columns.append(language_id(F.col("language")).alias("language_id"))
    return rows.select(*columns)


def text_features(
    df: DataFrame,
    columns: Iterable[str] = ("window_1", "window_3", "window_5"),
    language: str = "language",
    groups: Iterable[str] = tuple(FEATURE_GROUPS),
) -> DataFrame:
    """Append the same features for text columns of any length.

    For rows that are already windowed, such as a sample; whole corpora are
    cheaper with ``window_features``, which measures each sentence once.
    """
    columns, groups = tuple(columns), tuple(groups)
    code = F.col(language)
    measured = df.select(
        "*",
        *[
            F.transform(
                split_sentences(collapse_spaces(F.coalesce(F.col(c), F.lit("")))),
                lambda s: sentence_stats(s, code, pos="pos" in groups),
            ).alias(f"_stats_{c}")
            for c in columns
        ],
    )
    values = [
        value.alias(f"{c}_{name}")
        for c in columns
        for group in groups
        for name, value in FEATURE_GROUPS[group](TextCounts(F.col(f"_stats_{c}"))).items()
    ]
    return measured.select(*df.columns, *values, language_id(code).alias("language_id"))


def assemble_features(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("doc_id", "sentence_index")
) -> DataFrame:
    """Put feature columns side by side by row key."""
    return left.join(right, list(keys), "inner")
