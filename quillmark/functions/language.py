"""Language detection by stop-word hits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.config import DEFAULT_LANGUAGE, LANGUAGE_IDS, LANGUAGE_MAP
from quillmark.functions.lexicons import STOPWORDS, by_language
from quillmark.functions.text import let

NON_LETTERS = r"[^\p{L}\p{M}]+"


def map_language(code: Column) -> Column:
    """Fold detector codes into the supported languages; the rest is English."""
    pairs = [F.lit(x) for pair in LANGUAGE_MAP.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(DEFAULT_LANGUAGE))


def language_hits(clean: Column) -> Column:
    """Array of (hits, -preference, code), one entry per known language."""
    lists = by_language(STOPWORDS)
    known = sorted({w for ws in lists.values() for w in ws})
    candidates = F.filter(F.split(F.lower(clean), NON_LETTERS), lambda w: w.isin(known))

    def entry(hits: Column, preference: int, code: str) -> Column:
        return F.struct(
            F.size(F.filter(hits, lambda w: w.isin(lists[code]))).alias("hits"),
            F.lit(-preference).alias("preference"),
            F.lit(code).alias("code"),
        )

    return let(
        candidates,
        lambda hits: F.array(*[entry(hits, i, code) for i, code in enumerate(lists)]),
    )


def detect_language(clean: Column) -> Column:
    """Most stop-word hits wins; ties and no hits go to the earlier list."""
    return map_language(F.array_max(language_hits(clean))["code"])


def language_id(language: Column) -> Column:
    return reduce(
        lambda rest, item: F.when(language == item[0], F.lit(item[1])).otherwise(rest),
        LANGUAGE_IDS.items(),
        F.lit(-1),
    )
