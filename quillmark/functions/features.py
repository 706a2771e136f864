"""Per-sentence counts and the window features built from their sums.

A sentence is measured once. Every window feature is then plain arithmetic on
the counts of the sentences it covers: re-splitting a joined window gives back
the same sentences, so nothing has to be scanned again per window.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.config import POS_TAGS
from quillmark.functions.lexicons import AUXILIARIES, PRONOUNS, by_language
from quillmark.functions.text import let, tokens

VOWELS = "aeiouyàáâãäåæèéêëìíîïòóôõöøœùúûüýÿ"
# A word with three or more vowel groups.
POLYSYLLABLE = rf"(?:^| )[^{VOWELS} ]*[{VOWELS}]+(?:[^{VOWELS} ]+[{VOWELS}]+){{2}}"
# A word holding at least one letter or digit.
LEXICAL_WORD = r"(?:^| )[^\p{L}\p{N} ]*[\p{L}\p{N}]"

TAGGED_WORD = r"[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}'’]*"
PUNCTUATION_RUN = r"\p{P}+"
SYMBOL_RUN = r"[^\p{L}\p{M}\p{N}\p{P} ]+"
CAPITAL = r"^\p{Lu}"


def _occurrences(text: Column, piece: str) -> Column:
    """Non-overlapping count of a literal piece."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))
    return (gone / len(piece)).cast("int")


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _word_tags(words: Column, aux: list[str], pron: list[str]) -> Column:
    closed = sorted(set(aux) | set(pron))

    def is_name(word: Column, position: Column) -> Column:
        # The cheap test runs first: most words are lower case already.
        capital = (F.lower(word) != word) & word.rlike(CAPITAL)
        return (position > 0) & capital & ~F.lower(word).isin(closed)

    def counts(closed_words: Column) -> Column:
        n_aux = F.size(F.filter(closed_words, lambda w: w.isin(aux)))
        return F.struct(
            n_aux.alias("n_aux"),
            (F.size(closed_words) - n_aux).alias("n_pron"),
            F.size(F.filter(words, is_name)).alias("n_propn"),
        )

    lowered = F.transform(words, lambda w: F.lower(w))
    return let(F.filter(lowered, lambda w: w.isin(closed)), counts)


def pos_counts(sentence: Column, language: Column) -> Column:
    """Struct of token counts by tag.

    Symbols are PUNCT when they are Unicode punctuation and X otherwise. Words
    are AUX or PRON by lexicon, and PROPN when capitalised inside the sentence.
    Languages without a lexicon use the English one.
    """
    lexicons = {
        code: (aux, by_language(PRONOUNS)[code]) for code, aux in by_language(AUXILIARIES).items()
    }

    def tagged(words: Column) -> Column:
        return reduce(
            lambda rest, code: F.when(
                language == code, _word_tags(words, *lexicons[code])
            ).otherwise(rest),
            [c for c in lexicons if c != "en"],
            _word_tags(words, *lexicons["en"]),
        )

    def assembled(words: Column) -> Column:
        # Each pattern runs once: what stands inside a lambda is not shared by the optimizer.
        runs = F.struct(
            _matches(sentence, PUNCTUATION_RUN).alias("n_punct"), _matches(sentence, SYMBOL_RUN).alias("n_x")
        )
        return let(
            F.struct(runs.alias("runs"), tagged(words).alias("tags")),
            lambda found: F.struct(
                (F.size(words) + found["runs"]["n_punct"] + found["runs"]["n_x"]).alias("n_token"),
                found["runs"]["n_punct"].alias("n_punct"),
                found["runs"]["n_x"].alias("n_x"),
                found["tags"]["n_aux"].alias("n_aux"),
                found["tags"]["n_pron"].alias("n_pron"),
                found["tags"]["n_propn"].alias("n_propn"),
            ),
        )

    return let(F.regexp_extract_all(sentence, F.lit(TAGGED_WORD), F.lit(0)), assembled)


def sentence_stats(
    sentence: Column, language: Column, pos: bool = True, wanted: Iterable[str] | None = None
) -> Column:
    """Struct of everything the window features need to know about a sentence.

    With ``wanted`` only these fields and the number of words are made.
    """

    def assembled(words: Column) -> Column:
        stats = [
            sentence.alias("text"),
            words.alias("words"),
            F.size(words).alias("n_word"),
            _matches(sentence, LEXICAL_WORD).alias("n_lexical"),
            (F.length(sentence) - F.greatest(F.size(words) - 1, F.lit(0))).alias("n_char"),
            _matches(F.lower(sentence), POLYSYLLABLE).alias("n_poly"),
            _matches(sentence, "[.!?]").alias("n_stop"),
            _occurrences(sentence, "!").alias("n_exclaim"),
            _occurrences(sentence, "...").alias("n_ellipsis"),
        ]
        if wanted is not None:
            fields = ("text", "words", "n_word", "n_lexical", "n_char", "n_poly", "n_stop", "n_exclaim", "n_ellipsis")
            stats = [x for name, x in zip(fields, stats, strict=True) if name == "n_word" or name in wanted]
        if pos:
            stats.append(pos_counts(sentence, language).alias("pos"))
        return F.struct(*stats)

    return let(tokens(sentence), assembled)


class WindowCounts:
    """Sums over the sentences a window covers; missing neighbours count 0."""

    def __init__(self, sentences: list[Column]):
        self.sentences = sentences

    def total(self, *path: str) -> Column:
        def pick(sentence: Column) -> Column:
            value = reduce(lambda c, name: c[name], path, sentence)
            return F.coalesce(value, F.lit(0))

        return reduce(lambda a, b: a + b, [pick(s) for s in self.sentences])

    def n_sentences(self) -> Column:
        return reduce(
            lambda a, b: a + b, [s.isNotNull().cast("int") for s in self.sentences]
        )

    def squares(self) -> Column:
        return reduce(
            lambda a, b: a + b,
            [
                F.coalesce(s["n_word"].cast("bigint") * s["n_word"], F.lit(0))
                for s in self.sentences
            ],
        )

    def text(self) -> Column:
        return F.concat_ws(" ", *[s["text"] for s in self.sentences])

    def distinct_words(self) -> Column:
        empty = F.array().cast("array<string>")
        return F.size(
            F.array_distinct(F.concat(*[F.coalesce(s["words"], empty) for s in self.sentences]))
        )


class TextCounts(WindowCounts):
    """The same sums over an array of sentences of any length."""

    def __init__(self, sentences: Column):
        self.array = sentences

    def _sum(self, pick) -> Column:
        return F.aggregate(self.array, F.lit(0).cast("bigint"), lambda acc, s: acc + pick(s))

    def total(self, *path: str) -> Column:
        return self._sum(lambda s: reduce(lambda c, name: c[name], path, s)).cast("int")

    def n_sentences(self) -> Column:
        return F.size(self.array)

    def squares(self) -> Column:
        return self._sum(lambda s: s["n_word"].cast("bigint") * s["n_word"])

    def text(self) -> Column:
        return F.array_join(F.transform(self.array, lambda s: s["text"]), " ")

    def distinct_words(self) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(self.array, lambda s: s["words"]))))


def readability(w: WindowCounts) -> dict[str, Column]:
    """SMOG needs three sentences; ARI needs one word."""
    n, lexical = w.n_sentences(), w.total("n_lexical")
    smog = F.lit(1.043) * F.sqrt(F.lit(30.0) * w.total("n_poly") / n) + F.lit(3.1291)
    ari = (
        F.lit(4.71) * F.try_divide(w.total("n_char"), lexical)
        + F.lit(0.5) * (lexical / n)
        - F.lit(21.43)
    )
    return {
        "smog_index": F.when((n >= 3) & (lexical > 0), smog).otherwise(F.lit(0.0)),
        "ari": F.coalesce(ari, F.lit(0.0)),
    }


def lexical(w: WindowCounts) -> dict[str, Column]:
    ratio = F.try_divide(w.distinct_words(), w.total("n_word"))
    return {"type_token_ratio": F.coalesce(ratio, F.lit(0.0))}


def punctuation(w: WindowCounts, extra: bool = False) -> dict[str, Column]:
    """``punct_density`` only says whether any stop occurs; the extra
    ``punct_per_word`` is the density its name suggests."""
    stops = w.total("n_stop")
    columns = {
        "punct_density": (stops > 0).cast("double"),
        "exclamations": w.total("n_exclaim"),
        "ellipsis": w.total("n_ellipsis"),
    }
    if extra:
        columns["punct_per_word"] = F.coalesce(F.try_divide(stops, w.total("n_word")), F.lit(0.0))
    return columns


def sentence_length(w: WindowCounts) -> dict[str, Column]:
    """Mean and sample deviation of words per sentence, from integer sums."""
    n, total = w.n_sentences(), w.total("n_word").cast("bigint")
    spread = n * w.squares() - total * total
    return {
        "avg_sentence_length": total / n,
        "sentence_length_std": F.when(n > 1, F.sqrt(F.try_divide(spread, n * (n - 1)))).otherwise(
            F.lit(0.0)
        ),
    }


def pos_shares(w: WindowCounts) -> dict[str, Column]:
    counted = w.total("pos", "n_token")
    return {
        f"pos_{tag}": F.coalesce(
            F.try_divide(w.total("pos", f"n_{tag.lower()}"), counted), F.lit(0.0)
        )
        for tag in POS_TAGS
    }


FEATURE_GROUPS = {
    "readability": readability,
    "lexical": lexical,
    "punctuation": punctuation,
    "sentence_length": sentence_length,
    "pos": pos_shares,
}

#: What each group reads of a sentence, beside the number of words and the tags.
GROUP_FIELDS = {
    "readability": ("n_lexical", "n_char", "n_poly"),
    "lexical": ("words",),
    "punctuation": ("n_stop", "n_exclaim", "n_ellipsis"),
    "sentence_length": (),
    "pos": (),
}
