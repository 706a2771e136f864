"""Cleaning and sentence splitting as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.lexicons import ABBREVIATIONS, NUMBERED, words

# The closed list of tags that cleaning removes; other tags stay.
HTML_TAGS = (
    "p", "div", "span", "br", "hr", "img", "a", "h1", "h2", "h3", "h4", "h5", "h6",
    "ul", "ol", "li", "table", "tr", "td", "th", "thead", "tbody", "strong", "em", "b",
    "i", "u", "script", "style", "head", "body", "html", "meta", "link", "title", "form",
    "input", "button", "label", "select", "option", "textarea",
)

# Unicode white space, spelled out because engines disagree about \s.
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"

# What each cleaning step matches.
TAG_PATTERN = rf"</?(?:{'|'.join(HTML_TAGS)})(?:{SPACE}[^>]*)?>|<!--.*?-->"
IMAGE_PATTERN = r"!\[.*?\]\(.*?\)"
LINK_PATTERN = r"\[([^\]]+)\]\((.*?)\)"
CODE_PATTERN = r"`{1,3}[^`]+`{1,3}"
BOLD_PATTERN = r"\*\*([^*]+)\*\*"
ITALIC_PATTERN = r"\*([^*]+)\*"
SPACES_PATTERN = rf"{SPACE}+"

# A sentence ends at stops, with any closing quotes or brackets, before a space.
# Cleaned text holds no line break, so "\n" can mark the cut.
CUT_PATTERN = r"""([.!?]+["')\]”’»]*) """
UNCUT_PATTERN = rf"(^|[ \n(])({'|'.join(words(ABBREVIATIONS))})\.\n"
UNCUT_NUMBER_PATTERN = rf"(^|[ \n(])({'|'.join(words(NUMBERED))})\.\n([0-9])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use the result many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_html(text: Column) -> Column:
    """Remove known tags and one-line comments; what they enclose stays."""
    return F.regexp_replace(text, F.lit(f"(?iud){TAG_PATTERN}"), F.lit(""))


def strip_markdown(text: Column) -> Column:
    """Remove images and code; keep the text of links, bold and italics."""
    for pattern, keep in (
        (f"(?d){IMAGE_PATTERN}", ""),
        (f"(?d){LINK_PATTERN}", "$1"),
        (CODE_PATTERN, ""),
        (BOLD_PATTERN, "$1"),
        (ITALIC_PATTERN, "$1"),
    ):
        text = F.regexp_replace(text, F.lit(pattern), F.lit(keep))
    return text


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, F.lit(SPACES_PATTERN), F.lit(" ")))


def clean_text(text: Column) -> Column:
    """Null becomes empty, so every document keeps at least one row."""
    return collapse_spaces(strip_markdown(strip_html(F.coalesce(text, F.lit("")))))


def _cut(clean: Column) -> Column:
    """Cleaned text with a line break between sentences."""
    cut = F.regexp_replace(clean, F.lit(CUT_PATTERN), F.lit("$1\n"))
    # Two rounds, because neighbouring abbreviations share their separator.
    for _ in range(2):
        cut = F.regexp_replace(cut, F.lit(UNCUT_PATTERN), F.lit("$1$2. "))
    return F.regexp_replace(cut, F.lit(UNCUT_NUMBER_PATTERN), F.lit("$1$2. $3"))


def split_sentences(clean: Column, max_sentences: int | None = None) -> Column:
    """Array of sentences of cleaned text; blank text gives one empty sentence."""
    sentences = F.split(_cut(clean), "\n")
    return sentences if max_sentences is None else F.slice(sentences, 1, max_sentences)


def marked_sentences(clean: Column, max_sentences: int | None = None) -> Column:
    """The same sentences as one text with a line break between them."""
    return _cut(clean) if max_sentences is None else F.array_join(split_sentences(clean, max_sentences), "\n")


def tokens(sentence: Column) -> Column:
    """Lower-cased words between spaces."""
    return F.array_remove(F.split(F.lower(sentence), " "), "")
