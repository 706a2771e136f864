"""Encoding and decoding for piece vocabularies of the merge type.

A prefix table holds, for each prefix of a word, the one token that its encoding can end
in. The candidates are the vocabulary matches that end there, found by an automaton; a
candidate is right if it may follow the last token of the prefix in front of it, that is,
if merging the two tokens' characters gives just these two tokens. Ids are then read
backwards from the last entry. Merging itself is only run for pairs of tokens, whose
answers are remembered, and for runs of the space mark.

Texts fall apart at space marks, because only runs of marks hold one that is not in
front; words met before are looked up.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame

from quillmark.llm.common import small_batches, texts
from quillmark.llm.word_cache import WordCache

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
_WORKERS: dict[str, PieceTable] = {}


class PieceTable:
    """Encodes and decodes with the vocabulary of one model file, read once per worker."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        normal = [
            i
            for i in range(len(self.pieces))
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in normal}
        self.scores = {self.pieces[i]: model.get_score(i) for i in normal}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if model.is_byte(i)}
        # What each id stands for in the decoded text; bytes and controls are left out.
        self.shown: dict[str, str] = {str(i): p.replace(MARK, " ") for p, i in self.ids.items()}
        self.byte_of = {str(i): b for b, i in self.bytes.items()}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.adjacent = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.pairs = WordCache(lambda p: self.merge(p[0] + p[1]) == [p[0], p[1]])
        self.alone = WordCache(lambda p: self.merge(p) == [p])
        self.words = WordCache(self._word)
        self.runs = WordCache(lambda n: self.merge(MARK * n))

    def merge(self, text: str) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, until none is left."""
        symbols: list[str | None] = list(text)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        agenda: list[tuple[float, int, str, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(symbols):
                both = symbols[left] + symbols[after[left]]
                if both in self.scores:
                    heapq.heappush(agenda, (-self.scores[both], left, symbols[left], symbols[after[left]]))

        for k in range(len(symbols) - 1):
            offer(k)
        while agenda:
            _, left, a, b = heapq.heappop(agenda)
            right = after[left]
            if symbols[left] != a or right >= len(symbols) or symbols[right] != b:
                continue  # one of the two has been merged meanwhile
            symbols[left], symbols[right] = a + b, None
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [x for x in symbols if x is not None]

    def tokens(self, word: str) -> list[str]:
        """Tokens of a word by its prefix table; characters without a piece stand alone."""
        ends: list[str | None] = [None] * (len(word) + 1)
        pairs = self.pairs
        for end, piece in self.automaton.iter(word):
            end += 1
            if ends[end] is None:
                start = end - len(piece)
                last = ends[start]
                if last is None and start:
                    last = self._unknown(word, start)
                    if last is None:
                        continue
                if pairs[last, piece] if start else self.alone[piece]:
                    ends[end] = piece
        out = []
        at = len(word)
        while at > 0:
            piece = ends[at] or word[at - 1]
            out.append(piece)
            at -= len(piece)
        return out[::-1]

    def _unknown(self, word: str, at: int) -> str | None:
        """The character in front of ``at`` if it has no piece of its own."""
        return None if word[at - 1] in self.ids else word[at - 1]

    def _ids(self, tokens: list[str]) -> str:
        out = []
        for t in tokens:
            i = self.ids.get(t)
            out += [str(i)] if i is not None else [str(self.bytes[b]) for b in t.encode()]
        return ",".join(out)

    def _word(self, word: str) -> tuple[str, str]:
        """Ids of the mark and a word, joined by commas, and what they decode to."""
        # A last stop or comma that no piece joins to the character before it stands alone.
        if len(word) > 1 and word[-1] in ".,!" and word[-2:] not in self.adjacent:
            ids, shown = self.words[word[:-1]]
            end = self._ids([word[-1]])
            return f"{ids},{end}", shown + self.shown_as(end)
        ids = self._ids(self.tokens(MARK + word))
        return ids, self.shown_as(ids)

    def coded(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by commas, and the text decoded from them, word by word."""
        if not text:
            return "", ""
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            ids = self._with_runs(words)
            return ids, self.decode(ids)
        parts = list(map(self.words.__getitem__, words))
        return ",".join([x[0] for x in parts]), "".join([x[1] for x in parts]).removeprefix(" ")

    def encode(self, text: str) -> str:
        """Decimal ids joined by commas; the empty text has none."""
        return self.coded(text)[0]

    def _with_runs(self, words: list[str]) -> str:
        """Ids where empty words stand for space marks that follow one another."""
        out, run = [], 0
        for word in words:
            if not word:
                run += 1
                continue
            ids = self.words[word][0]
            if run:
                first, _, rest = ids.partition(",")
                if first == str(self.ids[MARK]):  # the word's own mark joins the run
                    run, ids = run + 1, rest
                out.append(self._ids(self.runs[run]))
                run = 0
            if ids:
                out.append(ids)
        if run:
            out.append(self._ids(self.runs[run]))
        return ",".join(out)

    def decode(self, ids: str) -> str:
        """The text of ids as ``encode`` gives them; the first mark is left out."""
        return self.shown_as(ids).removeprefix(" ") if ids else ""

    def shown_as(self, ids: str) -> str:
        listed = ids.split(",")
        try:
            return "".join(map(self.shown.__getitem__, listed))
        except KeyError:  # bytes, whose characters take several ids
            raw = b"".join(
                bytes([self.byte_of[i]]) if i in self.byte_of else self.shown.get(i, "").encode() for i in listed
            )
            return raw.decode("utf-8", "replace")

    def turn(self) -> None:
        for cache in (self.words, self.pairs, self.alone, self.runs):
            cache.turn()


def table(path: str) -> PieceTable:
    if path not in _WORKERS:
        _WORKERS[path] = PieceTable(path)
    return _WORKERS[path]


def encode_documents(docs: DataFrame, path: str | None = None, ids: bool = False) -> DataFrame:
    """Token counts and digests of ids and decoded texts; with ``ids`` the ids themselves too.

    Null text is empty: no tokens and the digests of the empty string. Repeated rows give
    repeated results; an empty table stays empty; other columns are ignored.
    """
    path = path or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = table(path)
        for batch in small_batches(batches):
            coder.turn()
            both = [coder.coded(x) for x in batch["text"]]
            coded = [x[0] for x in both]
            out = {
                "doc_id": batch["doc_id"].astype("Int64"),
                "n_tokens": [x.count(",") + 1 if x else 0 for x in coded],
                "ids_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in coded],
                "decoded_sha256": [hashlib.sha256(x[1].encode()).hexdigest() for x in both],
            }
            if ids:
                out["ids"] = coded
            yield pd.DataFrame(out)

    return texts(docs).mapInPandas(run, CODED + (", ids string" if ids else ""))
