"""Alignment of the tokens of two tokenizers over the same bytes.

Tokenizer A (tokenizers, byte-level) gives character offsets, tokenizer B (sentencepiece)
the spans of its immutable proto. Where a span ends and the next one starts is a coarse cut.
Tokens between two coarse cuts share a character (pieces of a multibyte character, byte
fallback tokens); their decoded bytes refine the place inside it. Offsets where tokens of
both end cut the text into groups, and every stretch between neighbouring ends is one
A-B pair of overlapping tokens, a link.

Both tokenizers cut at a lone space between two other characters, so a text is aligned
word by word: words seen before come from a memory of bounded size. Words fall apart
further where A's pattern cuts and no piece of B holds the two characters side by side. A
text with a word whose decoded bytes differ from its own is aligned as a whole, which
settles it exactly.

Counting is one aggregate over (A id, B id) pairs, one row per document and pair. To score
the links, the commonest pairs (``HOT``, a fixed number) are looked up from a broadcast
table, so no key that still shuffles holds more than a small share of the rows; the rest
are joined to their counts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import read, small_batches, stage, texts

MODEL_A = "byte_bpe_50k.json"
MODEL_B = "piece_bpe_32k.model"
MARK = "▁"
#: Commonest id pairs that are broadcast; 24 bytes each.
HOT = 65_536
#: Words kept in a worker's memory, and the longest word worth keeping.
WORDS, WORD_CHARS = 250_000, 40
#: New words that share one call of a tokenizer.
TOGETHER = 32
#: Both tokenizers cut in front of a lone space. ``\s`` here holds every character that theirs holds.
WORD = re.compile(r"(?<=\S)(?= \S)")
#: Inside a word A cuts between letters and stops, and around a newline between other characters.
PART = re.compile(r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ɏ])(?=[.,;:!?])|(?<=[.,;:!?])(?=\n)|(?<=\S\n)(?=[0-9A-Za-zÀ-ÖØ-öø-ɏ])")
LINKED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
PIECE = attrgetter("id", "begin", "end")
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def flat(nested, size: int) -> np.ndarray:
    """The whole numbers of nested sequences, end to end."""
    return np.fromiter(chain.from_iterable(nested), "int64", size)


def refined_ends(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte offsets where tokens end, from byte spans of their characters and their sizes.

    A span's end is a coarse cut if the next span starts there or later and no cut lies
    there yet. A lone token between two cuts takes the cut; tokens that share characters are
    placed by their own bytes and have to fill the stretch between the cuts.
    """
    starts, ends = spans[:, 0], spans[:, 1]
    cut = np.ones(len(ends), bool)
    cut[:-1] = starts[1:] >= ends[:-1]
    behind = np.flatnonzero(cut)
    cut[behind[1:][ends[behind[1:]] == ends[behind[:-1]]]] = False
    run = np.cumsum(sizes)
    # The last cut in front of each token, and the bytes decoded since.
    before = np.concatenate([[-1], np.maximum.accumulate(np.where(cut, np.arange(len(ends)), -1))[:-1]]).astype(int)
    since = run - np.where(before >= 0, run[before], 0)
    places = np.where(before >= 0, ends[before], 0) + since
    if (places != ends)[cut].any():
        raise ValueError("spans of a token do not hold its bytes")
    return places


class Aligner:
    """Both tokenizers of a worker, with a bounded memory of aligned words."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level_alphabet()
        of_a = {
            i: bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
            for token, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        self.bytes_a = [of_a.get(i, b"") for i in range(max(of_a) + 1)]
        self.n_b = self.b.get_piece_size()
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()
            for i, piece in ((i, self.b.id_to_piece(i)) for i in range(self.n_b))
        ]
        self.adjacent = {
            p[k : k + 2] for p in map(self.b.id_to_piece, range(self.n_b)) for k in range(len(p) - 1)
        }
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        # An id as it is written inside a group, and at its end.
        most = max(len(self.bytes_a), self.n_b)
        self.inside = np.array([f"{i}," for i in range(most)], object)
        self.last_a = np.array([f"{i}|" for i in range(most)], object)
        self.last_b = np.array([f"{i};" for i in range(most)], object)
        self.words: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def fresh(self, found: list[str]) -> list[tuple[str, bytes, int] | None]:
        """(groups as text, pair keys as bytes, packed counts) of stretches; None if bytes differ.

        A stretch that starts with a space is what B sees behind its own mark; any other is
        shown to B behind a newline, which it never joins to anything, and the tokens of
        mark and newline are left out. Stretches of one word go through the tokenizers
        ``TOGETHER`` at a time, each behind the space that cuts it off.
        """
        lone = [k for k, x in enumerate(found) if x[0] != " " or x[1:2].isspace() or x[-1].isspace()]
        kept = set(lone)
        rest = [k for k in range(len(found)) if k not in kept]
        rows = [[k] for k in lone] + [rest[at : at + TOGETHER] for at in range(0, len(rest), TOGETHER)]
        out: list[tuple[str, bytes, int] | None] = [None] * len(found)
        while rows:
            again = []
            for row, entries in zip(rows, self.aligned([[found[k] for k in row] for row in rows])):
                if entries is not None:
                    for k, entry in zip(row, entries):
                        out[k] = entry
                elif len(row) > 1:
                    again += [[k] for k in row]
            rows = again
        return out

    def aligned(self, rows: list[list[str]]) -> list[list[tuple[str, bytes, int]] | None]:
        """Entries of the stretches in each row; None for a row whose bytes differ.

        Rows are laid end to end, so all of them are aligned by a few array steps.
        """
        found = ["".join(row) for row in rows]
        a = self.a.encode_batch(found, add_special_tokens=False)
        marked = [x[0] == " " for x in found]
        b = self.b.encode([x[1:] if m else "\n" + x for x, m in zip(found, marked)], num_threads=1, return_type="proto")
        b = [list(map(PIECE, x.pieces)) for x in b]
        b = [x if m else x[2:] for x, m in zip(b, marked)]
        raw = [x.encode() for x in found]
        ids_a = [x.ids for x in a]
        bad = {k for k in range(len(found)) if self.differs(raw[k : k + 1], ids_a[k : k + 1], b[k : k + 1])} if self.differs(raw, ids_a, b) else set()
        out: list[list[tuple[str, bytes, int]] | None] = [None] * len(rows)
        good = [k for k in range(len(rows)) if k not in bad]
        if not good:
            return out
        if bad:
            found, marked, raw, a, b, ids_a = ([x[k] for k in good] for x in (found, marked, raw, a, b, ids_a))
        n_a, n_b = np.array([*map(len, ids_a)]), np.array([*map(len, b)])
        tokens_b = flat(chain.from_iterable(b), 3 * n_b.sum()).reshape(-1, 3)
        flat_a, flat_b, spans_b = flat(ids_a, n_a.sum()), tokens_b[:, 0], tokens_b[:, 1:]
        sizes = np.array([*map(len, raw)])
        text_end = np.cumsum(sizes)
        text_start = text_end - sizes
        # Character offsets of A to byte offsets.
        letters = np.frombuffer("".join(found).encode("utf-32-le"), "<u4")
        widths = 1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF)
        byte_at = np.concatenate([[0], np.cumsum(widths)])
        first = np.cumsum([0, *map(len, found)][:-1])
        spans_a = flat(chain.from_iterable(x.offsets for x in a), 2 * n_a.sum()).reshape(-1, 2)
        ends_a = refined_ends(byte_at[spans_a + np.repeat(first, n_a)[:, None]], self.sizes_a[flat_a])
        # Byte spans of B leave out the space in front, or count the newline.
        spans_b = spans_b + np.repeat(np.where(marked, 1, -1), n_b)[:, None]
        spans_b[np.cumsum(n_b) - n_b, 0] = 0
        ends_b = refined_ends(spans_b + np.repeat(text_start, n_b)[:, None], self.sizes_b[flat_b])
        every = np.union1d(ends_a, ends_b)
        pairs = flat_a[np.searchsorted(ends_a, every)] * self.n_b + flat_b[np.searchsorted(ends_b, every)]
        common = np.intersect1d(ends_a, ends_b)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        # The tokens of both sides in the order in which groups list them.
        order_a = np.arange(len(flat_a)) + np.searchsorted(group_b, group_a)
        order_b = np.arange(len(flat_b)) + np.searchsorted(group_a, group_b, "right")
        shown = np.empty(len(flat_a) + len(flat_b), object)
        shown[order_a], shown[order_b] = self.inside[flat_a], self.inside[flat_b]
        last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        shown[order_a[last_a]], shown[order_b[last_b]] = self.last_a[flat_a[last_a]], self.last_b[flat_b[last_b]]
        shown = shown.tolist()
        keys = pairs.astype("<i8").tobytes()
        cut = np.cumsum([len(x.encode()) for k in good for x in rows[k]])
        at_a, at_b, link_end, group_end = (
            [0, *np.searchsorted(x, cut, "right").tolist()] for x in (ends_a, ends_b, every, common)
        )
        entries = []
        for i in range(len(cut)):
            a0, a1, b0, b1, link, group = at_a[i], at_a[i + 1], at_b[i], at_b[i + 1], link_end[i], group_end[i]
            packed = a1 - a0 | b1 - b0 << 40 | group_end[i + 1] - group << 80
            entries.append(("".join(shown[a0 + b0 : a1 + b1])[:-1], keys[8 * link : 8 * link_end[i + 1]], packed))
        at = 0
        for k in good:
            out[k] = entries[at : at + len(rows[k])]
            at += len(rows[k])
        return out

    def differs(self, raw: list[bytes], ids_a: list[list[int]], b: list[list[tuple[int, int, int]]]) -> bool:
        """Whether the tokens of either side spell other bytes, in all or in any stretch."""
        spelled_a = [b"".join([self.bytes_a[i] for i in ids]) for ids in ids_a]
        return spelled_a != raw or [b"".join([self.bytes_b[t[0]] for t in x]) for x in b] != raw

    def parts(self, word: str) -> list[str]:
        """Stretches of a word that either tokenizer encodes on their own."""
        cut = PART.split(word)
        if len(cut) > 1:
            whole = [cut[0]]
            for x in cut[1:]:
                if whole[-1][-1] + x[0] in self.adjacent:
                    whole[-1] += x
                else:
                    whole.append(x)
            return whole
        return cut

    def documents(self, found: list[str]) -> list[tuple[str, bytes, int]]:
        """What ``fresh`` gives for a space and each text; texts without an alignment give nothing."""
        words = [WORD.split(" " + x) if x else [] for x in found]
        new = [w for w in set(chain.from_iterable(words)) if not self.met(w)]
        cut = [self.parts(w) for w in new]
        fresh = [x for x in set(chain.from_iterable(cut)) if not self.met(x)]
        known = self.words
        for at in range(0, len(fresh), 2048):
            known.update(zip(fresh[at : at + 2048], self.fresh(fresh[at : at + 2048])))
        known.update((w, joined([known[x] for x in some])) for w, some in zip(new, cut) if len(some) > 1)
        out = []
        for text, some in zip(found, words):
            entry = joined(list(map(known.__getitem__, some)))
            out.append(entry or self.fresh([" " + text])[0] or ("", b"", 0))
        for word in {*new, *fresh}:
            if len(word) > WORD_CHARS:
                del known[word]
        if len(known) > WORDS:
            self.older, self.words = known, {}
        return out

    def met(self, word: str) -> bool:
        if word not in self.words:
            if word not in self.older:
                return False
            self.words[word] = self.older[word]
        return True


def joined(entries: list) -> tuple[str, bytes, int] | None:
    """Entries of stretches that follow one another as one; None if any has none."""
    if not entries:
        return "", b"", 0
    if not all(entries):
        return None
    shown, keys, packed = zip(*entries)
    return ";".join(shown), b"".join(keys), sum(packed)


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def linked_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, groups: bool = False) -> DataFrame:
    """One row per document: sizes, digest, and its distinct id pairs with their occurrences.

    A pair's key is A id * size of B's vocabulary + B id. With ``groups`` the groups
    themselves come along as text. Null and empty texts have no tokens; other columns are
    left out, an empty table stays empty, and repeated rows are documents of their own.
    """
    path_a = path_a or public_tokenizers.path(MODEL_A)
    path_b = path_b or public_tokenizers.path(MODEL_B)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = aligner(path_a, path_b)
        for batch in small_batches(batches, 64):
            rows = []
            for shown, keys, packed in both.documents(batch["text"].tolist()):
                links = np.frombuffer(keys, "<i8")
                pairs, times = np.unique(links, return_counts=True)
                digest = hashlib.sha256(shown.encode()).hexdigest() if shown else ""
                low = (1 << 40) - 1
                row = (packed & low, packed >> 40 & low, packed >> 80, len(links), digest, pairs, times.astype("int32"))
                rows.append((*row, shown) if groups else row)
            names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"] + ["groups"] * groups
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    return texts(docs).mapInPandas(run, LINKED + (", groups string" if groups else ""))


def pair_counts(linked: DataFrame, n_b: int) -> DataFrame:
    """(pair, holders, best): in how many documents a pair is linked, and its A id's largest.

    Both aggregates combine before they shuffle; an A id has at most ``n_b`` partners.
    """
    held = linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("holders"))
    held = stage(held.withColumn("a", F.floor(F.col("pair") / F.lit(n_b)).cast("bigint")), "pairs")
    best = held.groupBy("a").agg(F.max("holders").alias("best"))
    return held.join(best, "a").select("pair", "holders", "best")


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Token alignment of every document with scores of its links from the whole corpus.

    n_best counts links whose pair is the commonest (or as common) of its A id; count_sum
    adds the counts of all links. Documents without tokens give zeros and an empty digest.
    """
    path_b = path_b or public_tokenizers.path(MODEL_B)
    n_b = aligner(path_a or public_tokenizers.path(MODEL_A), path_b).n_b
    numbered = linked_documents(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    linked = stage(numbered, "linked")
    counts = stage(pair_counts(linked, n_b), "counts")
    hot = counts.orderBy(F.col("holders").desc(), "pair").limit(HOT).toPandas().sort_values("pair")
    keys, holders, best = (hot[c].to_numpy("int64") for c in ("pair", "holders", "best"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            pairs = columns["pairs"].flatten().to_numpy()
            times = columns["times"].flatten().to_numpy().astype("int64")
            sizes = np.diff(columns["pairs"].offsets.to_numpy())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            known = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
            place, mine = place[known], owner[known]
            hits = np.zeros(len(sizes), "int64")
            total = np.zeros(len(sizes), "int64")
            np.add.at(hits, mine, np.where(holders[place] == best[place], times[known], 0))
            np.add.at(total, mine, holders[place] * times[known])
            rest = np.concatenate([[0], np.cumsum(np.bincount(owner[~known], minlength=len(sizes)))]).astype("int32")
            yield pa.RecordBatch.from_arrays(
                [
                    columns["row"],
                    pa.array(hits),
                    pa.array(total),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(pairs[~known])),
                    pa.ListArray.from_arrays(pa.array(rest), pa.array(times[~known].astype("int32"))),
                ],
                ["row", "n_best", "count_sum", "pairs", "times"],
            )

    kind = "row bigint, n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>"
    scored = stage(linked.select("row", "pairs", "times").mapInArrow(look_up, kind), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    added = (
        rare.join(counts.withColumnRenamed("pair", "pairs"), "pairs")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("holders") == F.col("best"), F.col("times").cast("bigint")).otherwise(0)).alias("n_best"),
            F.sum(F.col("holders") * F.col("times")).alias("count_sum"),
        )
    )
    sums = scored.select("row", "n_best", "count_sum").unionByName(added).groupBy("row")
    sums = sums.agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return linked.drop("pairs", "times").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of byte_bpe_50k.json and piece_bpe_32k.model over all documents."""
    return align_documents(read(spark, sf_dir, "documents"))
