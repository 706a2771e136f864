"""Best-fit packing of token sequences by a configuration linear program.

The program has one variable per pattern (a multiset of lengths that fits a sequence)
and one covering row per length. It is solved by multiplicative weights: each step prices
lengths, finds the best pattern by an unbounded-knapsack dynamic program over the
capacity, and lowers the price of what the patterns bought cover; the prices also bound
the number of sequences from below. Patterns are then rounded down against the histogram;
what remains is priced again and, once it is small, put into the fullest sequence it fits.

Only the histogram (at most ``capacity`` rows) and the plan reach the driver. Patterns
are counted, not listed, so the plan does not grow with the pieces. Pieces find their place by their rank within their
length, counted per partition and summed over partitions.
"""

from __future__ import annotations

import json
import math
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import small_batches, stage, texts
from quillmark.llm.word_cache import WordCache

CAPACITY = 2048
END = 0
PATIENCE = 40
VOCABULARY = "byte_bpe_50k.json"
PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, row bigint"
)
_WORKERS: dict[str, ByteBpe] = {}


class ByteBpe:
    """Ids of whole texts, word by word.

    The vocabulary's pattern never joins a space and the word behind it to what stands
    before, so texts fall apart in front of every space that a visible character follows.
    Words met before are looked up. The merge ranks are read from the tokenizer's own
    file and applied by tiktoken, which gives the same ids at a fraction of the time.
    """

    def __init__(self, path: str):
        self.encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={}
        )
        self.piece = self.encoding._core_bpe.encode_single_piece
        self.inner = WordCache(self.word)
        self.first = WordCache(self.ids)

    def word(self, word: str) -> bytes:
        """Ids of a space and the word; letters with a stop or comma need no pattern."""
        if not word or word[0].isspace():
            return _JOINED
        letters = word.rstrip(".,")
        if not letters.isalpha():
            return self.ids(" " + word)
        found = self.piece((" " + letters).encode())
        if len(letters) < len(word):
            found += self.piece(word[len(letters) :].encode())
        return array("I", found).tobytes()

    def ids(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        first, *words = text.split(" ")
        parts = list(map(self.inner.__getitem__, words))
        if _JOINED in parts:
            return self.ids(text)
        return b"".join((self.first[first], *parts))

    def turn(self) -> None:
        self.inner.turn()
        self.first.turn()


#: Stands for a part that begins with white space and so belongs to the part before it.
_JOINED = b"joined"


def ranks(path: str) -> dict[bytes, int]:
    """Bytes of each token of a byte-level BPE tokenizer file, without added tokens."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    added = {x["content"] for x in data["added_tokens"]}
    return {bytes(map(byte.__getitem__, t)): i for t, i in data["model"]["vocab"].items() if t not in added}


def _encoder(path: str) -> ByteBpe:
    if path not in _WORKERS:
        _WORKERS[path] = ByteBpe(path)
    return _WORKERS[path]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be short."""
    first = length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END
) -> DataFrame:
    """One row per piece, with the partition and place it was made in.

    Null and empty texts give one piece that holds the end id alone. Repeated rows are
    documents of their own. Other columns are ignored.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder, row, part = _encoder(path), 0, TaskContext.get().partitionId()
        for batch in small_batches(batches):
            out = []
            encoder.turn()
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.encode(text) + last
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc_id, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), part, row))
                    row += 1
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "row"])
            yield frame.astype({"doc_id": "Int64"})

    return texts(docs).mapInPandas(run, PIECES)


# ---------------------------------------------------------------- the linear program


def price_patterns(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming over the capacity: (value, taken).

    ``taken[c]`` is a length that an optimal multiset for capacity c holds, 0 if there is
    none; ``value[c]`` is what that multiset is worth.
    """
    lengths = np.flatnonzero(price > 0)
    gain, ends = price[lengths], np.searchsorted(lengths, np.arange(capacity + 1), "right")
    value = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, int)
    waste = np.zeros(capacity + 1, int)
    for c in range(1, capacity + 1):
        n = ends[c]
        value[c], taken[c], waste[c] = value[c - 1], taken[c - 1], waste[c - 1] + 1
        if n:
            total = value[c - lengths[:n]]
            total += gain[:n]
            k = total.argmax()
            if total[k] > value[c]:
                value[c], taken[c], waste[c] = total[k], lengths[k], 0
    return value, np.stack([taken, waste])


def pattern_with(length: int, taken: np.ndarray) -> dict[int, int]:
    """The best pattern that holds ``length``: counts by length."""
    first, waste = taken
    counts, c = {length: 1}, len(first) - 1 - length
    while first[c]:
        l = int(first[c])
        counts[l] = counts.get(l, 0) + 1
        c -= int(waste[c]) + l
    return counts


@dataclass
class Solution:
    """Of the configuration program: patterns with their uses, prices, and both values."""

    patterns: list[tuple[dict[int, int], float]]
    price: np.ndarray
    primal: float
    dual: float


def solve(
    stock: np.ndarray, capacity: int, upper: float = math.inf, steps: int = 240, width: float = 0.5, slack: float = 0.001, gap: float = 0.0004
) -> Solution:
    """The configuration program by multiplicative weights.

    Prices start at the lengths, which is the optimum where all space can be filled. A
    step prices patterns by one dynamic program, buys those within ``slack`` of the best
    value until each length is covered at most once, and multiplies the price of a length
    by ``exp(-rate * covered share)``; nothing is taken back, so prices move as far as
    they have to. ``rate`` falls from ``width`` on with the root of the steps. ``dual`` is
    the best bound that any step's prices give. Patterns are averaged over the second
    half of the steps; ``primal`` is their number if every length is covered once. It
    ends early when both are ``gap`` apart, or ``dual`` that near to ``upper``, the number
    of sequences of a plan that is known already; also when the bound has not risen for
    ``PATIENCE`` steps and that plan is within half a percent of it.
    """
    lengths = np.arange(len(stock))
    live = stock > 0
    price = np.where(live, lengths / capacity, 0.0)
    covered, spent, dual, best_price = np.zeros(len(stock)), 0.0, 0.0, price
    bought: dict[tuple, list] = {}
    primal, gained = math.inf, 0
    for step in range(steps):
        if step in (steps // 8, steps // 2):  # what early prices bought is no part of the average
            covered, spent, bought = np.zeros(len(stock)), 0.0, {}
        value, taken = price_patterns(price, capacity)
        bound = float(stock @ price / value[capacity])
        if bound > dual * (1 + gap):
            gained = step
        if bound > dual:
            dual, best_price = bound, price / value[capacity]
        worth = np.where(live, price + value[capacity - np.minimum(lengths, capacity)], 0.0)
        got = np.zeros(len(stock))
        for l in np.argsort(-worth, kind="stable"):
            if worth[l] < (1 - slack) * value[capacity] or not live[l]:
                break
            counts = pattern_with(int(l), taken)
            times = min((stock[j] - got[j]) / n for j, n in counts.items())
            if times > 1e-9:
                for j, n in counts.items():
                    got[j] += n * times
                spent += times
                bought.setdefault(tuple(sorted(counts.items())), [counts, 0.0])[1] += times
        covered += got
        price = np.where(live, price * np.exp(-width / math.sqrt(1 + step) * got / np.maximum(stock, 1)), 0.0)
        price = price / price.max()
        least = (covered[live] / stock[live]).min()
        if least > 0:
            primal = spent / least
        if min(primal, upper) <= dual * (1 + gap) or (step - gained > PATIENCE and upper <= dual * 1.005):
            break
    middle = float(np.average(covered[live] / stock[live], weights=stock[live])) or 1.0
    return Solution([(c, t / middle) for c, t in bought.values()], best_price, primal, dual)


def buy(stock: np.ndarray, capacity: int, price: np.ndarray, steps: int, pace: float = 0.3, rate: float = 0.002) -> list[tuple[dict[int, int], float]]:
    """Patterns for all of the stock near the given prices, each with how often to use it.

    A few steps of the same weights: each buys, for every length from the least covered
    on, the best pattern that holds it, for at most ``pace`` of what it still lacks.
    """
    covered = np.zeros(len(stock))
    bought: dict[tuple, list] = {}
    for _ in range(steps):
        share = covered / np.maximum(stock, 1)
        live = (stock > 0) & (share < 0.999)
        if not live.any():
            break
        _, taken = price_patterns(np.where(live, price * np.exp(-rate * share), 0.0), capacity)
        for l in sorted(np.flatnonzero(live), key=lambda l: (share[l], -l)):
            counts = pattern_with(int(l), taken)
            times = min((stock[j] - covered[j]) / n * (pace if j == l else 1.0) for j, n in counts.items())
            if times > 0:
                for j, n in counts.items():
                    covered[j] += n * times
                bought.setdefault(tuple(sorted(counts.items())), [counts, 0.0])[1] += times
    return [(counts, times) for counts, times in bought.values()]


def best_fit(stock: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first: (counts by length, number of sequences).

    Sequences with the same content are one group, and pieces of one length fill a group
    at once: the fullest sequence that a piece fits stays the fullest for the next one
    until it is full. So the work grows with the lengths, not with the pieces.
    """
    room: list[list[tuple[dict[int, int], int]]] = [[] for _ in range(capacity + 1)]
    room[capacity].append(({}, int(stock.sum())))
    filled = 1 << capacity  # bit r: there is a group with room r
    for l in range(len(stock) - 1, 0, -1):
        left = int(stock[l])
        while left:
            fitting = filled >> l
            r = l + (fitting & -fitting).bit_length() - 1
            counts, n = room[r].pop()
            each = min(r // l, left)
            used = min(n, left // each)
            if n > used:
                room[r].append((counts, n - used))
            if not room[r]:
                filled ^= 1 << r
            room[r - each * l].append(({**counts, l: each}, used))
            filled |= 1 << (r - each * l)
            left -= each * used
    return [(counts, n) for groups in room for counts, n in groups if counts]


def place(stock: np.ndarray, patterns: list[tuple[dict[int, int], float]]) -> list[tuple[dict[int, int], int]]:
    """Patterns rounded down against the stock, which shrinks by what they hold."""
    out = []
    for counts, times in sorted(patterns, key=lambda p: -p[1]):
        n = min([int(times + 1e-9), *(int(stock[j] // k) for j, k in counts.items())])
        if n > 0:
            out.append((counts, n))
            for j, k in counts.items():
                stock[j] -= n * k
    return out


def round_down(stock: np.ndarray, capacity: int, price: np.ndarray, steps: int, small: int) -> list[tuple[dict[int, int], int]]:
    """All of the stock at the given prices: rounds of buying and rounding down, then best fit.

    Rounds go on while more than ``small`` pieces are left and one places a third of them.
    """
    out: list[tuple[dict[int, int], int]] = []
    while stock.sum() > small:
        before = stock.sum()
        out += place(stock, buy(stock, capacity, price, steps))
        if stock.sum() > 0.7 * before:
            break
    return out + best_fit(stock, capacity)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = 12, small: int = 4000) -> list[tuple[dict[int, int], int]]:
    """(counts by length, number of sequences) that use up the histogram exactly.

    The solution of the program is rounded in two ways, by its patterns and by its prices
    alone, and so are prices left at the lengths, where its steps start. The plan with the
    fewest sequences is taken, never more than best fit makes.
    """
    stock = np.zeros(capacity + 1, np.int64)
    for l, n in histogram.items():
        stock[l] = n
    full = [({capacity: 1}, int(stock[capacity]))] if stock[capacity] else []
    stock[capacity] = 0
    number = lambda chosen: sum(n for _, n in chosen)
    lengths = np.arange(capacity + 1) / capacity
    plans = [best_fit(stock, capacity)]
    # Nothing can be gained where best fit meets the bound of the lengths.
    if number(plans[0]) > math.ceil(stock @ lengths):
        plans.append(round_down(stock.copy(), capacity, lengths, steps, small))
        found = solve(stock, capacity, min(map(number, plans)))
        if min(map(number, plans)) > found.dual * 1.0004:
            plans.append(round_down(stock.copy(), capacity, found.price, steps, small))
            rest = stock.copy()
            placed = place(rest, found.patterns)
            plans.append(placed + round_down(rest, capacity, found.price, steps, small))
    return full + min(plans, key=number)


def places(chosen: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """The plan by length: ranks from ``base`` on, ``each`` per sequence, go to ``sequence`` on."""
    rows, used, sequence = [], {}, 0
    for counts, n in chosen:
        offset = 0
        for l, each in sorted(counts.items(), reverse=True):
            base = used.get(l, 0)
            rows.append((l, base, each, sequence, offset))
            used[l] = base + each * n
            offset += l * each
        sequence += n
    return pd.DataFrame(rows, columns=["length", "base", "each", "sequence", "offset"])


def ranked(staged: DataFrame) -> DataFrame:
    """Adds ``rank``: the place among all pieces of the same length, from 0.

    Ranks are counted within (part, length); a part is one task's output, so no group is
    larger than that, whatever a length's share of all rows.
    """
    within = Window.partitionBy("part", "length").orderBy("row")
    counts = staged.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (
        staged.withColumn("local", F.row_number().over(within) - 1)
        .join(bases, ["part", "length"])
        .withColumn("rank", F.col("base") + F.col("local"))
        .drop("base", "local")
    )


def pack(staged: DataFrame, capacity: int = CAPACITY, steps: int = 12) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to staged pieces. An empty table stays empty."""
    histogram = {r.length: r.n for r in staged.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(plan(histogram, capacity, steps)).sort_values(["length", "base"])
    by_length = {int(l): g[["base", "each", "sequence", "offset"]].to_numpy(np.int64) for l, g in table.groupby("length")}
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for l in np.unique(length):
                own, rows = by_length[int(l)], length == l
                line = own[np.searchsorted(own[:, 0], rank[rows], "right") - 1]
                step = rank[rows] - line[:, 0]
                sequence[rows] = line[:, 2] + step // line[:, 1]
                offset[rows] = line[:, 3] + step % line[:, 1] * l
            yield batch.assign(sequence_id=sequence, offset=offset).astype({"doc_id": "Int64"})[
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            ]

    return ranked(staged).mapInPandas(run, schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack whole documents."""
    return pack(stage(pieces(docs, path, capacity), "pieces"), capacity)
