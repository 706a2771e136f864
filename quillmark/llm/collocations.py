"""Phrases whose words keep company, from an FM-index per shard over word ids.

A shard is a stretch of pieces of one language, as numbers of words with a separator
between pieces. Its index sorts the places of the stretch by the next ``depth`` words (and
those of the reversed stretch by the words before); the words in front of the sorted places
are its transform. An interval of places that start with a phrase is extended by a word on
either side with ranks alone, both directions staying in step, and its length is the
phrase's count. Counts are summed across shards.

A phrase can only be common if all its parts are. Shards therefore go through a round for
each length: single words; pairs of common words; then phrases inside runs of common ones
that are shorter by a word. Between rounds each shard gets back which of its own entries
are common in the whole language and keeps only what can still matter, so neither a
vocabulary nor a phrase table is ever broadcast. Summing left and right extensions gives
for every phrase the count of the commonest phrase that is one word longer, which decides
whether it lies in a longer one: if it does, it also lies in one that is longer by a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.llm.common import read, stage
from quillmark.sources.staging import new_folder

LONGEST = 5
#: A phrase is a candidate from this count on, and goes if a longer one holds this percentage of it.
LEAST, CONTAINED = 100, 100
TOP = 2000
#: Words after which a shard is full; a single piece is never cut.
SHARD = 1 << 20
#: Ends of pieces become the byte 0xFF, which no text holds; tabs become spaces; A-Z lower case.
_BYTES = bytearray(range(256))
for _b in b".,;:!?\n\x0b\x0c\r":
    _BYTES[_b] = 0xFF
_BYTES[9] = 32
_BYTES[65:91] = range(97, 123)
_TABLE = bytes(_BYTES)
SHARDS = "lang string, n_words bigint, text binary, words array<string>, counts array<bigint>"


class Numbers(dict):
    """Numbers words as they are met; the separator is 0."""

    def __init__(self):
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Index:
    """FM-index of a text of whole numbers in which 0 separates; 0 must be its last.

    Places are sorted by their first ``depth`` numbers, which is enough for phrases of up
    to that length. A state holds for phrases of one length their interval in the forward
    order (``lo``), in the order of the reversed text (``back``), and their count.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = np.asarray(text, "int64"), depth
        self.kinds = int(self.text.max(initial=0)) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=self.kinds))])
        self._sides: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

    def side(self, reverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """The transform and its rank mapping, of the text or of the reversed text."""
        if reverse not in self._sides:
            # The reversed text keeps its separator at the end.
            text = np.roll(self.text[::-1], -1) if reverse else self.text
            key, width = text, 1
            while width < self.depth:
                if width > 1:
                    key = np.unique(key, return_inverse=True)[1]
                step = min(width, self.depth - width)
                key = key * (int(key.max(initial=0)) + 1) + np.roll(key, -step)
                width += step
            places = np.argsort(key, kind="stable")
            ahead = text[places - 1].astype("int32")
            ranks = np.empty(len(text), "int32")
            ranks[np.argsort(ahead, kind="stable")] = np.arange(len(text), dtype="int32")
            self._sides[reverse] = ahead, ranks
        return self._sides[reverse]

    def words(self) -> dict[str, np.ndarray]:
        """The state of all single words."""
        lo = self.first[1:-1]
        return {"phrase": np.arange(1, self.kinds)[:, None], "lo": lo, "back": lo, "count": np.diff(self.first)[1:]}

    def extended(self, state: dict[str, np.ndarray], left: bool) -> dict[str, np.ndarray]:
        """All phrases that are longer by one word on the given side."""
        ahead, ranks = self.side(not left)
        near, far = ("lo", "back") if left else ("back", "lo")
        count = state["count"]
        owner = np.repeat(np.arange(len(count)), count)
        begin = np.cumsum(count) - count
        rows = np.arange(len(owner)) + np.repeat(state[near] - begin, count)
        key = owner * self.kinds + ahead[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        size = np.diff(np.append(start, len(key)))
        parent, word = key[start] // self.kinds, key[start] % self.kinds
        kept = word > 0
        start, size, parent, word = start[kept], size[kept], parent[kept], word[kept]
        sides = (word[:, None], state["phrase"][parent]) if left else (state["phrase"][parent], word[:, None])
        return {
            "phrase": np.concatenate(sides, axis=1),
            near: ranks[rows[order[start]]],
            # The other order splits the parent's interval by words in ascending order.
            far: state[far][parent] + start - begin[parent],
            "count": size,
        }


def runs(text: np.ndarray, joined: np.ndarray, least: int) -> np.ndarray:
    """The text without words outside runs of ``least`` words; ``joined`` links a place with the next.

    Runs end in a separator; a text without any is one separator.
    """
    # A run starts at a word that the place in front does not link to.
    word = text > 0
    linked = np.concatenate([[False], joined[:-1] & word[:-1] & word[1:]])
    number = np.cumsum(~linked) - 1
    kept = word & (np.bincount(number)[number] >= least)
    if not kept.any():
        return np.zeros(1, "int64")
    places = np.flatnonzero(kept)
    new = np.concatenate([number[places][1:] != number[places][:-1], [True]])
    at = np.arange(len(places)) + np.concatenate([[0], np.cumsum(new)[:-1]])
    out = np.zeros(len(places) + int(new.sum()), "int64")
    out[at] = text[places]
    return out


def stage_small(df: DataFrame, name: str) -> DataFrame:
    """A stage table packed tighter, since shards are written once for each round."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def shards(docs: DataFrame) -> DataFrame:
    """(lang, n_words, text, words, counts): numbered words and how often each occurs."""

    def packed(lang: str, numbers: Numbers, parts: list[np.ndarray]) -> dict:
        text = np.concatenate(parts)
        counts = np.bincount(text, minlength=len(numbers))[1:]
        words = [w.decode() for w in list(numbers)[1:]]
        return {
            "lang": lang, "n_words": int(counts.sum()), "text": text.astype("<i4").tobytes(), "words": words, "counts": counts
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
        for batch in batches:
            for lang, found in batch.groupby("lang", sort=True)["text"]:
                for at in range(0, len(found), 64):
                    numbers, parts = held.setdefault(lang, (Numbers(), []))
                    raw = "\n".join([*found.iloc[at : at + 64], ""]).encode()
                    listed = raw.translate(_TABLE).replace(b"\xff", b" \xff ").split()
                    parts.append(np.fromiter(map(numbers.__getitem__, listed), "int32", len(listed)))
                    if sum(map(len, parts)) >= SHARD:
                        yield pd.DataFrame([packed(lang, *held.pop(lang))])
        for lang, (numbers, parts) in held.items():
            yield pd.DataFrame([packed(lang, numbers, parts)])

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, SHARDS)


def dense(df: DataFrame, name: str) -> DataFrame:
    """A written table with numbers from 1 on without gaps: places in a task behind those of earlier tasks."""
    df = stage(df, name)
    df = stage(df.withColumn("id", F.monotonically_increasing_id()), name)
    task, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    before, offsets = 1, {}
    for r in df.groupBy(task.alias("task")).count().orderBy("task").collect():  # one row for each task
        offsets[r.task], before = before, before + r["count"]
    if before >= 1 << 31:
        raise ValueError("more than 2^31 common words")
    starts = df.sparkSession.createDataFrame(list(offsets.items()), "task bigint, start bigint")
    numbered = df.withColumn("task", task).withColumn("place", place).join(F.broadcast(starts), "task")
    return stage(numbered.withColumn("id", F.col("start") + F.col("place")).drop("task", "place", "start"), name)


def counted(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n), common words (lang, word, f, id) and common phrases (ids, f) up to LONGEST words."""
    first = stage_small(shards(docs).withColumn("shard", F.monotonically_increasing_id()), "shards")
    totals = first.groupBy("lang").agg(F.sum("n_words").alias("n"))
    entries = first.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x")).select(
        "shard", "lang", "place", F.col("x.words").alias("word"), F.col("x.counts").alias("count")
    )
    words = entries.groupBy("lang", "word").agg(F.sum("count").alias("f")).where(F.col("f") >= least)
    words = dense(words, "words")
    common = entries.select("shard", "lang", "place", "word").join(words, ["lang", "word"])

    def pairs(shard: pd.DataFrame, common: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(common):
            return pd.DataFrame(columns=["shard", "text", "codes", "counts"])
        text = np.frombuffer(shard["text"][0], "<i4")
        # Common words are numbered anew in the order of their ids.
        common = common.sort_values("id")
        ids = np.concatenate([[0], common["id"]])
        renumbered = np.zeros(len(shard["words"][0]) + 1, "int64")
        renumbered[common["place"].to_numpy() + 1] = np.arange(1, len(ids))
        text = runs(renumbered[text], np.ones(len(text), bool), 2)
        index = Index(text, 2)
        found = index.extended(index.words(), left=False)
        codes = ids[found["phrase"][:, 0]] << 32 | ids[found["phrase"][:, 1]]
        return pd.DataFrame(
            {"shard": shard["shard"], "text": [ids[text].astype("<i4").tobytes()], "codes": [codes], "counts": [found["count"]]}
        )

    kind = "shard bigint, text binary, codes array<bigint>, counts array<bigint>"
    second = first.select("shard", "text", "words").groupBy("shard").cogroup(
        common.select(F.col("shard").alias("home"), "place", "id").groupBy("home")
    )
    second = stage_small(second.applyInPandas(pairs, kind), "pairs")
    entries = second.select("shard", F.explode(F.arrays_zip("codes", "counts")).alias("x"))
    # A shard holds a pair once, so no key has more rows than there are shards.
    total = F.sum("count").over(Window.partitionBy("code"))
    entries = entries.select("shard", F.col("x.codes").alias("code"), F.col("x.counts").alias("count"))
    common_pairs = stage_small(entries.withColumn("f", total).where(F.col("f") >= least).select("shard", "code", "f"), "common")

    high, low = F.shiftright("code", 32).cast("int"), F.col("code").bitwiseAND((1 << 32) - 1).cast("int")
    common = common_pairs.select("shard", high.alias("w1"), low.alias("w2"), "f")
    texts, phrases = second.select("shard", "text"), []
    for size in range(2, LONGEST + 1):
        if size > 2:
            texts, common = longer(texts, common, size, least)
        names = [f"w{k}" for k in range(1, size + 1)]
        ids = F.array(*[F.col(w).cast("bigint") for w in names]).alias("ids")
        phrases.append(common.select(*names, "f").distinct().select(ids, "f"))
    every = phrases[0]
    for more in phrases[1:]:
        every = every.unionByName(more)
    return totals, words, stage(every, "phrases")


def members(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which rows of one matrix are rows of another."""
    both = np.concatenate([grams, common])
    code = both[:, 0]
    for k in range(1, both.shape[1]):
        code = np.unique(code, return_inverse=True)[1] * (int(both[:, k].max(initial=0)) + 1) + both[:, k]
    return np.isin(code[: len(grams)], code[len(grams) :])


def longer(texts: DataFrame, common: DataFrame, size: int, least: int) -> tuple[DataFrame, DataFrame]:
    """What is left of each shard, and its phrases of ``size`` words that are common.

    A phrase is counted only if both its parts that are shorter by a word are common.
    """
    shorter = [f"w{k}" for k in range(1, size)]
    names = [*shorter, f"w{size}"]

    def count(shard: pd.DataFrame, common: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(common):
            return pd.DataFrame(columns=["shard", "text", *names, "counts"])
        text = np.frombuffer(shard["text"][0], "<i4").astype("int64")
        known = common[shorter].to_numpy("int64")
        here = members(np.stack([np.roll(text, -k) for k in range(size - 1)], axis=1), known)
        # Neighbours are linked if a common phrase covers both.
        linked = here.copy()
        for k in range(1, size - 2):
            linked[k:] |= here[:-k]
        text = runs(text, linked, size)
        ids, numbers = np.unique(np.append(text, 0), return_inverse=True)
        index = Index(numbers, size)
        state, left = index.words(), False
        while state["phrase"].shape[1] < size:
            state, left = index.extended(state, left), not left
        grams = ids[state["phrase"]]
        kept = members(grams[:, :-1], known) & members(grams[:, 1:], known)
        columns = {w: [grams[kept, k].astype("i4")] for k, w in enumerate(names)}
        packed = text.astype("<i4").tobytes()
        return pd.DataFrame({"shard": shard["shard"], "text": [packed], **columns, "counts": [state["count"][kept]]})

    kind = "shard bigint, text binary, " + "".join(f"{w} array<int>, " for w in names) + "counts array<bigint>"
    found = texts.groupBy("shard").cogroup(common.select("shard", *shorter).groupBy("shard")).applyInPandas(count, kind)
    found = stage_small(found, "longer")
    entries = found.select("shard", F.explode(F.arrays_zip(*names, "counts")).alias("x")).select("shard", "x.*")
    entries = entries.withColumn("f", F.sum("counts").over(Window.partitionBy(*names)))
    common = stage_small(entries.where(F.col("f") >= least).select("shard", *names, "f"), "common")
    return found.select("shard", "text"), common


#: floor(1000 * a * n / (l * r)) in whole numbers of up to 38 digits.
SCORE = """
    CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(15, 0)) * CAST(1000 AS DECIMAL(4, 0))
    div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))
"""


def mine_phrases(docs: DataFrame, least: int = LEAST, contained: int = CONTAINED, top: int = TOP) -> DataFrame:
    """The best phrases of each language with counts, score and rank.

    Rows without a language count as ``und``, null texts as empty; repeated rows count each
    time; an empty table has no phrases; other columns are left out. Ties in score go to
    the higher count, then to the phrase that is less in UTF-8.
    """
    totals, words, phrases = counted(docs, least)
    longer = phrases.where(F.size("ids") > 2)
    inside = longer.select(F.expr("slice(ids, 1, size(ids) - 1)").alias("ids"), "f").unionByName(
        longer.select(F.expr("slice(ids, 2, size(ids) - 1)").alias("ids"), "f")
    )
    inside = inside.groupBy("ids").agg(F.max("f").alias("most"))
    kept = phrases.join(inside, "ids", "left").where(F.expr(f"most IS NULL OR 100 * most < {contained} * f")).select("ids", F.col("f").alias("a"))
    kept = stage(kept.withColumn("phrase_id", F.monotonically_increasing_id()), "kept")
    parts = words.select(F.array("id").alias("part"), "f").unionByName(phrases.select(F.col("ids").alias("part"), "f"))
    cuts = kept.select("phrase_id", "ids", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.select(
        "phrase_id", "k", F.expr("slice(ids, 1, k)").alias("head"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("tail")
    )
    cuts = cuts.join(parts.select(F.col("part").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(parts.select(F.col("part").alias("tail"), F.col("f").alias("r")), "tail")
    spelled = (
        kept.select("phrase_id", F.posexplode("ids").alias("place", "id"))
        .join(words.select("id", "lang", "word"), "id")
        .groupBy("phrase_id")
        .agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("x"))
        .select("phrase_id", "lang", F.array_join("x.word", " ").alias("phrase"))
    )
    rows = kept.select("phrase_id", "a").join(spelled, "phrase_id").join(totals, "lang")
    scored = rows.join(cuts.select("phrase_id", "k", "l", "r"), "phrase_id")
    scored = scored.withColumn("score", F.expr(SCORE))
    scored = scored.groupBy("phrase_id", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    best = scored.select("lang", "phrase", "a", "n", "x.l", "x.r", "x.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of documents."""
    return mine_phrases(read(spark, sf_dir, "documents"))


#: Counts every phrase by joining each word with the four behind it in its piece.
ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), p AS (
    SELECT doc, lang, generate_subscripts(x, 1) AS piece, unnest(x) AS text
    FROM (SELECT doc, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') AS x FROM d)
), w AS (
    SELECT doc, lang, piece, generate_subscripts(x, 1) AS place, unnest(x) AS w1
    FROM (SELECT doc, lang, piece, list_filter(regexp_split_to_array(text, '[\x20\x09]+'), lambda v: v <> '') AS x FROM p)
), r AS (
    SELECT lang, w1, lead(w1, 1) OVER t AS w2, lead(w1, 2) OVER t AS w3, lead(w1, 3) OVER t AS w4, lead(w1, 4) OVER t AS w5
    FROM w WINDOW t AS (PARTITION BY doc, piece ORDER BY place)
), g AS (
    SELECT lang, [w1] AS g FROM r
    UNION ALL SELECT lang, [w1, w2] FROM r WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3] FROM r WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4] FROM r WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4, w5] FROM r WHERE w5 IS NOT NULL
), f AS (
    SELECT lang, g, len(g) AS size, count(*) AS f FROM g GROUP BY lang, g HAVING count(*) >= 100
), n AS (
    SELECT lang, count(*) AS n FROM w GROUP BY lang
), kept AS (
    SELECT * FROM f AS a WHERE size > 1 AND NOT EXISTS (
        SELECT 1 FROM (
            SELECT lang, list_slice(g, i, i + k - 1) AS part, max(f) AS f
            FROM f, range(2, 5) AS s(k), range(1, 5) AS t(i) WHERE k < size AND i + k - 1 <= size GROUP BY ALL
        ) AS b WHERE b.lang = a.lang AND b.part = a.g AND 100 * b.f >= 100 * a.f
    )
), cuts AS (
    SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, n.n,
        1000::HUGEINT * c.f * n.n // (l.f::HUGEINT * r.f) AS score
    FROM kept AS c, range(1, 5) AS s(k), f AS l, f AS r, n
    WHERE k < c.size AND l.lang = c.lang AND l.g = list_slice(c.g, 1, k)
        AND r.lang = c.lang AND r.g = list_slice(c.g, k + 1, c.size) AND n.lang = c.lang
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
    array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""
