"""Near-duplicates by circulant MinHash, with every link confirmed on full sets.

Two permutations are enough. The first (a hash) places each shingle on a circle; the
second is a table around that circle. Coordinate k of the signature is the least table
entry over the places of a document's shingles moved on by k, so the entries a shingle
needs lie next to each other in memory.

32 bands of 4 coordinates miss a pair at similarity 0.75 with a chance of about 5e-6.
Documents of equal sets are one node. In each bucket all nodes are first compared with
its least node. What is then still in different components of one bucket is compared in
cells of a bounded size: all pairs whose signatures agree in at least ``LIKELY`` of 128
coordinates (at similarity 0.75 fewer agree with a chance of about 2e-5) are confirmed inside
the cell, and it returns only links that join its components. So components that have a link
are joined, and pairs are never rows, whether they are linked or not.
Candidates are confirmed exactly: 100 * intersection >= 75 * union.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.common import small_batches, stage, texts
from quillmark.llm.components import components
from quillmark.llm.word_cache import WordCache

WORDS = 5
PERCENT = 75
BANDS, ROWS = 32, 4
CIRCLE = 1 << 20
LIKELY = 76
#: Nodes of a block, about; two blocks meet in a cell.
CELL = 512
#: Pairs confirmed in one cell, about.
PAIRS = 2048
#: Holds the key of a row beside any columns of its own.
_KEY = "__text_key"
#: A character that stands in a word.
WORD = "[^\\x20\\x09-\\x0D]"
SIGNED = "doc_id bigint, text_key bigint, n_shingles bigint, node binary, bands array<bigint>, coordinates binary"
#: About 10 MB in both generations.
_CACHE = WordCache(lambda w: xxhash.xxh3_64_intdigest(w), 50_000)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z count as a-z.

    A text of fewer words is one shingle; a text without words has none.
    """
    split = text.encode().lower().split()
    if not split:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_CACHE.__getitem__, split), np.uint64, len(split))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), np.uint64)
    for k in range(min(words, len(h))):
        out = (out ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _table() -> np.ndarray:
    ring = np.random.default_rng(20).permutation(CIRCLE).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[: BANDS * ROWS]]), BANDS * ROWS)


_RING: list[np.ndarray] = []


def signature(hashes: np.ndarray) -> np.ndarray:
    """The coordinates of a set that is not empty."""
    if not _RING:
        _RING.append(_table())
    places = ((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)
    least = np.full(BANDS * ROWS, CIRCLE, np.int32)
    for at in range(0, len(places), 4096):
        np.minimum(least, _RING[0][places[at : at + 4096]].min(axis=0), out=least)
    return least


def _band_keys(coordinates: np.ndarray) -> np.ndarray:
    out = np.zeros(BANDS, np.uint64)
    for column in coordinates.reshape(BANDS, ROWS).T.astype(np.uint64):
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def text_key() -> Column:
    """Tells rows of one id apart by their texts; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def signed(docs: DataFrame) -> DataFrame:
    """Set size, node (digest of the set) and band keys of each row.

    Null, empty and blank texts have no node and no bands.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches):
            _CACHE.turn()
            sets = [shingles(x) for x in batch["text"]]
            least = [signature(s) if len(s) else None for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "text_key": batch["text_key"],
                    "n_shingles": [len(s) for s in sets],
                    "node": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "bands": [_band_keys(x) if x is not None else [] for x in least],
                    "coordinates": [x.tobytes() if x is not None else None for x in least],
                }
            )

    return texts(docs).withColumn("text_key", text_key()).mapInPandas(run, SIGNED)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar; ``pairs`` is a stored table.

    Pairs are dealt into cells by a block of either side. A text goes once to each cell
    that holds one of its pairs, not once for each pair, so a family of n texts that are
    all compared moves about n times the square root of its pairs over ``PAIRS`` texts.
    ``nodes`` names a document of each node; where an id is repeated, the text with the
    node's digest counts.
    """
    side = max(1, math.ceil(math.sqrt(pairs.count() / PAIRS)))
    block = lambda name: F.pmod(F.xxhash64(name), F.lit(side))
    cells = pairs.select((block("a") * side + block("b")).alias("cell"), "a", "b")
    home = F.col("cell").alias("home")
    members = cells.select(home, F.col("a").alias("node")).unionByName(cells.select(home, F.col("b").alias("node"))).distinct()
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    own = texts(docs).join(wanted, "doc_id").select("node", "text")
    there = members.join(own, "node").select("home", "node", "text")

    def run(pairs: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        _CACHE.turn()
        sets = {}
        for node, text in zip(there["node"], there["text"]):
            found = shingles(text)
            if xxhash.xxh3_128_digest(found.tobytes()) == node:
                sets[node] = found
        out = [(a, b) for a, b in zip(pairs["a"], pairs["b"]) if a in sets and b in sets and similar(sets[a], sets[b], percent)]
        return pd.DataFrame(out, columns=["a", "b"])

    return cells.groupBy("cell").cogroup(there.groupBy("home")).applyInPandas(run, "a binary, b binary")


def cells(placed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, component, band, cell, block, n_shingles, coordinates) of the buckets that hold several components.

    Buckets are dealt in blocks, and each two blocks meet in a cell of their own, so no task
    holds a whole bucket.
    """
    label = F.coalesce("component", F.col("node"))
    labelled = placed.join(labels, "node", "left").withColumn("component", label)
    mixed = (
        labelled.groupBy("band", "key")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
        .where("x != y")
        .select("band", "key", F.ceil(F.col("n") / CELL).cast("int").alias("g"))
    )
    block = F.pmod(F.xxhash64("node"), F.col("g")).cast("int")
    rows = labelled.join(mixed, ["band", "key"]).withColumn("block", block)
    # Joined before rows go to several cells, so a join has a row for each node and band.
    rows = rows.join(nodes.select("node", "n_shingles", "coordinates"), "node")
    pairs = F.expr("transform(sequence(0, g - 1), j -> struct(least(block, j) AS i, greatest(block, j) AS j))")
    own = ["block", "n_shingles", "coordinates"]
    dealt = rows.select("node", "component", "band", "key", *own, F.explode(pairs).alias("cell"))
    return dealt.select("node", "component", "band", F.xxhash64("band", "key", "cell").alias("cell"), *own)


class Cell:
    """The rows of one cell: which of them may be similar to a row and are not in its component."""

    def __init__(self, rows: pd.DataFrame, percent: int):
        self.percent, self.band = percent, int(rows["band"].iloc[0])
        self.node, self.size = list(rows["node"]), rows["n_shingles"].to_numpy("int64")
        self.component, self.block = pd.factorize(rows["component"])[0], rows["block"].to_numpy()
        self.two = self.block.min() != self.block.max()
        self.x = np.frombuffer(b"".join(rows["coordinates"]), np.int32).reshape(len(rows), -1)

    def likely(self, k: int) -> np.ndarray:
        """A pair is likely in the first band that it shares alone."""
        apart = self.component != self.component[k]
        if self.two:
            apart &= self.block != self.block[k]
        least, most = np.minimum(self.size, self.size[k]), np.maximum(self.size, self.size[k])
        others = np.flatnonzero(apart & (100 * least >= self.percent * most))
        same = self.x[others] == self.x[k]
        others, same = (x[same.sum(1) >= LIKELY] for x in (others, same))
        return others[same.reshape(len(others), BANDS, ROWS).all(2).argmax(1) == self.band]

    def links(self, sets: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
        """Links that join the components of the cell as all its links would, one less than these at most."""
        at = np.unique(np.concatenate(sets), return_inverse=True)[1]
        begin = np.concatenate([[0], np.cumsum(self.size)])
        own = [at[lo:hi] for lo, hi in zip(begin, begin[1:])]
        held, out = np.zeros(len(at), bool), []
        for k in range(len(own)):
            others = self.likely(k)
            others = others[others > k]
            if not len(others):
                continue
            held[own[k]] = True
            starts = np.cumsum(self.size[others]) - self.size[others]
            both = np.add.reduceat(held[np.concatenate([own[j] for j in others])], starts, dtype="int64")
            held[own[k]] = False
            for j in others[100 * both >= self.percent * (self.size[k] + self.size[others] - both)]:
                if self.component[j] != self.component[k]:
                    out.append((self.node[k], self.node[j]))
                    self.component[self.component == self.component[j]] = self.component[k]
        return out


def across(placed: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) of nodes that share a bucket but no component, enough to join what is linked.

    Two steps over the same cells: by signature, which rows have a likely partner in their
    cell; then these rows alone, with their full sets, are confirmed inside the cell. So a
    cell returns at most a row for each of its own rows, however many pairs it compares.
    """

    def partnered(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) < 2 or rows["component"].nunique() < 2:
            return rows.iloc[:0]
        cell = Cell(rows, percent)
        return rows[[len(cell.likely(k)) > 0 for k in range(len(rows))]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch])
            ends = np.flatnonzero((np.diff(held["cell"]) != 0) | (np.diff(held["band"]) != 0)) + 1
            found = [partnered(held.iloc[lo:hi]) for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends)]
            yield pd.concat([held.iloc[:0], *found])
            held = held.iloc[ends[-1] :] if len(ends) else held
        if held is not None and len(held):
            yield partnered(held)

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = cells(placed, nodes, labels).repartition(n, "cell", "band").sortWithinPartitions("cell", "band")
    kind = "node binary, component binary, band int, cell bigint, block int, n_shingles bigint, coordinates binary"
    wanted = stage(together.mapInPandas(run, kind), "partnered")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in small_batches(batches):
            _CACHE.turn()
            sets = [shingles(x).tobytes() for x in batch["text"]]
            own = [xxhash.xxh3_128_digest(x) == node for x, node in zip(sets, batch["node"])]
            yield pd.DataFrame({"node": batch["node"], "shingles": sets})[own]

    def confirm(rows: pd.DataFrame) -> pd.DataFrame:
        # A document that comes twice brings its set twice.
        rows = rows.drop_duplicates("node")
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        return pd.DataFrame(Cell(rows, percent).links(sets), columns=["a", "b"])

    needed = nodes.select("node", "doc_id").join(wanted.select("node").distinct(), "node", "left_semi")
    sets = texts(docs).join(needed, "doc_id").select("node", "text").mapInPandas(whole, "node binary, shingles binary")
    return wanted.join(sets, "node").groupBy("cell", "band").applyInPandas(confirm, "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept (see ``grouped``)."""
    return grouped(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` but for near copies: of each group the row with the least id stays.

    Rows are told apart by id and text, so a text that shares its id with a near copy stays.
    Of rows that repeat both, or of one group under one id, one stays. Rows without an id
    or without words are linked with nothing and stay. All columns are as they were.
    """
    rows = stage(grouped(docs, percent).where("node IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text_key", "component"), "groups")
    first = rows.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("first")).select("first.*")
    gone = rows.select("doc_id", "text_key").distinct().join(first, ["doc_id", "text_key"], "left_anti")
    # Only keys of rows that go meet the texts.
    keyed = docs.withColumn(_KEY, text_key())
    left = keyed.join(gone.withColumnRenamed("text_key", _KEY), ["doc_id", _KEY], "left_anti")
    repeated = rows.groupBy("doc_id", "text_key").count().where("count > 1")
    if not repeated.isEmpty():
        linkable = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(WORD), F.lit(False))
        left = left.where(linkable).dropDuplicates(["doc_id", _KEY]).unionByName(left.where(~linkable))
    return left.select(*docs.columns)


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; text_key, node, component.

    ``node`` is the digest of the document's set, ``component`` the group it is in. A document without words, or without an id, is linked with nothing and kept. Repeated
    rows share their node. An empty table stays empty. Other columns are ignored.
    """
    found = stage(signed(docs), "signed")
    linkable = found.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = stage(
        linkable.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("coordinates").alias("coordinates"),
        ),
        "nodes",
    )
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    leaders = buckets.groupBy("band", "key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    placed = stage(buckets.join(leaders, ["band", "key"]), "buckets")
    ids = nodes.select("node", "doc_id")
    star = stage(placed.where("node != a").select("a", F.col("node").alias("b")).distinct(), "star")
    links = stage(confirmed(star, ids, docs, percent), "links")
    labels = components(links)
    more = stage(across(placed, nodes, labels, docs, percent), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    # Only nodes with links need a join; the least id of a component is its name.
    members = nodes.select("node", "doc_id").join(labels, "node")
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = members.join(least, "component").select("node", "component", "component_id").unionByName(
        ids.join(labels, "node", "left_anti").select("node", F.col("node").alias("component"), F.col("doc_id").alias("component_id"))
    )
    out = found.drop("bands", "coordinates").join(named, "node", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_key", "node", "component")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents; texts without words are linked with nothing."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
