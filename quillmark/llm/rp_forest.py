"""Nearest neighbours by inner product from a forest of random-projection trees.

Each tree splits the vectors again and again at the median along the difference of two
random members, so dense regions are cut as finely as sparse ones. A coordinate that
brings all vectors to the largest norm turns inner products into distances. The trees are
fitted on a bounded sample (``SAMPLE`` vectors, ``SAMPLE_BYTES``); every vector is then
placed in one leaf of each tree.

A query walks all trees with one priority queue: always on to the branch whose worst
margin is best, whichever tree it is in, until enough leaves are open. What lies in these
leaves is scored exactly on the original vectors in double precision.

How many leaves are opened is measured, not set: ``AUDIT`` queries, chosen by hash, are
compared with all vectors in blocks, the place of each true neighbour's leaf in the order
of the queue tells the recall of any number of leaves, and the least number that reaches
``RECALL`` is taken. All leaves always do, so the bound is kept on any data; where vectors
have no structure (directions at random), much of the table has to be read for it.

Equal vectors are one node that knows only as many of its ids as can be in a result, so
copies cost nothing. Leaves with many vectors or many queries are cut into blocks, and
every block of queries meets every block of vectors of its leaf.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.llm.common import read, stage

TREES = 4
#: Vectors a leaf holds on average, and sample vectors it is fitted on at least.
LEAF, LEAF_SAMPLE = 4096, 16
SAMPLE, SAMPLE_BYTES = 65_536, 64 << 20
AUDIT, RECALL = 256, 0.94
#: Vectors and queries of one leaf that meet in one group.
BLOCK, QUERY_BLOCK = 8192, 2048
POINT = "vec_id bigint, node binary, vec binary, norm2 double"


def points(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, vec, norm2) of usable vectors: their bytes, a digest of these, the squared norm.

    Rows without an id and vectors that are null, empty, zero, or hold null or non-finite
    components take no part.
    """
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    kind = "<f4" if single else "<f8"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, v in zip(batch["vec_id"], batch["embedding"]):
                v = np.asarray([] if v is None else v, "f8")
                if pd.isna(i) or not len(v) or not np.isfinite(v).all() or not v.any():
                    continue
                packed = (v + 0.0).astype(kind).tobytes()  # one zero, not two
                rows.append((int(i), hashlib.blake2b(packed, digest_size=16).digest(), packed, float(v @ v)))
            yield pd.DataFrame(rows, columns=["vec_id", "node", "vec", "norm2"])

    values = F.col("embedding") if single else F.col("embedding").cast("array<double>")
    return vectors.select("vec_id", values.alias("embedding")).mapInPandas(run, POINT)


def matrix(packed, kind: str, dim: int) -> np.ndarray:
    """Vectors as rows in double precision; shorter ones end in zeros."""
    out = np.zeros((len(packed), dim))
    for k, x in enumerate(packed):
        v = np.frombuffer(x, kind)
        out[k, : len(v)] = v
    return out


class Forest:
    """Balanced trees in heap order: node n has the children 2n+1 and 2n+2."""

    def __init__(self, sample: np.ndarray, radius2: float, depth: int, trees: int = TREES):
        chance = np.random.default_rng(5)
        self.radius2, self.depth = radius2, depth
        self.inner = (1 << depth) - 1
        lifted = self.lifted(sample)
        self.normals = np.zeros((trees, self.inner, lifted.shape[1]), "f4")
        self.cuts = np.zeros((trees, self.inner))
        for tree in range(trees):
            members = {0: np.arange(len(lifted))}
            for n in range(self.inner):
                mine = members.pop(n)
                normal = np.zeros(lifted.shape[1])
                for _ in range(8):
                    if len(mine) > 1:
                        a, b = lifted[chance.choice(mine, 2, replace=False)]
                        normal = a - b
                    if normal.any():
                        break
                if not normal.any():
                    normal = chance.normal(size=lifted.shape[1])
                self.normals[tree, n] = normal / np.linalg.norm(normal)
                along = lifted[mine] @ self.normals[tree, n].astype("f8")
                self.cuts[tree, n] = np.median(along) if len(mine) else 0.0
                over = along > self.cuts[tree, n]
                members[2 * n + 1], members[2 * n + 2] = mine[~over], mine[over]

    @property
    def leaves(self) -> int:
        return len(self.cuts) << self.depth

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.radius2 - np.einsum("ij,ij->i", x, x), 0.0))
        return np.column_stack([x, rest])

    def places(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree, numbered over all trees."""
        x = self.lifted(x)
        out = np.empty((len(x), len(self.cuts)), "int64")
        for tree, (normals, cuts) in enumerate(zip(self.normals, self.cuts)):
            node = np.zeros(len(x), "int64")
            for _ in range(self.depth):
                side = np.empty(len(x), bool)
                for n in np.unique(node):  # rows of one node at a time
                    rows = node == n
                    side[rows] = x[rows] @ normals[n].astype("f8") > cuts[n]
                node = 2 * node + 1 + side
            out[:, tree] = node - self.inner + (tree << self.depth)
        return out

    def order(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves in the order of one queue over all trees."""
        queue = [(-math.inf, tree, 0) for tree in range(len(self.cuts))]
        found: list[int] = []
        dim = self.normals.shape[2] - 1
        while queue and len(found) < most:
            cost, tree, n = heapq.heappop(queue)
            while n < self.inner:
                margin = float(self.normals[tree, n, :dim] @ query) - self.cuts[tree, n]
                far = 2 * n + 1 if margin > 0 else 2 * n + 2
                heapq.heappush(queue, (max(cost, abs(margin)), tree, far))
                n = 4 * n + 3 - far
            found.append(n - self.inner + (tree << self.depth))
        return found


def fitted(nodes: DataFrame, kind: str) -> tuple[Forest, int]:
    """A forest fitted on a hash sample of the nodes, and the longest vector's length."""
    size = int(kind[2:])
    total = nodes.agg(
        F.count("*").alias("n"), F.max(F.octet_length("vec")).alias("width"), F.max("norm2").alias("radius2")
    ).first()
    dim = (total.width or size) // size
    most = max(1024, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    share = min(1.0, most / max(total.n, 1))
    drawn = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 40)) < int(share * (1 << 40))).limit(2 * most)
    drawn = drawn.select("node", "vec").toPandas().sort_values("node")
    depth = max(0, math.ceil(math.log2(max(total.n, 1) / LEAF)))
    depth = min(depth, int(math.log2(max(len(drawn) / LEAF_SAMPLE, 1))))
    return Forest(matrix(drawn["vec"], kind, dim), total.radius2 or 0.0, depth), dim


def opened(nodes: DataFrame, queries: DataFrame, forest: Forest, kind: str, dim: int, k: int) -> int:
    """The least number of leaves whose vectors hold the wanted share of true neighbours.

    The audited queries (at most ``AUDIT``) meet all vectors; each block of vectors gives
    its k best per query with their leaves, and a second round keeps the k best of all.
    """
    drawn = queries.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(AUDIT).toPandas()
    if drawn.empty:
        return 1
    asked, own = matrix(drawn["vec"], kind, dim), drawn["node"].tolist()

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = batch["node"].tolist()
            for at in range(0, len(batch), BLOCK):
                x = matrix(batch["vec"].iloc[at : at + BLOCK], kind, dim)
                score, places = asked @ x.T, forest.places(x)
                here = {n: j for j, n in enumerate(names[at : at + BLOCK])}
                rows = []
                for q in range(len(asked)):
                    if own[q] in here:
                        score[q, here[own[q]]] = -math.inf
                    best = np.argsort(-score[q], kind="stable")[:k]
                    rows += [(q, score[q, j], places[j].tolist()) for j in best if score[q, j] > -math.inf]
                yield pd.DataFrame(rows, columns=["q", "score", "places"])

    first = nodes.select("node", "vec").mapInPandas(block, "q int, score double, places array<bigint>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc()))
    rows = first.withColumn("rank", rank).where(F.col("rank") <= k).collect()
    needed = []
    turns = [{leaf: t for t, leaf in enumerate(forest.order(x, forest.leaves))} for x in asked]
    for r in rows:
        needed.append(min(turns[r.q][leaf] for leaf in r.places) + 1)
    needed.sort()
    return needed[math.ceil(RECALL * len(needed)) - 1] if needed else 1


def nearest(vectors: DataFrame, wanted, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every row that ``wanted`` holds for.

    ``wanted`` is a condition on vec_id. Nearness is the inner product in double precision,
    ties go to the smaller vec_id; a query's own row is no candidate, equal vectors under
    other ids are. Vectors of unequal length are compared as if the shorter one ended in
    zeros. Rows that repeat id and vector count once; an id with several vectors is
    several rows and, if it is wanted, several queries. No usable vectors, no rows; other
    columns are left out.
    """
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    rows = stage(points(vectors), "points")
    # Copies: only the k + 1 least ids of a vector can be in a result.
    ids = rows.select("node", "vec_id").distinct()
    least = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    ids = ids.withColumn("place", least).where(F.col("place") <= k + 1)
    ids = ids.groupBy("node").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = stage(rows.select("node", "vec", "norm2").dropDuplicates(["node"]).join(ids, "node"), "nodes")
    asking = rows.where(wanted).select("node", F.col("vec_id").alias("query_id")).distinct()
    queries = stage(nodes.select("node", "vec").join(asking.select("node").distinct(), "node", "left_semi"), "queries")
    forest, dim = fitted(nodes, kind)
    best = best_of_leaves(nodes, queries, forest, opened(nodes, queries, forest, kind, dim, k), kind, dim, k)
    return (
        asking.join(best.withColumnRenamed("query", "node"), "node")
        .withColumn("best", F.filter("best", lambda x: (x.node != F.col("node")) | (x.vec_id != F.col("query_id"))))
        .select("query_id", F.posexplode(F.slice("best", 1, k)).alias("rank", "x"))
        .select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", (-F.col("x.cost")).alias("score"))
    )


def best_of_leaves(
    nodes: DataFrame, queries: DataFrame, forest: Forest, leaves: int, kind: str, dim: int, k: int
) -> DataFrame:
    """(query, best): the k + 1 best (cost, vec_id, node) found in each query's first leaves."""
    spark = nodes.sparkSession
    shared = spark.sparkContext.broadcast(forest)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "leaf": list(shared.value.places(matrix(batch["vec"], kind, dim)))})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value.order(x, leaves) for x in matrix(batch["vec"], kind, dim)]
            yield pd.DataFrame({"node": batch["node"], "leaf": found})

    placed = stage(nodes.select("node", "vec").mapInPandas(place, "node binary, leaf array<bigint>"), "places")
    walked = stage(queries.select("node", "vec").mapInPandas(walk, "node binary, leaf array<bigint>"), "walks")
    # Blocks of full leaves; there is a row for each leaf of the bounded forest.
    size = lambda df, name: df.select(F.explode("leaf").alias("leaf")).groupBy("leaf").agg(F.count("*").alias(name))
    sizes = size(placed, "n").join(size(walked, "m"), "leaf")
    sizes = sizes.select(
        "leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("turns")
    )
    sizes = F.broadcast(stage(sizes, "sizes"))

    def cells(where: DataFrame, data: DataFrame, mine: str, other: str) -> DataFrame:
        return (
            where.select("node", F.explode("leaf").alias("leaf"))
            .join(sizes, "leaf")
            .withColumn(mine[:-1], F.pmod(F.xxhash64("node"), F.col(mine)).cast("int"))
            .withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .select("node", "leaf", "block", "turn")
            .join(data, "node")
        )

    there = cells(placed, nodes.select("node", "vec", "ids"), "blocks", "turns")
    asked = cells(walked, queries.select("node", "vec"), "turns", "blocks")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x = matrix(left["vec"], kind, dim)
            names, ids = left["node"].tolist(), left["ids"].tolist()
            # Beyond what sums in another order can differ by, the fast product decides.
            slack = 1e-12 * dim * np.linalg.norm(x, axis=1).max()
            for at in range(0, len(right), 256):
                part = right.iloc[at : at + 256]
                q = matrix(part["vec"], kind, dim)
                score = q @ x.T
                last = max(0, len(x) - k - 1)
                floor = np.partition(score, last, axis=1)[:, last] - slack * np.linalg.norm(q, axis=1)
                for j, name in enumerate(part["node"]):
                    near = np.flatnonzero(score[j] >= floor[j])
                    exact = (x[near] * q[j]).sum(axis=1)
                    rows = [(-float(s), int(i), names[n]) for s, n in zip(exact, near) for i in ids[n]]
                    out.append((name, heapq.nsmallest(k + 1, rows)))
        return pd.DataFrame(out, columns=["query", "best"])

    # Tuples of this order sort as the result does.
    kept = "query binary, best array<struct<cost: double, vec_id: bigint, node: binary>>"
    keys = ["leaf", "block", "turn"]
    found = there.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(meet, kept)
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("best"))))
    return found.groupBy("query").agg(F.slice(every, 1, k + 1).alias("best"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row of embeddings whose id is divisible by 20."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
