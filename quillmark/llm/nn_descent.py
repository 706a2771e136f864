"""Near-duplicate vectors by NN-descent on a neighbour graph.

Every vector keeps its ``K`` best known neighbours. The graph starts from vectors that lie
next to each other in the order of random sign codes. In each round the neighbours of a
vector, in both directions, are compared with one another, since neighbours of neighbours
are likely neighbours; the best of what is found replaces worse entries. Rounds end when
hardly anything changes. Only links at or above the threshold in double precision are kept.
Lists are bounded, links are not: all members of a group of linked vectors are compared with
one another, in blocks. Their links are counted inside the tasks and never become rows.

Recall is audited: ``AUDIT`` vectors, chosen by hash, are compared with all vectors in
blocks. The recall of each sampled vector counts once, and that of a group of linked ones
once together, so that large groups do not hide lost pairs. While it is too low, the graph
is refined with more codes and more neighbours; if that does not help, the run fails.

Equal vectors are one node, so copies need no links among themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.llm.common import read, stage
from quillmark.llm.components import components

THRESHOLD = 0.9
K = 8
#: Orders of the first attempt, and sign bits beyond the logarithm of the number of nodes.
CODES, SPARE = 8, 4
ROUNDS = 4
#: A round that improves a smaller share of all entries is the last.
SETTLED = 0.02
AUDIT = 4096
RECALL = 0.98
#: Attempts, each with twice the codes, before a run whose recall is too low fails.
ATTEMPTS, MOST_K = 6, 32
#: Rows of codes that one task orders, at least.
ORDERED = 20_000
#: Rows of neighbours that one task holds at a time in a round.
CHUNK = 20_000
#: Members of a group in a block, and rows of a block that are compared at a time.
BLOCK, STRIPE = 8192, 512


def unit_nodes(vectors: DataFrame, unusable: bool = False) -> DataFrame:
    """(vec_id, node, unit): one row per usable vector.

    Vectors that are null, empty, zero, or hold a null or a non-finite component are left
    out, or have a null node if they are wanted. ``unit`` is the direction in double precision, as bytes; ``node`` its digest.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            ids, nodes, units = [], [], []
            for i, v in zip(batch["vec_id"], batch["embedding"]):
                x = np.array([np.nan if c is None else c for c in (() if v is None else v)], float)
                size = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                if size > 0:
                    x = x / size  # neither overflows nor vanishes when squared
                    x = x / np.sqrt((x * x).sum()) + 0.0
                    raw = x.tobytes()
                    nodes.append(xxhash.xxh3_64_intdigest(raw) - (1 << 63))
                    units.append(raw)
                elif unusable:
                    nodes.append(None)
                    units.append(None)
                else:
                    continue
                ids.append(i)
            yield pd.DataFrame({"vec_id": ids, "node": nodes, "unit": units}).astype({"vec_id": "Int64"}).assign(
                node=pd.array(nodes, "Int64")
            )

    return vectors.select("vec_id", "embedding").mapInPandas(run, "vec_id bigint, node bigint, unit binary")


def code_bits(n: int) -> int:
    """Sign bits of a code, so that keys stay about as many as n nodes or more."""
    return min(44, math.ceil(math.log2(max(2, n))) + SPARE)


def codes(nodes: DataFrame, n_codes: int, bits: int, seed: int) -> DataFrame:
    """(node, code, key): sign codes of random directions, drawn anew for each length of vector.

    Keys number the codes in Gray order, so neighbouring codes differ in one sign.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, part in batch.groupby(batch["unit"].map(len)):
                d = size // 8
                if d not in planes:
                    planes[d] = np.random.default_rng(seed * 1000 + d).standard_normal((d, n_codes * bits))
                x = np.frombuffer(b"".join(part["unit"]), float).reshape(-1, d)
                signs = (x @ planes[d] > 0).reshape(len(x), n_codes, bits)
                places = np.bitwise_xor.accumulate(signs, axis=2)
                keys = places @ (1 << np.arange(bits)[::-1]) + d * (1 << bits)
                yield pd.DataFrame(
                    {
                        "node": np.repeat(part["node"].to_numpy(), n_codes),
                        "code": np.tile(np.arange(n_codes), len(x)),
                        "key": keys.ravel(),
                    }
                )

    return nodes.select("node", "unit").mapInPandas(run, "node bigint, code int, key bigint")


def first_neighbours(nodes: DataFrame, n_codes: int, bits: int, seed: int) -> DataFrame:
    """(a, b) pairs next to each other where nodes are ordered by code, key and node.

    The order goes on across keys. It is dealt by ranges, so tasks are alike however many
    nodes share a key; only the pairs at the borders of tasks are left to other codes.
    """
    found = codes(nodes, n_codes, bits, seed)
    most = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(most, nodes.count() * n_codes // ORDERED))
    order = ["code", "key", "node"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch])
            code, kind, node = rows["code"].to_numpy(), rows["key"].to_numpy() >> bits, rows["node"].to_numpy()
            for k in (1, 2):
                same = (code[k:] == code[:-k]) & (kind[k:] == kind[:-k])
                yield pd.DataFrame({"a": node[k:][same], "b": node[:-k][same]})
            held = rows.tail(2)

    return found.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInPandas(run, "a bigint, b bigint")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def measured(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds the cosine in double precision to distinct pairs (a, b)."""
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("unit").alias(f"u{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["ua"].map(len) == batch["ub"].map(len)]
            cosine = [float(np.frombuffer(x) @ np.frombuffer(y)) for x, y in zip(batch["ua"], batch["ub"])]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "cosine": cosine}).astype({"cosine": float})

    return joined.select("a", "b", "ua", "ub").mapInPandas(run, "a bigint, b bigint, cosine double")


def best(edges: DataFrame, k: int) -> DataFrame:
    """The k best directed entries of each a."""
    order = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return edges.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def local_joins(graph: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Directed entries (a, b, cosine) that comparing the neighbours of each node proposes.

    Each node's neighbours come together with their vectors, the node itself among them.
    Lists are bounded by k in one direction and by the k best in the other, so a task
    works through bounded groups. Of each member the k best partners are proposed.
    """
    back = best(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"), k)
    around = graph.select("a", "b").unionByName(back.select("a", "b")).unionByName(
        nodes.select(F.col("node").alias("a"), F.col("node").alias("b"))
    ).distinct()
    placed = around.join(nodes.select(F.col("node").alias("b"), "unit"), "b")
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(n, "a").sortWithinPartitions("a")

    def propose(pivots: np.ndarray, ids: np.ndarray, units: list[bytes]) -> pd.DataFrame:
        cuts = np.flatnonzero(np.diff(pivots)) + 1
        out = []
        for lo, hi in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(ids)]])):
            own, part = ids[lo:hi], units[lo:hi]
            if len({len(u) for u in part}) > 1:
                keep = [i for i, u in enumerate(part) if len(u) == len(part[0])]
                own, part = own[keep], [part[i] for i in keep]
            x = np.frombuffer(b"".join(part)).reshape(len(own), -1)
            cosine = x @ x.T
            np.fill_diagonal(cosine, -2)
            take = min(k, len(own) - 1)
            if take < 1:
                continue
            partner = np.argpartition(-cosine, take - 1, axis=1)[:, :take]
            out.append(
                np.column_stack(
                    [np.repeat(own, take), own[partner].ravel(), np.take_along_axis(cosine, partner, 1).ravel().view(np.int64)]
                )
            )
        rows = np.concatenate(out) if out else np.empty((0, 3), np.int64)
        frame = pd.DataFrame({"a": rows[:, 0], "b": rows[:, 1], "cosine": np.ascontiguousarray(rows[:, 2]).view(float)})
        return frame.drop_duplicates(["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows arrive ordered by a; the last group of a chunk waits for the next one.
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < CHUNK:
                continue
            rows = pd.concat(held)
            whole = rows["a"] != rows["a"].iloc[-1]
            held = [rows[~whole]]
            if whole.any():
                rows = rows[whole]
                yield propose(rows["a"].to_numpy(), rows["b"].to_numpy(), list(rows["unit"]))
        if held:
            rows = pd.concat(held)
            yield propose(rows["a"].to_numpy(), rows["b"].to_numpy(), list(rows["unit"]))

    return placed.select("a", "b", "unit").mapInPandas(run, "a bigint, b bigint, cosine double")


def descend(nodes: DataFrame, k: int, n_codes: int, bits: int, rounds: int, seed: int) -> DataFrame:
    """The neighbour graph: directed entries (a, b, cosine), at most k for each a."""
    pairs = first_neighbours(nodes, n_codes, bits, seed).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    start = measured(pairs, nodes)
    both = start.unionByName(start.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    graph = stage(best(both, k), "graph")
    size = graph.count()
    for _ in range(rounds):
        found = graph.withColumn("new", F.lit(0)).unionByName(local_joins(graph, nodes, k).withColumn("new", F.lit(1)))
        merged = found.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.min("new").alias("new"))
        after = stage(best(merged, k), "graph")
        changed = after.where("new = 1").count()
        graph = after.drop("new")
        if changed <= SETTLED * max(1, size):
            break
        size = max(size, changed)
    return graph


def tiles(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """(component, i, j, block, node, n, unit): the members of each group once for each pair of its blocks i <= j.

    A node's block follows from its hash; a group has as many as keep them at about ``BLOCK`` nodes.
    """
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    placed = groups.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.join(nodes.select("node", "n", "unit"), "node").select("component", "block", "node", "n", "unit", other)
    return pairs.select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "n", "unit"
    )


def group_links(groups: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, others): linked nodes of each node, and how many vectors they stand for.

    Every two members of a group (node, component) are compared, block by block; a task holds
    one pair of blocks, and of the pairs only their counts become rows.
    """
    keys = ["component", "i", "j"]
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles(groups, nodes).repartition(n, *keys).sortWithinPartitions(*keys, "block")

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(rows["unit"])).reshape(len(rows), -1)
        copies, block = rows["n"].to_numpy(), rows["block"].to_numpy()
        links, others = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        # Two blocks are compared with each other, a single one with itself.
        first = int(np.searchsorted(block, block[0], "right"))
        alone = rows["i"].iloc[0] == rows["j"].iloc[0]
        right = slice(0 if alone else first, len(rows))
        for lo in range(0, first, STRIPE):
            left = slice(lo, min(lo + STRIPE, first))
            close = x[left] @ x[right].T >= threshold
            if alone:
                close[np.arange(left.stop - lo), np.arange(lo, left.stop)] = False
            links[left] += close.sum(axis=1)
            others[left] += close @ copies[right]
            if not alone:
                links[right] += close.sum(axis=0)
                others[right] += copies[left] @ close
        return pd.DataFrame({"node": rows["node"].to_numpy(), "links": links, "others": others})

    def counted(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for _, one in rows.groupby(keys, sort=False):
            # The other block may be without rows for a group this small.
            if one["i"].iloc[0] == one["j"].iloc[0] or one["block"].iloc[0] != one["block"].iloc[-1]:
                yield linked(one)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows arrive ordered by tile; the last one of a chunk waits for the next chunk.
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            last = batch[keys].iloc[-1]
            if (held[0][keys].iloc[0] == last).all():
                continue
            rows = pd.concat(held)
            open_ = (rows[keys] == last).all(axis=1)
            held = [rows[open_]]
            found = list(counted(rows[~open_]))
            if found:
                yield pd.concat(found)
        if held:
            yield from counted(pd.concat(held))

    found = dealt.mapInPandas(run, "node bigint, links bigint, others bigint")
    return found.groupBy("node").agg(F.sum("links").alias("links"), F.sum("others").alias("others"))


def audit(links: DataFrame, nodes: DataFrame, threshold: float, n: int = AUDIT) -> float:
    """The recall of listed links (a < b); see ``audited``."""
    return audited(_both(links).groupBy("a").agg(F.count("*").alias("n")), nodes, threshold, n)


def audited(degrees: DataFrame, nodes: DataFrame, threshold: float, n: int = AUDIT) -> float:
    """Mean share of the true links of sampled nodes that were found; 1 if there are none.

    ``degrees`` (a, n) tells how many were found. Sampled nodes that link with one another
    count once, by their mean. At most n sampled vectors travel to the tasks; every task
    counts the links of its own rows.
    """
    asked = nodes.orderBy(F.xxhash64("node"), "node").limit(n).select("node", "unit").collect()
    by_size: dict[int, list] = {}
    for r in asked:
        by_size.setdefault(len(r.unit), []).append(r)
    matrix = {
        s: (np.array([r.node for r in rows]), np.frombuffer(b"".join(r.unit for r in rows)).reshape(len(rows), -1))
        for s, rows in by_size.items()
    }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = {size: np.zeros(len(ids), np.int64) for size, (ids, _) in matrix.items()}
        for batch in batches:
            for size, part in batch.groupby(batch["unit"].map(len)):
                if size in matrix:
                    ids, x = matrix[size]
                    for lo in range(0, len(part), 500):
                        cut = part.iloc[lo : lo + 500]
                        close = np.frombuffer(b"".join(cut["unit"])).reshape(len(cut), -1) @ x.T >= threshold
                        close &= cut["node"].to_numpy()[:, None] != ids
                        counts[size] += close.sum(axis=0)
        for size, (ids, _) in matrix.items():
            some = counts[size] > 0
            yield pd.DataFrame({"a": ids[some], "n": counts[size][some]})

    counted = nodes.select("node", "unit").mapInPandas(run, "a bigint, n bigint").groupBy("a").agg(F.sum("n").alias("n"))
    true = {r.a: r.n for r in counted.collect()}
    if not true:
        return 1.0
    sampled = F.broadcast(nodes.sparkSession.createDataFrame([(a,) for a in true], "a bigint"))
    found = {r.a: r.n for r in degrees.join(sampled, "a", "left_semi").collect()}
    means = []
    for ids, x in matrix.values():
        linked = np.array([a in true for a in ids.tolist()])
        ids, x = ids[linked], x[linked]
        share = np.array([min(1.0, found.get(a, 0) / true[a]) for a in ids.tolist()])
        free = np.ones(len(ids), bool)
        for i in range(len(ids)):
            if not free[i]:
                continue
            free[i], group, ahead = False, [i], [i]
            while ahead:
                near = np.flatnonzero(free & (x @ x[ahead.pop()] >= threshold))
                free[near] = False
                group.extend(near)
                ahead.extend(near)
            means.append(share[group].mean())
    return float(np.mean(means))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    ``n_links`` counts other vectors linked directly, copies included. Unusable vectors,
    and rows without an id, link with nothing and are kept. An empty table stays empty.
    """
    rows = stage(unit_nodes(vectors, unusable=True), "units")
    usable = rows.where("vec_id IS NOT NULL AND node IS NOT NULL")
    nodes = stage(
        usable.groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.first("unit").alias("unit")), "nodes"
    )
    k, n_codes, links = K, CODES, None
    bits = code_bits(nodes.count())
    for attempt in range(ATTEMPTS):
        graph = descend(nodes, k, n_codes, bits, ROUNDS, 11 + attempt)
        close = graph.where(F.col("cosine") >= threshold)
        found = close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = stage((found if links is None else found.unionByName(links)).distinct(), "links")
        groups = stage(components(links), "groups")
        counts = stage(group_links(groups, nodes, threshold), "counts")
        recall = audited(counts.select(F.col("node").alias("a"), F.col("links").alias("n")), nodes, threshold)
        if recall >= RECALL:
            break
        k, n_codes = min(MOST_K, 2 * k), 2 * n_codes
    else:
        raise RuntimeError(f"mean recall of sampled vectors stays at {recall:.3f}, below {RECALL}")
    members = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = members.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    info = (
        members.join(least, "component")
        .join(counts.select("node", "others"), "node", "left")
        .select("node", "component_id", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    ids = usable.select("vec_id", "node").join(info, "node").select("vec_id", "component_id", "n_links")
    bad = rows.where("vec_id IS NULL OR node IS NULL")
    out = ids.unionByName(bad.select("vec_id", F.col("vec_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))
    return out.select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
