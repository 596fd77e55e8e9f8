"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, results merged.

Equal vectors are merged first (a graph of copies does not navigate): a distinct vector keeps its k + 1 smallest
ids, of which no query can need more. Distinct vectors are dealt by hash to shards of about `SHARD`, or of `GROWTH` times
the root of their number if that is more, so that shards grow in number and in size alike; a task builds
a shard's graph, and the index is a table with one row per shard: vectors, ids and, per layer, flat neighbour
arrays. Queries are dealt to groups of about `GROUP`; every (shard, group) pair is searched in a task of its own,
and the shards' answers are merged by rank. Nothing passes through the driver but counts.

Nearness is Euclidean distance in double precision on the original vectors, ties to the smaller id.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do
rows with a null id; vectors of different length never meet; repeated rows count once; a query with fewer
candidates than k gets them all; if no vector is left the result is empty. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, small_side

SHARD, GROWTH, GROUP = 4096, 16, 8192
#: Tasks that build shards, at most; a shard is small in bytes but long to build, so shards are not put together.
MOST_TASKS = 20_000
#: Links of a node on upper layers and on layer 0, and the breadth of searches while building and asking.
LINKS, LINKS_0, BUILD_BREADTH, ASK_BREADTH = 12, 24, 64, 96


class Graph:
    """A graph over the rows of a matrix. links[l] is a matrix of neighbours (-1 fills) over the nodes in nodes[l]."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.entry = -1
        self.links: list[np.ndarray] = []
        self.place: list[np.ndarray] = []
        self.stamp = 0
        self.seen = np.zeros(len(vectors), np.int32)

    def near(self, layer: int, node: int) -> np.ndarray:
        row = self.links[layer][self.place[layer][node]]
        return row[row >= 0]

    def search(self, q: np.ndarray, starts: list[tuple[float, int]], breadth: int, layer: int) -> list[tuple[float, int]]:
        """Up to `breadth` nearest nodes found on a layer, as (squared distance, node), nearest first."""
        self.stamp += 1
        seen, stamp, vectors = self.seen, self.stamp, self.vectors
        links, place = self.links[layer], self.place[layer]
        for _, n in starts:
            seen[n] = stamp
        open_, best = list(starts), [(-d, n) for d, n in starts]
        heapq.heapify(open_)
        heapq.heapify(best)
        while open_:
            d, node = heapq.heappop(open_)
            if d > -best[0][0] and len(best) >= breadth:
                break
            row = links[place[node]]
            row = row[row >= 0]
            row = row[seen[row] != stamp]
            if not len(row):
                continue
            seen[row] = stamp
            gap = vectors[row] - q
            for d, n in zip(np.einsum("ij,ij->i", gap, gap).tolist(), row.tolist(), strict=True):
                if len(best) < breadth:
                    heapq.heappush(best, (-d, n))
                    heapq.heappush(open_, (d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                    heapq.heappush(open_, (d, n))
        return sorted((-d, n) for d, n in best)

    def spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Of candidates, nearest first, those nearer to the node than to any already chosen; then the nearest rest."""
        if len(found) <= most:
            return [n for _, n in found]
        nodes = np.array([n for _, n in found])
        points = self.vectors[nodes]
        square = np.einsum("ij,ij->i", points, points)
        between = square[:, None] + square[None, :] - 2 * points @ points.T
        closest = np.full(len(found), np.inf)
        chosen, left = [], []
        for i, (d, _) in enumerate(found):
            if len(chosen) < most and d < closest[i]:
                chosen.append(i)
                np.minimum(closest, between[i], out=closest)
            else:
                left.append(i)
        return nodes[chosen + left[: most - len(chosen)]].tolist()

    def connect(self, layer: int, node: int, others: list[int]) -> None:
        links, place = self.links[layer], self.place[layer]
        most = links.shape[1]
        links[place[node], : len(others)] = others
        for other in others:
            row = links[place[other]]
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = node
                continue
            around = np.append(row, node)
            gap = self.vectors[around] - self.vectors[other]
            kept = self.spread(sorted(zip(np.einsum("ij,ij->i", gap, gap).tolist(), around.tolist(), strict=True)), most)
            row[:] = -1
            row[: len(kept)] = kept

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> Graph:
        graph = cls(vectors)
        rng = np.random.default_rng(seed)
        tops = np.minimum((-np.log(rng.random(len(vectors))) / math.log(LINKS)).astype(int), 8)
        for layer in range(tops.max() + 1):
            nodes = np.flatnonzero(tops >= layer)
            place = np.full(len(vectors), -1, np.int32)
            place[nodes] = np.arange(len(nodes))
            graph.place.append(place)
            graph.links.append(np.full((len(nodes), LINKS if layer else LINKS_0), -1, np.int32))
        for node, top in enumerate(tops.tolist()):
            if graph.entry < 0:
                graph.entry, graph.top = node, top
                continue
            q = vectors[node]
            at = graph.descend(q, top)
            for layer in range(min(top, graph.top), -1, -1):
                at = graph.search(q, at, BUILD_BREADTH, layer)
                graph.connect(layer, node, graph.spread(at, LINKS))
            if top > graph.top:
                graph.entry, graph.top = node, top
        return graph

    def descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        gap = self.vectors[self.entry] - q
        at = [(float(gap @ gap), self.entry)]
        for layer in range(self.top, to, -1):
            at = self.search(q, at, 1, layer)
        return at

    def ask(self, q: np.ndarray, breadth: int) -> list[int]:
        return [n for _, n in self.search(q, self.descend(q, 0), breadth, 0)]


INDEX = "dim int, shard int, entry int, vectors binary, many binary, ids binary, nodes array<binary>, links array<binary>"


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("first")
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    graph = Graph.build(vectors, int(key[1]))
    nodes = [np.flatnonzero(p >= 0).astype("<i4").tobytes() for p in graph.place[: graph.top + 1]]
    links = [g.astype("<i4").tobytes() for g in graph.links[: graph.top + 1]]
    many = np.array([len(i) for i in rows["ids"]], "<i4").tobytes()
    ids = np.concatenate(rows["ids"].to_numpy()).astype("<i8").tobytes()
    out = {"dim": [key[0]], "shard": [key[1]], "entry": [graph.entry], "vectors": [vectors.tobytes()], "many": [many], "ids": [ids]}
    return pd.DataFrame(out | {"nodes": [nodes], "links": [links]})


def _load(row: pd.Series) -> tuple[Graph, np.ndarray, np.ndarray]:
    graph = Graph(np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"]))
    graph.entry, graph.top = int(row["entry"]), len(row["nodes"]) - 1
    for nodes, links in zip(row["nodes"], row["links"], strict=True):
        nodes = np.frombuffer(nodes, "<i4")
        place = np.full(len(graph.vectors), -1, np.int32)
        place[nodes] = np.arange(len(nodes))
        graph.place.append(place)
        graph.links.append(np.frombuffer(links, "<i4").reshape(len(nodes), -1))
    many = np.frombuffer(row["many"], "<i4")
    return graph, np.cumsum(many) - many, np.frombuffer(row["ids"], "<i8")


def usable(vector: Column) -> Column:
    """A vector that takes part: components all finite, and not all zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def build_index(vectors: DataFrame, k: int, shard_size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(index, sizes): the shards' table, and (dim, shards). vectors: id, vector (array of double)."""
    ranked = vectors.withColumn("rank", F.row_number().over(Window.partitionBy("vector").orderBy("id")))
    distinct = ranked.where(F.col("rank") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = materialise(distinct.withColumn("dim", F.size("vector")).withColumn("first", F.get("ids", F.lit(0))))
    size = F.greatest(F.lit(float(SHARD)), GROWTH * F.sqrt(F.count("*"))) if shard_size is None else F.lit(float(shard_size))
    sizes = distinct.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("shards"))
    dealt = distinct.join(small_side(sizes), "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))
    tasks = sizes.agg(F.sum("shards")).first()[0] or 1
    rows = dealt.select("dim", "shard", "first", "vector", "ids").repartition(min(tasks, MOST_TASKS), "dim", "shard")
    return materialise(rows.groupBy("dim", "shard").applyInPandas(_build, INDEX)), sizes


def ask(index: DataFrame, sizes: DataFrame, queries: DataFrame, k: int, breadth: int = ASK_BREADTH, group_size: int = GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest that the shards find. queries: id, vector."""
    queries = queries.withColumn("dim", F.size("vector"))
    groups = queries.groupBy("dim").agg(F.ceil(F.count("*") / group_size).cast("int").alias("groups"))
    plan = small_side(sizes.join(groups, "dim"))
    asked = queries.join(plan, "dim").withColumn("group", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("dim", "shard", "group", "id", "vector")
    shards = index.join(plan.drop("shards"), "dim").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            graph, starts, ids = _load(left.iloc[0])
            ends = np.append(starts[1:], len(ids))
            for query, vector in zip(right["id"].tolist(), right["vector"], strict=True):
                q = np.asarray(vector, np.float64)
                found = []
                for node in graph.ask(q, max(breadth, k + 1)):
                    gap = q - graph.vectors[node]
                    score = math.sqrt(float((gap * gap).sum()))
                    if len(found) > k and score > found[k][0]:
                        break
                    found += [(score, i) for i in ids[starts[node] : ends[node]].tolist() if i != query]
                out += [(query, i, s) for s, i in sorted(set(found))[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = shards.groupBy("dim", "shard", "group").cogroup(asked.groupBy("dim", "shard", "group"))
    found = found.applyInPandas(search, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return once.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", shard_size: int | None = None, group_size: int = GROUP) -> DataFrame:
    """For each row that is_query marks, its k nearest other rows. Rows that share an id but not their vector are candidates
    and queries each; their answers are merged under the id, each other row once, at its smallest distance."""
    rows = table.where(F.col(key).isNotNull() & usable(F.col(vector)))
    named = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks"))
    index, sizes = build_index(named.select("id", "vector").distinct(), k, shard_size)
    queries = named.where("asks").select("id", "vector").distinct()
    return ask(index, sizes, queries, k, group_size=group_size)
