"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``SAMPLE`` vectors, those with the smallest hashed ids) a
neighbour graph is built and cut into balanced partitions: recursive bisection
at the median of the graph's second eigenvector, improved by swaps of equal
size.  A small classifier (one hidden layer) learns from the vector in which
partitions its neighbours are.  Every row is indexed under its most probable
partition; a query goes to the most probable ones, a share ``probed`` of all,
and to further ones until they hold k candidates.  What is found there is scored exactly and merged.

A partition's rows are packed into blocks of at most ``BLOCK`` rows spread over
lanes, so a partition with a third of all rows is many tasks of one size.  The
model's size depends on the dimension and number of partitions alone.

Defined results: vectors that are null, zero, hold a null or non-finite
component or have another length than most, and rows without id, take no part;
a query never meets rows of its own id; of several query rows with one id the
smallest vector counts; ties go to the smaller id; repeated candidate rows are
reported as often as they come; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.llm.common import Scratch, ship
from tallyframe.llm.topk import best, usable

#: PROBED: share of the partitions a query goes to; vectors without clusters need this much for a recall over 0.9.
SAMPLE, PARTITIONS, NEIGHBOURS, PROBED = 4096, 32, 12, 0.75
BLOCK, QUERY_BLOCK, HIDDEN, STEPS, DECAY, LEAST = 4096, 256, 96, 200, 1e-3, 64


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> list[np.ndarray]:
    """Neighbours of each row, both ways, by inner product."""
    n = len(x)
    k = min(k, n - 1)
    links: list[set[int]] = [set() for _ in range(n)]
    for at in range(0, n, 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        for i, near in enumerate(np.argpartition(-s, k - 1, axis=1)[:, :k] if k else []):
            for j in near.tolist():
                links[at + i].add(j)
                links[j].add(at + i)
    return [np.fromiter(sorted(s), np.int64, len(s)) for s in links]


def bisect(nodes: np.ndarray, graph: list[np.ndarray], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of equal size with few links between them."""
    place = {int(v): i for i, v in enumerate(nodes)}
    pairs = np.array([(i, place[int(u)]) for i, v in enumerate(nodes) for u in graph[v] if int(u) in place], np.int64).reshape(-1, 2)
    n = len(nodes)
    src, dst = pairs[:, 0], pairs[:, 1]
    degree = np.maximum(np.bincount(src, minlength=n), 1).astype(float)
    v = rng.standard_normal(n)
    for _ in range(60):  # power iteration on the lazy walk, the constant vector taken out
        v -= (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * np.bincount(src, v[dst], n) / degree
        v /= np.linalg.norm(v) or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2:]] = True
    for _ in range(20):  # swaps: as many from either side, best gains first, damped to avoid flipping back
        other = np.bincount(src, side[dst] != side[src], n)
        gain = 2 * other - degree
        a, b = (np.flatnonzero(m)[np.argsort(-gain[m], kind="stable")] for m in (~side, side))
        m = min(len(a), len(b), max(1, n // 20))
        good = int(np.count_nonzero(gain[a[:m]] + gain[b[:m]] > 0))
        if not good:
            break
        side[a[:good]], side[b[:good]] = True, False
    return nodes[~side], nodes[side]


def balanced_partitions(graph: list[np.ndarray], parts: int, seed: int = 7) -> np.ndarray:
    """A partition per node, equal sizes but for one node; ``parts`` is a power of two."""
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(graph))]
    while len(groups) < parts:
        groups = [half for g in groups for half in bisect(g, graph, rng)]
    label = np.zeros(len(graph), np.int64)
    for k, g in enumerate(groups):
        label[g] = k
    return label


@dataclass
class Router:
    """A small classifier from vectors to partitions."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train(x: np.ndarray, goal: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS, seed: int = 7) -> Router:
    """Full-batch Adam with weight decay on the cross entropy to ``goal``, rows of probabilities."""
    rng = np.random.default_rng(seed)
    dim, parts = x.shape[1], goal.shape[1]
    p = [rng.standard_normal((dim, hidden)) * np.sqrt(2 / dim), np.zeros(hidden), rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts)]
    m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for t in range(1, (steps if parts > 1 else 0) + 1):
        h = np.maximum(x @ p[0] + p[1], 0)
        z = h @ p[2] + p[3]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        d = (e / e.sum(axis=1, keepdims=True) - goal) / len(x)
        back = (d @ p[2].T) * (h > 0)
        grads = [x.T @ back, back.sum(0), h.T @ d, d.sum(0)]
        for k, g in enumerate(grads):
            g = g + DECAY * p[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            p[k] = p[k] - 0.02 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Router(*p)


def fit(vectors: DataFrame, sample: int = SAMPLE, partitions: int = PARTITIONS, neighbours: int = NEIGHBOURS) -> Router | None:
    """The router learnt from at most ``sample`` of ``vectors`` (id, vec); None without vectors."""
    drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").collect()
    if not drawn:
        return None
    x = unit(np.array([r["vec"] for r in drawn], float))
    parts = 1
    while parts * 2 <= min(partitions, len(x) // LEAST):
        parts *= 2
    graph = neighbour_graph(x, neighbours)
    label = balanced_partitions(graph, parts)
    # a vector's goal is where its neighbours are, as those are what its queries look for
    goal = np.array([np.bincount(label[near], minlength=parts) / len(near) if len(near) else np.eye(parts)[label[i]] for i, near in enumerate(graph)])
    return train(x, goal)


def _pack(router_of, size: int, probes):
    """Blocks (part, block, ids, vecs) of rows under their most probable partition, or those to probe."""

    def run(batches):
        router, task, made = Router(*router_of.value), TaskContext.get().partitionId(), 0
        held: dict[int, tuple[list, list]] = {}

        def block(part):
            nonlocal made
            ids, vecs = held.pop(part)
            made += 1
            return pd.DataFrame({"part": [part], "block": [(task << 32) + made], "ids": [np.array(ids, np.int64).tobytes()], "vecs": [np.array(vecs, float).tobytes()]})

        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch["vec"].tolist(), float)
            z = router.logits(x)
            goes = [[p] for p in z.argmax(axis=1).tolist()] if probes is None else [probes(r) for r in z]
            for i, v, parts in zip(batch["id"].tolist(), x, goes):
                for p in parts:
                    ids, vecs = held.setdefault(p, ([], []))
                    ids.append(i)
                    vecs.append(v)
                    if len(ids) == size:
                        yield block(p)
        for part in sorted(held):
            yield block(part)

    return run


def _search(k: int):
    def run(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, qids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                terms = np.ascontiguousarray(np.frombuffer(r.vecs, float).reshape(len(ids), -1).T)
                out = []
                for qid, q in zip(qids.tolist(), np.frombuffer(r.q_vecs, float).reshape(len(qids), -1)):
                    scores = np.zeros(len(ids))
                    for w, column in zip(q.tolist(), terms):  # summed in the vector's order, alike for equal vectors
                        scores += w * column
                    out += [(qid, int(ids[i]), float(scores[i])) for i in best(scores, ids, qid, k)]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, probed: float = PROBED, sample: int = SAMPLE,
            partitions: int = PARTITIONS) -> DataFrame:
    """Both (id, vec): query_id, rank (from 1), vec_id, score (inner product in double precision) of what is found."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "ann")
    some = F.exists("vec", lambda x: x != 0)
    clean = lambda df: df.where(F.col("id").isNotNull() & usable(F.col("vec")) & some).select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    rows = clean(vectors)
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = sizes["dim"] if sizes else 0
    rows = rows.where(F.size("vec") == dim)
    asked = clean(queries).where(F.size("vec") == dim).groupBy("id").agg(F.min("vec").alias("vec"))
    router = fit(rows, sample, partitions)
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = spark.sparkContext.broadcast((router.w1, router.b1, router.w2, router.b2))
    packed = "part int, block long, ids binary, vecs binary"
    probes = max(1, round(probed * router.w2.shape[1]))
    cand = scratch.keep("index", rows.mapInPandas(_pack(model, BLOCK, None), packed))
    held = {r["part"]: (r["rows"], r["blocks"]) for r in cand.groupBy("part").agg(F.sum(F.length("ids") / 8).alias("rows"), F.count(F.lit(1)).alias("blocks")).collect()}
    have = {p: int(n) for p, (n, _) in held.items()}

    def goes(z: np.ndarray) -> list[int]:
        """The most probable partitions, and further ones until they hold k rows beside the query."""
        out, found = [], 0
        for n, p in enumerate(np.argsort(-z, kind="stable").tolist()):
            if n >= probes and found > k:
                break
            if have.get(p):
                out.append(p)
                found += have[p]
        return out

    quer = scratch.keep("queries", asked.mapInPandas(_pack(model, QUERY_BLOCK, goes), packed))
    lanes = max(n for _, n in held.values())
    left = cand.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")).drop("block")
    right = quer.select("part", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"))
    found = left.join(right, ["part", "lane"]).mapInPandas(_search(k), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
