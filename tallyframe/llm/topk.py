"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

A vector is a sparse row: its non-zero components are weighted terms.
Candidates are packed into blocks of at most ``block`` rows with a posting list
(rows, weights) per term; queries into blocks of at most ``query_block`` rows.
Every candidate block meets every query block in a product of their partitions: a
task reads some candidate blocks and holds at most a few query blocks, so no side is
broadcast or copied once for every block of the other one.  In a task, each query scatters its weighted postings into a dense score array, term
by term; a partition selection keeps the k best of the block with all ties that
could matter, and a window merges the blocks' lists.

Defined results: vectors that are null or hold a null or non-finite component,
and rows without id, take no part; a query never meets rows of its own id; of
several query rows with one id the smallest vector counts; shorter vectors have
zeros at the end; ties go to the smaller id; repeated candidate rows are
reported as often as they come; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.llm.common import Scratch, ship

BLOCK, QUERY_BLOCK = 8192, 256
#: Query blocks that a task is dealt, on average: it holds them while it reads candidate blocks.
TASK_BLOCKS = 8
#: Whole numbers below it are exact in a double; larger sums are made with Python's whole numbers.
EXACT = float(1 << 53)


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def blocks_of(batches, size: int):
    """(block, ids, rows of terms) of at most ``size`` vectors; block numbers are the same when a task runs again."""
    part, n, ids, vecs = TaskContext.get().partitionId(), 0, [], []
    for batch in batches:
        for i, v in zip(batch["id"], batch["vec"]):
            ids.append(i)
            vecs.append(np.asarray(v, np.float64))
            if len(ids) == size:
                yield (part << 32) + n, ids, vecs
                n, ids, vecs = n + 1, [], []
    if ids:
        yield (part << 32) + n, ids, vecs


def sparse(vecs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of every non-zero component."""
    row = np.repeat(np.arange(len(vecs), dtype=np.int32), [len(v) for v in vecs])
    term = np.concatenate([np.arange(len(v), dtype=np.int32) for v in vecs])
    weight = np.concatenate(vecs)
    at = np.flatnonzero(weight)
    return row[at], term[at], weight[at]


def _pack(size: int, by_term: bool):
    def run(batches):
        for block, ids, vecs in blocks_of(batches, size):
            row, term, weight = sparse(vecs)
            if by_term:
                order = np.argsort(term, kind="stable")
                row, term, weight = row[order], term[order], weight[order]
            yield pd.DataFrame({"block": [block], "ids": [np.asarray(ids, np.int64).tobytes()], "row": [row.tobytes()],
                                "term": [term.tobytes()], "weight": [weight.tobytes()]})

    return run


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, without rows of id ``own``."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        part = scores[at]
        least = np.partition(part, len(part) - k)[len(part) - k]
        at = at[part >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def accumulate(query: list[tuple[int, float]], postings: dict[int, tuple[np.ndarray, np.ndarray]], n: int, exact: bool) -> np.ndarray:
    """Dense scores of the n rows of a block: one scatter of weighted postings per query term."""
    scores = np.zeros(n) if exact else np.array([0] * n, object)
    for term, w in query:
        found = postings.get(term)
        if found is None:
            continue
        rows, weights = found
        if not exact:
            w, weights = int(w), np.array([int(x) for x in weights], object)
        if len(rows) == n:
            scores += w * weights
        else:
            scores[rows] += w * weights
    return scores


def _score(k: int):
    def run(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, qids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                rows, terms, weights = (np.frombuffer(x, t) for x, t in ((r.row, np.int32), (r.term, np.int32), (r.weight, np.float64)))
                q_rows, q_terms, q_weights = (np.frombuffer(x, t) for x, t in ((r.q_row, np.int32), (r.q_term, np.int32), (r.q_weight, np.float64)))
                edges = np.flatnonzero(np.diff(terms, prepend=-1, append=-1))
                postings = {int(terms[a]): (rows[a:b], weights[a:b]) for a, b in zip(edges, edges[1:])}
                top = lambda x: float(np.abs(x).max()) if len(x) else 0.0
                exact = top(weights) * top(q_weights) * max(len(postings), 1) < EXACT
                starts = np.searchsorted(q_rows, np.arange(len(qids) + 1))
                out = []
                for q, qid in enumerate(qids):
                    own = slice(starts[q], starts[q + 1])
                    scores = accumulate(list(zip(q_terms[own].tolist(), q_weights[own].tolist())), postings, len(ids), exact)
                    at = best(scores, ids, int(qid), k)
                    out += [(int(qid), int(ids[i]), max(min(int(scores[i]), 2**63 - 1), -2**63)) for i in at]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Both (id, vec array<double> of whole numbers): query_id, rank (from 1), vec_id, score of each query's k best."""
    spark = candidates.sparkSession
    ship(spark)
    scratch = Scratch(spark, "topk")
    packed = "block long, ids binary, row binary, term binary, weight binary"
    fit = lambda df: df.where(F.col("id").isNotNull() & usable(F.col("vec"))).select(F.col("id").cast("long"), "vec")
    cand = scratch.keep("candidates", fit(candidates).mapInPandas(_pack(block, True), packed))
    # evened out first: queries may stand together in a few files
    asked = fit(queries).groupBy("id").agg(F.min("vec").alias("vec"))
    quer = scratch.keep("queries", asked.mapInPandas(_pack(query_block, False), packed))
    shares = max(1, -(-quer.count() // TASK_BLOCKS))
    asking = quer.select(*(F.col(c).alias(f"q_{c}") for c in ("ids", "row", "term", "weight"))).repartition(shares)
    pairs = cand.drop("block").crossJoin(asking.hint("shuffle_replicate_nl"))  # a product: Spark would broadcast a side that looks small
    found = pairs.mapInPandas(_score(k), "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
