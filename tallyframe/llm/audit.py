"""Interaction of document filters: what every order of them removes, per part of a corpus.

Each filter keeps a posting list per part: the sorted numbers of the rows that
fail it.  Rows are numbered by a range sort on (part, id), and lists are cut into
ranges of ``RANGE`` numbers, so a list of any length is a set of short ones
that are merged on their own.  In a range, the union of any set of filters is a
k-way merge of their lists (shorter lists are sought in the longest,
every search going on from the last one's place); what a filter removes after
others is the difference of its list from their union, and how many good or toxic
documents that costs is the part of the difference in their lists.  Sizes
are summed over ranges: 80 figures a part (5 filters after any of 16 sets of
others), from which all 120 orders and their steps follow.

Defined results: every row is a document, also where ids repeat or are null;
null texts are empty; a row is a copy if another row with a smaller id has an
equal text (a null id is neither smaller nor larger); a document with
several label rows is good or toxic if one of them says so; extra columns take no
part; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import UPPER, Scratch, ship

FILTERS = "ABCDE"
MARKS = b"#$%&*|"
RANGE_BITS = 14
#: Lists of each range: a filter's failing rows, and the rows that are labelled good or toxic.
LISTS = (*FILTERS, "good", "toxic")


def text_failures(data: bytes) -> tuple[bool, bool, bool, bool]:
    """Filters A to D: few words, few distinct words, many capitals, marks."""
    words = data.split()  # at ASCII white space: 0x20, 0x09-0x0D
    capitals = len(data) - len(data.translate(None, UPPER.encode()))
    points = len(data) - np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80)  # UTF-8 without continuation bytes
    return (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * capitals > 10 * points,
            len(data.translate(None, MARKS)) < len(data))


def _measure(batches):
    for batch in batches:
        texts = [t.encode() if isinstance(t, str) else b"" for t in batch["text"]]
        fails = np.array([text_failures(t) for t in texts], bool).reshape(-1, 4)
        yield pd.DataFrame({"doc_id": batch["doc_id"], "part": batch["lang"].fillna(""),
                            **{name: fails[:, k] for k, name in enumerate("ABCD")},
                            "digest": [hashlib.sha256(t).digest() for t in texts]})


def measured(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Per row of ``docs``: part, doc_id, a flag for each filter, good, toxic."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    flags = ", ".join(f"{x} boolean" for x in "ABCD")
    rows = scratch.keep("measured", docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).mapInPandas(
        _measure, f"doc_id {kind}, part string, {flags}, digest binary"))
    copies = (rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .where("first < last").drop("last"))
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    return (rows.join(copies, "digest", "left").join(said, "doc_id", "left")
            .select("part", "doc_id", *"ABCD", F.coalesce(F.col("doc_id") > F.col("first"), no).alias("E"),
                    F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")))


def postings(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Posting lists (part, range, n rows, an ascending array of row numbers for each of ``LISTS``)."""
    scratch = Scratch(docs.sparkSession, "audit")
    rows = measured(docs, labels, scratch)
    order = ["part", "doc_id", *LISTS]
    numbered = scratch.keep("numbered", rows.repartitionByRange(*order).sortWithinPartitions(*order)
                            .select("part", F.monotonically_increasing_id().alias("row"), *LISTS))
    lists = [F.sort_array(F.collect_list(F.when(F.col(x), F.col("row")))).alias(x) for x in LISTS]
    return scratch.keep("postings", numbered.groupBy("part", F.shiftright("row", RANGE_BITS).alias("range"))
                        .agg(F.count(F.lit(1)).alias("n"), *lists))


def among(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the ascending ``ids`` are in the ascending ``others``."""
    if not len(others):
        return np.zeros(len(ids), bool)
    at = np.searchsorted(others, ids)
    return others[np.minimum(at, len(others) - 1)] == ids


def union(lists: list[np.ndarray]) -> np.ndarray:
    """k-way union: what is new of each shorter list goes into the longest at the place found for it."""
    rest = sorted(lists, key=len)
    out = rest.pop() if rest else np.zeros(0, np.int64)
    for ids in reversed(rest):
        new = ids[~among(ids, out)]
        out = np.insert(out, np.searchsorted(out, new), new)
    return out


def _differences(batches):
    names = ["part", "filter", "before", "rows", "gone", "removed", "good", "toxic"]
    for batch in batches:
        found = []
        for row in batch.to_dict("records"):
            lists = {x: np.asarray(row[x], np.int64) for x in LISTS}
            for mask in range(32):
                gone = union([lists[x] for k, x in enumerate(FILTERS) if mask >> k & 1])
                for k, x in enumerate(FILTERS):
                    if not mask >> k & 1:
                        left = lists[x][~among(lists[x], gone)]
                        lost = [int(among(left, lists[label]).sum()) for label in ("good", "toxic")]
                        found.append((row["part"], x, mask, row["n"], len(gone), len(left), *lost))
        yield pd.DataFrame(found, columns=names)


def interactions(lists: DataFrame) -> DataFrame:
    """Per part, filter and set of filters before it (a bit each): rows, gone before, removed, good and toxic ones removed."""
    ship(lists.sparkSession)
    sums = lists.mapInPandas(_differences, "part string, filter string, before int, rows long, gone long, removed long, good long, toxic long")
    return sums.groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in ("rows", "gone", "removed", "good", "toxic")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    spark = docs.sparkSession
    sums = Scratch(spark, "audit-sums").keep("sums", interactions(postings(docs, labels)))
    bit = reduce(lambda c, kx: c.when(F.col("filter") == kx[1], 1 << kx[0]), list(enumerate(FILTERS))[1:], F.when(F.col("filter") == "A", 1))
    # A set of s filters stands before a given one in s! * (4 - s)! of the orders.
    orders = F.element_at(F.array(*(F.lit(factorial(s) * factorial(4 - s)) for s in range(5))), F.bit_count("before") + 1)
    totals = sums.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(F.col("before") == 31 - bit, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * orders).alias("shapley"))
    steps = [("".join(p), k + 1, x, sum(1 << FILTERS.index(y) for y in p[:k])) for p in permutations(FILTERS) for k, x in enumerate(p)]
    plan = spark.createDataFrame(steps, "filter_order string, step int, filter string, before int")  # 600 rows, always
    return (sums.join(totals, ["part", "filter"]).join(F.broadcast(plan), ["filter", "before"])
            .select("part", "filter_order", "step", (F.col("rows") - F.col("gone") - F.col("removed")).alias("kept"), "removed",
                    (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", F.col("good").alias("good_lost"),
                    F.col("toxic").alias("toxic_lost"), F.col("shapley").cast("long").alias("shapley")))
