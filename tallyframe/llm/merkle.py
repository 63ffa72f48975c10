"""Merkle manifest of a table: a root digest a group, one over all groups, and a proof for every row.

A row's leaf is the digest of its fields; in each group leaves stand in order,
and runs of ``FANOUT`` consecutive nodes become one parent until one node is
left.  Group roots make the top tree in the same way.

Per level, ``lag`` and ``lead`` columns of fixed offsets, masked by a node's slot
and its run's length, hold the siblings, and the first row of a run hashes
the parent.  Both follow from a node's index and its group's size alone, so a
window covers one run (at most ``FANOUT`` rows) and a group that holds a
third of all rows spreads over all tasks.  Indexes come from a range
sort: a row's place in its sorted partition plus the rows of its group in
earlier partitions.  Every level is written; levels shrink sixteenfold.

On the way down a parent hands its path (siblings of each level above) to its
children by a join on (group, run), which the window's exchange already serves,
so only the rows' own digests are shuffled, never whole proofs of all rows.

Defined results: each row is a leaf of its own, repeated rows and repeated or
null ids too (order: id, nulls first, then leaf digest); null texts and fields
hash as ``-``; a null source is a group, the first; extra columns take no part,
whatever their names; an empty table gives an empty result and no root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import LOWER, UPPER, Scratch, indexed

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row of ``FIELDS``."""
    return sha(*(framed(fields[name]) for name in FIELDS))


def with_siblings(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``nodes`` (grp, n, idx, digest, ...) with run, slot and the digests ``left`` and ``right`` of each in its run."""
    over = "OVER (PARTITION BY grp, run ORDER BY idx)"
    before = ", ".join(f"CASE WHEN slot >= {k} THEN lag(digest, {k}) {over} END" for k in range(fanout - 1, 0, -1))
    after = ", ".join(f"CASE WHEN slot + {k} < length THEN lead(digest, {k}) {over} END" for k in range(1, fanout))
    return (nodes.selectExpr("*", f"idx div {fanout} AS run", f"CAST(idx % {fanout} AS INT) AS slot")
            .selectExpr("*", f"least({fanout}, n - run * {fanout}) AS length")
            .selectExpr("*", f"concat_ws('', {before}) AS left", f"concat_ws('', {after}) AS right"))


def build(nodes: DataFrame, scratch: Scratch, label: str, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels from ``nodes`` (grp, n, idx, digest, ...) up; a group stops at the level where it has one node.

    Upper levels are written with their siblings, as both ways need them; those of level 0, which
    are fifteen times its size, are made again on the way down.
    """
    levels, rows = [nodes], with_siblings(nodes.select("grp", "n", "idx", "digest"), fanout)
    while True:
        parents = rows.where("slot = 0 AND n > 1").select(
            "grp", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), F.col("run").alias("idx"),
            sha(F.col("digest"), F.col("right")).alias("digest"))
        rows = scratch.keep(f"{label}-{len(levels)}", with_siblings(parents, fanout))
        if rows.isEmpty():
            return levels
        levels.append(rows)


def roots(levels: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the node that is left of each group."""
    return reduce(DataFrame.unionByName, (x.where("n = 1").select("grp", "digest") for x in levels))


def paths(levels: list[DataFrame], base: DataFrame, scratch: Scratch, label: str, fanout: int = FANOUT) -> DataFrame:
    """The rows of level 0 with the columns of ``base`` (grp, path, ...), ``path`` led by the siblings of each level."""
    kept = [c for c in base.columns if c not in ("grp", "path")]
    above = None
    for k in range(len(levels) - 1, -1, -1):
        own = levels[0].columns if k == 0 else ["grp", "n", "idx", "digest"]
        out = levels[k].where("n = 1").join(base, "grp").select(*own, "path", *kept)
        if above is not None:
            up = above.select("grp", F.col("idx").alias("run"), F.col("path").alias("rest"), *kept)
            step = F.array(F.struct(F.col("left"), F.col("right")))
            rows = (with_siblings(levels[0], fanout) if k == 0 else levels[k]).where("n > 1")
            deep = rows.join(up, ["grp", "run"])
            out = out.unionByName(deep.select(*own, F.concat(step, F.col("rest")).alias("path"), *kept))
        above = scratch.keep(f"{label}-paths-{k}", out) if k else out
    return above


def fold(digest: Column, path: Column) -> Column:
    """The root that ``digest`` leads to along its siblings."""
    return F.aggregate(path, digest, lambda acc, p: sha(p["left"], acc, p["right"]))


def manifest(docs: DataFrame, group: str = "source") -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, path (siblings level by level) and ``tampered``, the leaf of a spoilt copy.

    The copy differs from the row where 5 divides crc32 of its id: there its text has A-Z lower-cased.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    given = {name: F.col(name) for name in FIELDS}
    spoilt = {**given, "text": F.translate("text", UPPER, LOWER)}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("grp"),
                         "doc_id", leaf(given).alias("digest"), F.when(hit, leaf(spoilt)).alias("tampered"))
    leaves = leaves.withColumn("tampered", F.coalesce("tampered", "digest"))
    rows = build(indexed(leaves, "grp", ["doc_id", "digest", "tampered"], scratch, "leaves"), scratch, "group")

    subroots = scratch.keep("subroots", roots(rows).select(F.lit("").alias("grp"), F.col("grp").alias("label"), "digest"))
    top = build(indexed(subroots, "grp", ["label"], scratch, "labels"), scratch, "top")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    crown = roots(top).select("grp", nothing.alias("path"), F.col("digest").alias("root"))
    base = paths(top, crown, scratch, "top").select(F.col("label").alias("grp"), "path", "root", F.col("digest").alias("subroot"))
    base = scratch.keep("base", base)
    return paths(rows, base, scratch, "group").select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "tampered")


def verify(found: DataFrame) -> DataFrame:
    """Rows of :func:`manifest` with the digest of their proof, the root that the spoilt copy folds to, and whether it is the root."""
    proof = sha(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""))
    out = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"),
                       fold(F.col("tampered"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
