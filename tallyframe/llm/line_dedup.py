"""Line deduplication: lines that many documents share are dropped from all of them.

Only DataFrame functions on the main path.  Lines are exploded and their
normalised keys hashed to 128 bits; distinct documents are counted per hash
(repeated lines of one document collapse before the shuffle); hashes over the
threshold go back to their documents, and each text is put together again from
the lines that stay, by position.  No text leaves its row before that last join.

Defined results: a null or empty text is one empty line; an empty key (a blank
line) never counts as shared; rows with the same ``doc_id`` count as one
document and each is cleaned on its own; null ``doc_id`` is one document; extra
columns are carried along whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import ASCII_SPACE, LOWER, UPPER, Scratch, free_name, hash128

MIN_DOCS, MIN_CHARS = 10, 1


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def document_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, version, pos, h1, h2) of the lines whose key has at least ``min_chars`` code points.

    ``version`` is a hash of the whole text: it tells rows with the same ``doc_id`` apart.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"),
                        F.posexplode(F.transform(text_lines(F.col("text")), line_key)).alias("pos", "key"))
    return (lines.where(F.length("key") >= min_chars)
            .select("doc_id", "version", "pos", *(h.alias(n) for h, n in zip(hash128("key"), ("h1", "h2")))))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                out: str = "kept_text") -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``n_lines``, ``n_dropped`` (long) and the cleaned text as ``out``.

    Columns of these three names are replaced, all others stay.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    lines = scratch.keep("lines", document_lines(docs.select("doc_id", "text"), min_chars))
    shared = (lines.select("doc_id", "h1", "h2").distinct()
              .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).drop("n"))
    names = ("dedup_id", "dedup_version", "dedup_gone", "dedup_parts", "dedup_stay")
    key, version, gone, parts, stay = (free_name(docs, x) for x in names)
    hits = (lines.join(shared, ["h1", "h2"]).groupBy(F.col("doc_id").alias(key), F.col("version").alias(version))
            .agg(F.collect_set("pos").alias(gone)))
    joined = docs.join(hits, docs["doc_id"].eqNullSafe(hits[key]) & (F.xxhash64(docs["text"]) == hits[version]), "left")
    everything = F.sequence(F.lit(0), F.size(parts) - 1)
    return (joined.withColumn(parts, text_lines(F.col("text")))
            .withColumn(stay, F.array_except(everything, F.coalesce(F.col(gone), F.array().cast("array<int>"))))
            .withColumn("n_lines", F.size(parts).cast("long"))
            .withColumn("n_dropped", (F.size(parts) - F.size(stay)).cast("long"))
            .withColumn(out, F.array_join(F.transform(stay, lambda i: F.get(F.col(parts), i)), "\n"))
            .drop(key, version, gone, parts, stay))
