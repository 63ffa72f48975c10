"""A training-data pipeline over ``documents``: language, shared lines, near copies, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.  ``run`` chains them over a table, with a
written copy between stages so that a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import langid, line_dedup, minhash, packing, pii
from tallyframe.llm.common import Scratch, free_name
from tallyframe.llm.registry import vocabulary


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` before ``text`` was added, with ``text`` as their text and its length as n_chars."""
    kept = [c for c in docs.columns if c != text]
    new = {"text": F.col(text), "n_chars": F.coalesce(F.length(text), F.lit(0)).cast("long")}
    return docs.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in kept))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter, or likelier noise than any language learnt.

    Where no row that may be learnt from has a language, all documents with text stay.
    """
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.in_language(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go."""
    text = free_name(docs, "kept_text")
    out = line_dedup.dedup_lines(docs, out=text)
    return _with_text(out.select(*(f"`{c}`" for c in docs.columns), text), text)


def _text_key(docs: DataFrame) -> Column:
    """Id and text hash as one string that sorts as the id does (whole numbers, strings), rows without id last."""
    whole = docs.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    as_text = (F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-2**63))), 16, "0") if whole
               else F.hex(F.col("doc_id").cast("string").cast("binary")))
    return F.concat_ws(" ", F.coalesce(as_text, F.lit("~")), F.lpad(F.hex(F.xxhash64("text")), 16, "0"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each near-duplicate group stays, that with the smallest id.

    ``near_duplicates`` compares one text an id, so where ids repeat or are null each (id, text) is a document of its own;
    one of its rows stays.
    """
    rows, key = docs, "doc_id"
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty():
        key = free_name(docs, "near_key")
        rows = docs.withColumn(key, _text_key(docs)).dropDuplicates([key])
    found = minhash.near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(free_name(rows, "gone_id")))
    return rows.join(gone, rows[key] == gone[gone.columns[0]], "left_anti").select(*(f"`{c}`" for c in docs.columns))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that give it away, are replaced or removed."""
    text = free_name(docs, "clean_text")
    clean = pii.sanitise(docs.select("*"))
    clean = clean.select(*(F.col(f"`{c}`") for c in docs.columns), F.col("text").alias(text))
    return _with_text(clean, text)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as sequences of 2048 tokens: a row per piece."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("pii", sanitise),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(name, stage(spark, docs, sf_dir))
    return docs
