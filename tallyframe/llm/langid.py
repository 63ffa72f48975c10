"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features are the 1- to 3-grams of the lower-cased text's code points, hashed to
``buckets`` columns.  The model is fitted on at most about ``sample_rows``
labelled rows of each language (rows whose hashed id falls under a rate; the
bound is a parameter) by counting n-grams in the tasks; the counts, languages x
buckets at most, make the log-probability matrix that is broadcast.  Scoring is
numpy, text by text in bounded pieces: a gather of matrix rows and a
sum per text.  Texts are read whole.

``in_language`` keeps the documents that have a language.  Its evidence is the
mean log likelihood of a text's n-grams under the language found, less that
under noise, where every bucket is as likely (1 / ``buckets``); a text with less
than ``EVIDENCE`` is likelier noise than any language learnt, as are hex and
base64 runs, rows of figures, symbols, and scripts that no labelled row has.
Without a model every document with text stays.

Defined results: null text, or text without a letter, is ``und`` with score 0;
rows with null ``lang`` teach nothing; with no labelled row every text is
``und``; ties go to the first language by name; repeated rows are counted as
they come; extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, ship

BUCKETS, SAMPLE_ROWS, SMOOTHING, UNKNOWN = 1 << 15, 10_000, 0.5, "und"
#: Nats per n-gram over uniform noise that ``in_language`` asks for; less only by rounding.
EVIDENCE = -1e-9
#: Code points scored at once.
PIECE = 1 << 18


def grams(text: str, buckets: int) -> list[np.ndarray]:
    """Hashed 1-, 2- and 3-grams of the text, in that order."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    mask = np.uint32(buckets - 1)
    out, h = [], np.zeros(len(c), np.uint32)
    for n in range(3):
        if len(c) <= n:
            break
        h = h[:len(c) - n] * np.uint32(0x01000193) + c[n:] + np.uint32(1)
        mixed = h * np.uint32(0x9E3779B1)
        out.append((mixed ^ (mixed >> np.uint32(15))) & mask)
    return out


def pieces(text: str):
    """Cuts of a long text, so that memory stays bounded; the n-grams across a cut are left out in training and scoring alike."""
    for at in range(0, max(len(text), 1), PIECE):
        yield text[at:at + PIECE]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Model:
    """Languages, their log priors and the buckets x languages matrix of log probabilities."""

    def __init__(self, langs: list[str], prior: np.ndarray, logp: np.ndarray):
        self.langs, self.prior, self.logp = langs, prior, logp

    def score(self, text: str) -> tuple[np.ndarray, int]:
        """Log posterior by language, not normalised, and the number of n-grams."""
        total, n = self.prior.copy(), 0
        for piece in pieces(text):
            for h in grams(piece, len(self.logp)):
                total += self.logp[h].sum(axis=0, dtype=np.float64)
                n += len(h)
        return total, n

    def predict(self, text) -> tuple[str, float]:
        if not isinstance(text, str) or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        total, _ = self.score(text)
        best = int(np.argmax(total))
        return self.langs[best], float(1.0 / np.exp(total - total[best]).sum())

    def evidence(self, text) -> float:
        """Nats per n-gram by which the language found is likelier than noise; -inf for a text that is ``und``."""
        if not isinstance(text, str) or not self.langs or not has_letter(text):
            return -np.inf
        total, n = self.score(text)
        best = int(np.argmax(total))
        return float((total[best] - self.prior[best]) / n + np.log(len(self.logp)))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> Model:
    """Fits on ``labelled`` (doc_id, text, lang); rows with a null lang or text are left out."""
    ship(labelled.sparkSession)
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string"))
    known = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(known)
    if not langs:
        return Model([], np.zeros(0), np.zeros((buckets, 0)))
    rate = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(min(1.0, sample_rows / known[k])))))
    draw = (F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid")).bitwiseAND(0xFFFFFF)) / float(1 << 24)
    sample = rows.where(draw < rate[F.col("lang")]).select("text", "lang")

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                into = held.setdefault(lang, np.zeros(buckets, np.int64))
                for piece in pieces(text):
                    for h in grams(piece, buckets):
                        into += np.bincount(h, minlength=buckets)
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": counts[at]})

    counted = (sample.mapInPandas(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    table = np.full((buckets, len(langs)), smoothing)
    np.add.at(table, (counted["bucket"].to_numpy(int), [langs.index(x) for x in counted["lang"]]), counted["n"].to_numpy(float))
    prior = np.log(np.array([known[k] for k in langs], float) / sum(known.values()))
    return Model(langs, prior, np.log(table / table.sum(axis=0)))


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior; only the text is read for it."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.prior, model.logp))

    @F.pandas_udf("lang string, score double")
    def run(text: pd.Series) -> pd.DataFrame:
        own = Model(*shared.value)
        return pd.DataFrame([own.predict(t) for t in text], columns=["lang", "score"])

    made = free_name(docs, "langid_made")
    return (docs.withColumn(made, run(F.col("text"))).withColumn(lang, F.col(f"{made}.lang"))
            .withColumn(score, F.col(f"{made}.score")).drop(made))


def in_language(docs: DataFrame, model: Model, least: float = EVIDENCE) -> DataFrame:
    """The rows of ``docs`` whose text has a language; all with text (more than white space) where none was learnt."""
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\S"))
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.prior, model.logp))

    @F.pandas_udf("boolean")
    def has(text: pd.Series) -> pd.Series:
        own = Model(*shared.value)
        return pd.Series([own.evidence(t) >= least for t in text], dtype=bool)

    return docs.where(has(F.col("text")))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; such rows are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
