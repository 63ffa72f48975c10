"""Personal data: exact detection of four kinds, then information-theoretic sanitisation of what gives them away.

Base spans come from fixed patterns over the whole text.  The words of a window
around every base span nominate terms t for its entity value e.  Over the
corpus, the number n(t, e) of documents that name e and have t anywhere outside
base spans, the document frequencies n(t) (outside base spans too) and n(e) and
the number N of documents give

    PMI(t; e) = log2(n(t, e) N / (n(t) n(e)))      IC(e) = -log2(n(e) / N)

IC(e) - PMI(t; e) is what stays unknown of e, in bits, to one who reads t.  A
nominated term that tells at least the share ``told`` of IC(e) discloses e: it is removed
if it leaves at most ``remove_bits``, and replaced by its shape (``[NUMBER]``,
``[NAME]``, ``[TERM]``) if it leaves at most ``generalise_bits``, at every place outside
base spans in all documents.  An entity of under ``min_bits`` (one that so many documents
name, like a site's own address) has nothing to protect, and words that stand beside it by
chance tell nothing of it (PMI near 0); both stay.  Pairs need ``min_support``
documents, as a ratio of one or two documents tells nothing: terms of entities that
fewer documents name are out of the method's reach.

Three passes over the texts.  The first counts terms, entities and nominated
pairs; pairs that n(t) and n(e) alone rule out go.  The second counts n(t, e) of
the pairs left, the third writes a small row per document (base spans, and each
disclosing term once with all its places).  What a pass looks for is broadcast
as a bitmap of fixed size that may name too much and never too little; exact
joins settle the rest.  Counts are handed on in sums of bounded size, so a hot
entity or word is no hot group.

Defined results: a null or empty text has no spans; texts are read whole;
repeated rows count as documents of their own in the statistics, rows of the
same ``doc_id`` and text get the same spans; extra columns stay; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import Scratch, free_name, ship

KINDS = ("email", "ip", "card", "phone")
WINDOW, MIN_SUPPORT, REMOVE_BITS, GENERALISE_BITS = 6, 3, 1.0, 2.0
#: Least information content of an entity to protect, and share of it that a disclosing term tells.
MIN_BITS, TOLD = 2.0, 0.5
#: Counts of one task are handed on when so many terms, entities and pairs are held.
FLUSH = 200_000
#: Size of the bitmaps, and of the blocks they are made of.
BITS, BLOCK = 1 << 26, 1 << 15
#: Rows handed on at once, documents and terms.
ROWS, TERMS = 256, 20_000

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match ends with its last run of digits, so matches start where a run starts: long runs are read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from their ``@`` (each match has exactly one)."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind as listed; offsets in code points, end exclusive."""
    spans = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in (part.lstrip("0") for part in m[0].split("."))):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def entity(kind: int, value: str) -> str:
    """What makes two mentions the same protected entity."""
    plain = value.lower() if kind < 2 else re.sub("[^0-9]", "", value)
    return f"{KINDS[kind]}:{plain}"


class Covered:
    """Which ranges of a text the spans touch."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, _, e in spans:
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def touches(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.ends) and self.starts[k] < end


def context(text: str, spans: list[tuple[int, int, int]], covered: Covered, window: int) -> dict[tuple[str, str], None]:
    """(entity, term) of the ``window`` words on either side of each span, outside every span."""
    found: dict[tuple[str, str], None] = {}
    at = [m.span() for m in _WORD.finditer(text)] if spans else []
    starts, ends = [s for s, _ in at], [e for _, e in at]
    for start, kind, end in spans:
        who = entity(kind, text[start:end])
        before, after = bisect_right(ends, start), bisect_left(starts, end)
        for s, e in at[max(0, before - window):before] + at[after:after + window]:
            if not covered.touches(s, e):
                found[who, text[s:e].lower()] = None
    return found


def places(text: str, terms: set[str], covered: Covered) -> dict[str, list[int]]:
    """Start and end of every occurrence of the terms outside the base spans, flat."""
    out: dict[str, list[int]] = {t: [] for t in terms}
    for m in _WORD.finditer(text):
        at = out.get(m[0].lower())
        if at is not None and not covered.touches(*m.span()):
            at += m.span()
    return out


def words(text: str, covered: Covered) -> set[str]:
    """The lower-cased words outside the base spans."""
    if not covered.starts:
        return {w.lower() for w in set(_WORD.findall(text))}
    return {m[0].lower() for m in _WORD.finditer(text) if not covered.touches(*m.span())}


def pair_key(who: str, term: str) -> str:
    return f"{who}\0{term}"


def marks(spark: SparkSession, keys: DataFrame):
    """Broadcast bitmap with the bit of every ``key``, by its crc32."""
    at = F.crc32(F.col("key").cast("binary")) % BITS
    blocks = (keys.select(F.floor(at / BLOCK).alias("block"), (at % BLOCK).alias("bit")).distinct().repartition("block")
              .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = bytearray(BITS // 8)
    for r in blocks.toLocalIterator():
        out[r["block"] * (BLOCK // 8):(r["block"] + 1) * (BLOCK // 8)] = r["bits"]
    return spark.sparkContext.broadcast(bytes(out))


def marked(bits: bytes, key: str, before: int = 0) -> bool:
    """Whether the bit of ``key`` is set; ``before`` is the crc32 of what stands before it."""
    at = zlib.crc32(key.encode(), before) % BITS
    return bits[at >> 3] >> (at & 7) & 1 == 1


class Sums:
    """Counts by (entity, term), handed on at a bounded size; an empty side stands for any."""

    COLUMNS = ["entity", "term", "n", "kind"]
    SCHEMA = "entity string, term string, n long, kind string"

    def __init__(self):
        self.seen: Counter[tuple[str, str]] = Counter()

    def flush(self, least: int = 0):
        if len(self.seen) <= least:
            return
        held = [(e, t, n, "pair" if e and t else "entity" if e else "term") for (e, t), n in self.seen.items()]
        self.seen.clear()
        for k in range(0, len(held), TERMS):
            yield pd.DataFrame(held[k:k + TERMS], columns=self.COLUMNS, dtype=object)


def _count(window: int):
    """Documents by term and by entity, and the pairs that windows nominate."""

    def count(batches):
        sums = Sums()
        for batch in batches:
            for text in batch["text"]:
                if not isinstance(text, str):
                    continue
                spans = base_spans(text)
                covered = Covered(spans)
                sums.seen.update([("", t) for t in words(text, covered)])
                if spans:
                    sums.seen.update({(entity(k, text[s:e]), "") for s, k, e in spans})
                    sums.seen.update(context(text, spans, covered, window).keys())
                yield from sums.flush(FLUSH)
        yield from sums.flush()

    return count


def _together(shared):
    """Documents by marked pair: they name the entity and have the term anywhere outside base spans."""

    def count(batches):
        bits, sums = shared.value, Sums()
        for batch in batches:
            for text in batch["text"]:
                if not isinstance(text, str):
                    continue
                spans = base_spans(text)
                named = {who for who in {entity(k, text[s:e]) for s, k, e in spans} if marked(bits, who)}
                terms = [t for t in words(text, Covered(spans)) if marked(bits, t)] if named else []
                for who in named:
                    before = zlib.crc32(pair_key(who, "").encode())
                    sums.seen.update([(who, t) for t in terms if marked(bits, t, before)])
                    yield from sums.flush(FLUSH)
        yield from sums.flush()

    return count


def _scan(window: int, shared=None):
    """A row per document with its base spans and the places of the marked terms; without marks, of those in windows."""
    columns = ["doc_id", "version", *KINDS, "base", "at_terms", "at"]

    def scan(batches):
        if shared is not None:
            bits = shared.value
            known = lru_cache(1 << 16)(lambda term: marked(bits, term))
        for batch in batches:
            rows = []
            for doc_id, text, version in zip(batch["doc_id"], batch["text"], batch["version"]):
                text = text if isinstance(text, str) else ""
                spans = base_spans(text)
                counts = Counter(k for _, k, _ in spans)
                covered = Covered(spans)
                terms = {t for _, t in context(text, spans, covered, window)} if shared is None else {t for t in words(text, covered) if known(t)}
                at = places(text, terms, covered) if terms else {}
                base = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
                rows.append((doc_id, version, *(counts[k] for k in range(4)), base, list(at), list(at.values())))
                if len(rows) == ROWS:
                    yield pd.DataFrame(rows, columns=columns, dtype=object)
                    rows = []
            yield pd.DataFrame(rows, columns=columns, dtype=object)

    return scan


def shape(term: str) -> str:
    return "[NUMBER]" if term.isdigit() else "[NAME]" if term[:1].isupper() else "[TERM]"


def find(docs: DataFrame, window: int = WINDOW, min_support: int = MIN_SUPPORT, remove_bits: float = REMOVE_BITS,
         generalise_bits: float = GENERALISE_BITS, min_bits: float = MIN_BITS, told: float = TOLD) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, version, n_<kind>, base, added, spans.

    ``version`` is xxhash64 of the text; ``base`` and ``added`` hold
    ``kind:start:end``, comma-joined by start; added kinds are ``removed`` and ``generalised``;
    ``spans`` holds both.  One Python function makes both at the end, so a task has one worker.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "pii")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, version long, " + ", ".join(f"{k} long" for k in KINDS) + ", base string, "
              "at_terms array<string>, at array<array<int>>")
    total = docs.count()
    texts = docs.select("text")
    most_bits = max(remove_bits, generalise_bits)
    counted = scratch.keep("counted", texts.mapInPandas(_count(window), Sums.SCHEMA), ("kind",))
    n_entity = counted.where("kind = 'entity'").groupBy("entity").agg(F.sum("n").alias("n_e")).where(F.col("n_e") >= min_support)
    content = -F.log2(F.col("n_e") / F.lit(float(total)))
    n_entity = n_entity.where(content >= min_bits)
    n_term = counted.where("kind = 'term'").groupBy("term").agg(F.sum("n").alias("n_t")).where(F.col("n_t") >= min_support)
    # n(t, e) is at most n(t) and n(e), so no other pair can disclose
    pairs = scratch.keep("pairs", counted.where("kind = 'pair'").select("entity", "term").distinct().join(n_entity, "entity").join(n_term, "term")
                         .where(F.log2(F.col("n_t") / F.col("n_e")) <= most_bits + 1e-9))
    scratch.drop("counted")
    wanted = pairs.select(F.explode(F.array("entity", "term", F.concat_ws("\0", "entity", "term"))).alias("key"))
    together = scratch.keep("together", texts.mapInPandas(_together(marks(spark, wanted)), Sums.SCHEMA))
    n_both = together.groupBy("entity", "term").agg(F.sum("n").alias("n_te")).where(F.col("n_te") >= min_support)
    pmi = F.log2(F.col("n_te").cast("double") * F.lit(float(total)) / (F.col("n_t").cast("double") * F.col("n_e")))
    disclosing = scratch.keep("disclosing", n_both.join(pairs, ["entity", "term"]).where(pmi >= told * content)
                              .withColumn("bits", content - pmi).where(F.col("bits") <= most_bits)
                              .select("term", F.when(F.col("bits") <= remove_bits, "removed").otherwise("generalised").alias("verdict"))
                              .groupBy("term").agg(F.max("verdict").alias("verdict")))
    scratch.drop("pairs", "together")
    found = scratch.keep("scan", docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
                         .mapInPandas(_scan(window, marks(spark, disclosing.select(F.col("term").alias("key")))), schema))
    hits = (found.where("size(at_terms) > 0").select("doc_id", "version", F.explode("at_terms").alias("term")).distinct()
            .join(disclosing, "term")
            .groupBy(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version"))
            .agg(F.collect_list(F.struct("term", "verdict")).alias("hits")))
    known = F.col("hits").isNotNull()
    args = ("base", *(F.when(known, F.col(c)) for c in ("at_terms", "at", "hits.term", "hits.verdict")))
    counts = [F.col(k).alias(f"n_{k}") for k in KINDS]
    return (found.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("version") == F.col("hit_version")), "left")
            .select("doc_id", "version", *counts, "base", F.pandas_udf(_added, "added string, spans string")(*args).alias("x"))
            .select("doc_id", "version", *(f"n_{k}" for k in KINDS), "base", "x.added", "x.spans"))


def _added(base: pd.Series, terms: pd.Series, at: pd.Series, hits: pd.Series, verdicts: pd.Series) -> pd.DataFrame:
    """``verdict:start:end`` of every place of the terms that got one, by start; and these with the base spans."""
    out = []
    for b, t, a, h, v in zip(base, terms, at, hits, verdicts):
        verdict = dict(zip(h, v)) if h is not None else {}
        spans = sorted((s, e, verdict[x]) for x, xs in zip(t, a) if x in verdict for s, e in zip(xs[::2], xs[1::2])) if verdict else []
        added = ",".join(f"{v}:{s}:{e}" for s, e, v in spans)
        out.append((added, all_spans(b, added)))
    return pd.DataFrame(out, columns=["added", "spans"], dtype=object)


def all_spans(base: str, added: str) -> str:
    """Both lists as one, by start, base kinds first."""
    order = {k: n for n, k in enumerate((*KINDS, "removed", "generalised"))}
    spans = [x.split(":") for part in (base, added) if part for x in part.split(",")]
    return ",".join(":".join(x) for x in sorted(spans, key=lambda x: (int(x[1]), order[x[0]], int(x[2]))))


def redact(text: str | None, spans: str) -> str | None:
    """The text with base spans and removed terms as ``[KIND]`` or nothing, generalised terms as their shape.

    Overlapping base spans are covered together, under the first one's name.
    """
    if not text or not spans:
        return text
    out, done = [], 0
    for kind, s, e in (x.split(":") for x in spans.split(",")):
        s, e = int(s), int(e)
        if s >= done:
            out.append(text[done:s])
            out.append("" if kind == "removed" else shape(text[s:e]) if kind == "generalised" else f"[{kind.upper()}]")
        done = max(done, e)
    return "".join(out) + text[done:]


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``text`` sanitised and ``pii_spans`` added; all rows and other columns stay."""
    found = find(docs, **options).withColumnRenamed("doc_id", "pii_id").withColumnRenamed("version", "pii_version")
    spans = free_name(docs, "pii_spans")
    found = found.select("pii_id", "pii_version", F.col("spans").alias(spans)).where(F.col(spans) != "").dropDuplicates(["pii_id", "pii_version"])
    found = Scratch(docs.sparkSession, "pii-spans").keep("spans", found)  # a stage of its own: one Python worker a task

    @F.pandas_udf("string")
    def clean(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([redact(t, s) for t, s in zip(text, spans)], dtype=object)

    rows = docs.join(found, docs["doc_id"].eqNullSafe(found["pii_id"]) & (F.xxhash64(docs["text"]) == found["pii_version"]), "left")
    columns = [F.when(F.col(spans).isNotNull(), clean(docs["text"], F.col(spans))).otherwise(docs["text"]).alias("text")
               if c == "text" else docs[c] for c in docs.columns]
    return rows.select(*columns, F.coalesce(F.col(spans), F.lit("")).alias(spans))
