"""Near-duplicate groups by min-max hashing with exact confirmation.

A document is the set of its distinct 5-word shingles, each a 64-bit hash.
Under every permutation both the minimum and the maximum of a set are kept, so
``PERMUTATIONS`` hash evaluations give twice as many signature values, each
equal for two sets with the probability of their similarity.  ``BANDS`` bands of
``ROWS`` values are hashed to band keys; sets of the wanted similarity share one
but for a chance of (1 - 0.75^5)^64 = 3e-8 (sets of a few shingles, whose minimum and
maximum hang together, up to about 2e-6), more similar ones sooner.

1. Equal sets become one class; its smallest id stands for it from here on.
2. Classes that share a band key and agree in size and in a sketch of 512 bits
   (a bound that a linked pair misses about once in 10^7) with another have their
   shingles made again and written, nobody else's.
3. Every class is compared, set by set, with one class of each of its buckets;
   links make components.  ``STARS`` times, classes outside the main component
   of a bucket are compared with another member of that.
4. In buckets that still hold several components, classes outside the bucket's
   main component are compared with all classes of other components whose fine
   sketch (4096 bits, made for these classes alone) agrees.  Pairs inside one
   component need no look: they change nothing.  So no link between different
   texts is lost, and a large group of near copies costs a few comparisons for
   each member, not all its pairs.

Hot buckets are pre-aggregated (least member, counts by component) before they
are shuffled, and met by joins that adaptive execution splits.

Defined results: null or empty texts, and texts without words, have an empty set
and link with nothing; fewer than five words make one shingle; rows with
the same ``doc_id`` are one document, of whose texts the one with most shingles
counts (ties: the larger hash); rows without id are one document, null, linked
with nothing; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import LOWER, UPPER, Scratch, connected_components, ship

SHINGLE, SIMILARITY = 5, 75
PERMUTATIONS, BANDS, ROWS, STARS = 160, 64, 5, 1
SKETCH_WORDS, SKETCH_AGREE = 8, 400
FINE_PERMUTATIONS, FINE_AGREE = 1024, 3440
#: Bytes of text shingled at once.
PIECE = 1 << 20

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = _RNG.integers(1, 2**64, SHINGLE, dtype=np.uint64) | np.uint64(1)
_PERMUTE = _RNG.integers(1, 2**32, (PERMUTATIONS, 2), dtype=np.uint32) | np.array([1, 0], np.uint32)
_FINE = _RNG.integers(1, 2**32, (FINE_PERMUTATIONS, 2), dtype=np.uint32) | np.array([1, 0], np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word: a sum of byte values by powers of a base, taken back to the word's start."""
    raw = np.frombuffer(data, np.uint8)
    gap = _SPACE[raw]
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return start, np.zeros(0, np.uint64)
    up = powers(_BASE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:-1], out=total[1:])
    return start, mix((total[end] - total[start]) * powers(_BASE_INVERSE, len(raw) + 1)[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text, end to end, and where each text's begin (one more than texts)."""
    folded = [t.translate(_FOLD) for t in texts]
    offsets = np.cumsum([0, *(len(t) + 1 for t in folded)])
    start, word = word_hashes(b" ".join(folded) + b" ")
    first = np.searchsorted(start, offsets)
    sets = []
    if len(word) >= size:
        rolled = sum((word[k:len(word) - size + 1 + k] * _STEP[k] for k in range(1, size)), word[:len(word) - size + 1] * _STEP[0])
        rolled = mix(rolled)
    for a, b in zip(first, first[1:]):
        if b - a >= size:
            sets.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            short = (word[a:b] * _STEP[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix(np.array([short])))
        else:
            sets.append(np.zeros(0, np.uint64))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum([0, *map(len, sets)])


def signatures(values: np.ndarray, first: np.ndarray, permute: np.ndarray = _PERMUTE) -> np.ndarray:
    """Minimum and maximum of every set under every permutation: sets x twice the permutations, of 32 bits."""
    low = (values >> np.uint64(16)).astype(np.uint32)
    out = np.empty((len(first) - 1, 2 * len(permute)), np.uint32)
    at = first[:-1].astype(np.int64)
    for k, (a, b) in enumerate(permute):
        v = low * a
        v ^= v >> np.uint32(15)
        v = v * np.uint32(0x2C1B3C6D) + b
        out[:, 2 * k] = np.minimum.reduceat(v, at)
        out[:, 2 * k + 1] = np.maximum.reduceat(v, at)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _BASE, parts.shape[:2])
    for k in range(ROWS):
        h = mix(h ^ parts[:, :, k])
    return h.astype(np.int64)


def sketches(sig: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """64-bit words of hashed bits: one of each signature value, then a second as far as there is room."""
    mixed = mix(sig.astype(np.uint64) + _BASE)
    bits = np.concatenate([(mixed & np.uint64(1)).astype(np.uint8), ((mixed >> np.uint64(32)) & np.uint64(1)).astype(np.uint8)], axis=1)
    return np.packbits(bits[:, :64 * words], axis=1).view(np.int64)


def text_pieces(ids, texts):
    """(ids, UTF-8 texts) of at most about PIECE bytes, or a single longer text."""
    some, held, size = [], [], 0
    for i, t in zip(ids, texts):
        raw = t.encode() if isinstance(t, str) else b""
        if some and size + len(raw) > PIECE:
            yield some, held
            some, held, size = [], [], 0
        some.append(i)
        held.append(raw)
        size += len(raw)
    if some:
        yield some, held


def _sign(batches):
    for batch in batches:
        for ids, texts in text_pieces(zip(batch["doc_id"], batch["version"]), batch["text"]):
            values, first = shingle_sets(texts)
            n = np.diff(first)
            full = np.flatnonzero(n)
            rows = {"doc_id": [i for i, _ in ids], "version": [v for _, v in ids], "n_shingles": n,
                    "set1": np.zeros(len(n), np.int64), "set2": np.zeros(len(n), np.int64)}
            bands, sketch = [None] * len(n), [None] * len(n)
            if len(full):
                at = first[full]
                rows["set1"][full] = np.add.reduceat(values, at).astype(np.int64)
                rows["set2"][full] = np.add.reduceat(mix(values ^ _BASE), at).astype(np.int64)
                sig = signatures(values, np.append(at, len(values)))
                for k, b, s in zip(full, band_keys(sig), sketches(sig)):
                    bands[k], sketch[k] = b, s
            yield pd.DataFrame(rows | {"bands": bands, "sketch": sketch})


def _shingle(batches):
    for batch in batches:
        for ids, texts in text_pieces(batch["node"], batch["text"]):
            values, first = shingle_sets(texts)  # none is empty
            fine = sketches(signatures(values, first, _FINE), 4 * FINE_PERMUTATIONS // 64)
            yield pd.DataFrame({"node": ids, "shingles": [values[a:b].astype(np.int64) for a, b in zip(first, first[1:])], "fine": list(fine)})


def sizes_allow(a: Column, b: Column) -> Column:
    """A similarity cannot be over the smaller size by the larger."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * SIMILARITY


def sketches_agree(a: str, b: str) -> Column:
    """Linked sets agree in 448 of 512 bits on average; fewer than SKETCH_AGREE are out of question."""
    differ = sum((F.bit_count(F.col(f"{a}{k}").bitwiseXOR(F.col(f"{b}{k}"))) for k in range(1, SKETCH_WORDS)),
                 F.bit_count(F.col(f"{a}0").bitwiseXOR(F.col(f"{b}0"))))
    return differ <= 64 * SKETCH_WORDS - SKETCH_AGREE


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are linked."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .where(F.col("both") * 100 >= (F.size("sa") + F.size("sb") - F.col("both")) * SIMILARITY).select("a", "b"))


def open_buckets(held: DataFrame, roots: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(minor, all) rows of the buckets that hold several components; minor ones are outside the bucket's
    largest component, ``main``, of which ``hub`` is a member drawn by ``seed``."""
    rows = held.join(roots.withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
    sized = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct(F.xxhash64("a", "key", F.lit(seed)).alias("draw"), "a")).alias("hub"))
    main = (sized.groupBy("key").agg(F.max(F.struct("m", "root", "hub")).alias("x"), F.count(F.lit(1)).alias("roots"))
            .where("roots > 1").select("key", F.col("x.root").alias("main"), F.col("x.hub.a").alias("hub")))
    every = rows.join(main, "key")
    return every.where("root <> main"), every


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "minhash")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    signed = scratch.keep("signed", rows.mapInPandas(
        _sign, f"doc_id {id_type}, version long, n_shingles long, set1 long, set2 long, bands array<long>, sketch array<long>"))

    # 1. classes of equal sets, by their smallest id; only that one brings its bands
    one = signed.groupBy("doc_id").agg(F.max(F.struct("n_shingles", "version", "set1", "set2")).alias("x")).select("doc_id", "x.*")
    has = one.where("n_shingles > 0 and doc_id is not null")
    lead = has.groupBy("n_shingles", "set1", "set2").agg(F.min(F.struct("doc_id", "version")).alias("x"))
    classes = scratch.keep("classes", lead.select("n_shingles", "set1", "set2", F.col("x.doc_id").alias("node"), "x.version"))
    equal = (has.join(classes.select("n_shingles", "set1", "set2", "node"), ["n_shingles", "set1", "set2"])
             .select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    own = signed.select(F.col("doc_id").alias("node"), "version", "bands", *(F.get("sketch", F.lit(k)).alias(f"s{k}") for k in range(SKETCH_WORDS)))
    signs = scratch.keep("signs", own.join(classes.select("node", "version", "n_shingles"), ["node", "version"]).dropDuplicates(["node", "version"]))

    # 2. buckets of several classes, and the classes that resemble another of their bucket
    banded = signs.select("node", F.explode("bands").alias("key"))
    hub = F.min(F.struct(F.xxhash64("key", "node").alias("draw"), "node"))  # one of the bucket, not the same in all
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m"), hub.alias("hub")).where("m > 1").select("key", F.col("hub.node").alias("least"))
    members = scratch.keep("members", banded.join(shared, "key"))
    traits = signs.drop("bands", "version")
    a = traits.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), *(F.col(f"s{k}").alias(f"x{k}") for k in range(SKETCH_WORDS)))
    b = traits.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), *(F.col(f"s{k}").alias(f"y{k}") for k in range(SKETCH_WORDS)))
    alike = sizes_allow(F.col("na"), F.col("nb")) & sketches_agree("x", "y")
    detailed = scratch.keep("detailed", members.select("key", F.col("node").alias("a")).join(a, "a"))
    other = detailed.select("key", *(F.col(c).alias(d) for c, d in zip(a.columns, b.columns)))
    close = (detailed.join(other, (detailed["key"] == other["key"]) & (F.col("a") != F.col("b")) & alike, "left_semi").select(F.col("a").alias("node")).distinct())
    close = scratch.keep("close", close)
    wanted = close.join(signs.select("node", "version"), "node")
    texts = rows.withColumnRenamed("doc_id", "node").join(wanted, ["node", "version"]).dropDuplicates(["node", "version"])
    sets = scratch.keep("sets", texts.select("node", "text").mapInPandas(_shingle, f"node {id_type}, shingles array<long>, fine array<long>"))

    # 3. each class against one of each of its buckets; then, in buckets that hold several
    # components, those outside the main one against another member of that
    pairs = members.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    pairs = pairs.join(a, "a").join(b, "b").where(alike).select("a", "b")
    links = scratch.keep("links-0", confirm(pairs, sets))
    roots = scratch.keep("roots-0", connected_components(links, scratch, "stars-0"))
    held = scratch.keep("held", detailed.join(close.withColumnRenamed("node", "a"), "a", "left_semi"))
    for k in range(1, STARS + 1):
        minor, _ = open_buckets(held, roots, k)
        pairs = minor.select("a", F.col("hub").alias("b"), "na", *(f"x{i}" for i in range(SKETCH_WORDS))).distinct()
        new = scratch.keep(f"links-{k}", confirm(pairs.join(b, "b").where(alike).select("a", "b"), sets))
        links = links.unionByName(new)
        roots = scratch.keep(f"roots-{k}", connected_components(links, scratch, f"stars-{k}"))

    # 4. what is left: classes outside their bucket's main component against the other components,
    # in the first bucket that they share, if the fine sketches agree as well
    _, rows_open = open_buckets(held, roots, 0)
    fine = sets.select("node", "fine").join(signs.select("node", "bands"), "node").withColumnRenamed("node", "a")
    rows_open = scratch.keep("open", rows_open.drop("hub")).join(fine, "a")
    minor = rows_open.where("root <> main").drop("main")
    rest = rows_open.select(*(F.col(c).alias(d) for c, d in zip([*a.columns, "root"], [*b.columns, "root_b"])), F.col("key").alias("key_b"),
                            F.col("main").alias("main_b"), F.col("bands").alias("bands_b"), F.col("fine").alias("fine_b"))
    once = (F.col("root_b") == F.col("main_b")) | (F.col("a") < F.col("b"))
    first = F.get(F.array_intersect("bands", "bands_b"), F.lit(0)) == F.col("key")
    differ = F.aggregate(F.zip_with("fine", "fine_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    pairs = (minor.join(rest, (minor["key"] == rest["key_b"]) & (F.col("root") != F.col("root_b")) & once & alike & first
                        & (differ <= 4 * FINE_PERMUTATIONS - FINE_AGREE))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    more = scratch.keep("links-last", confirm(pairs, sets))

    # components over documents: equal sets, and the linked classes
    found = scratch.keep("components", connected_components(equal.unionByName(links).unionByName(more), scratch, "last"))
    scratch.drop("members", "detailed", "held", "open", "sets", "signs")
    out = one.select("doc_id", "n_shingles")
    out = out.join(found, out["doc_id"].eqNullSafe(found["node"]), "left").drop("node")
    return (out.withColumn("component_id", F.coalesce("root", "doc_id")).drop("root")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
