"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens.

Documents longer than a sequence are cut into whole sequences, the first piece
taking what is left over.  A range sort by (length, id, piece) ranks the pieces within
their length, so a length that a third of the pieces have is spread over the
partitions.  Packing is bulk-synchronous over lengths from long to short: the
pieces of a length and the gaps of the sequences so far, both as runs of equal size
(at most ``capacity`` lengths and gap sizes, a bound that no corpus changes), are matched
by a successor sweep, every piece going to the smallest gap that holds it; pieces
that want the same gap are settled by rank (the first floor(gap / length) per
sequence take it), gaps are updated, what fits no gap opens sequences, and the
next length follows.  Because runs stand for all rows of a size, the sweep over them takes
place on the driver, over counts alone; its outcome is a table of rank ranges, by
which every task places its own rows.

Ids are those of the tokenizer file.  Where its pieces and merges are of the common kind (checked when
the file is read) they come from the same ranks by a quicker library.

Defined results: a null or empty text is the end token alone; equal lengths are
placed by id, then piece; repeated rows are packed as separate documents; extra
columns are ignored; a null ``doc_id`` is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import Scratch, indexed, ship

CAPACITY, END = 2048, 0
#: How a byte-level tokenizer splits a text into the pieces that it merges within.
BYTE_LEVEL_PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, Callable[[str], bytes]] = {}


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + k): b for k, b in enumerate(others)}}


def byte_level_ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes -> rank of a tokenizer file; None if it isn't byte-level BPE whose merges are numbered in their order."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, before = whole["model"], whole.get("pre_tokenizer") or {}
    plain = (whole.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
             and before.get("use_regex", True) and model.get("type", "BPE") == "BPE"
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    vocab, byte = model["vocab"], byte_characters()
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    numbers = [vocab["".join(p)] for p in pairs]
    if numbers != sorted(set(numbers)) or numbers and min(numbers) < 256 or any(vocab.get(c, 256) > 255 for c in byte):
        return None
    tokens = [*byte, *("".join(p) for p in pairs)]
    return {bytes(byte[c] for c in t): vocab[t] for t in tokens}


def token_ids(path: str) -> Callable[[str], bytes]:
    """The ids of a text as little-endian uint32 bytes; one encoder a worker process."""
    if path not in _encoders:
        ranks = byte_level_ranks(path)
        if ranks is not None:
            import tiktoken

            quick = tiktoken.Encoding("byte level", pat_str=BYTE_LEVEL_PIECES, mergeable_ranks=ranks, special_tokens={})
            _encoders[path] = lambda text: quick.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            _encoders[path] = lambda text: np.asarray(own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return _encoders[path]


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Per piece of each row of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, row_crc."""
    ship(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        encode = token_ids(path)
        stop = np.asarray([end], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text if isinstance(text, str) else "") + stop
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                edges = [0, *range(first, total + 1, capacity)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
            yield pd.DataFrame(rows, columns=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit over ``counts`` (pieces of each length): rows (length, first rank, sequence, per sequence, offset).

    The pieces of that length from that rank on fill sequences from ``sequence``
    on, so many in each, beginning at ``offset``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap size: runs (first sequence, how many)
    out, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]

        def place(gap: int, first: int, n: int, each: int) -> None:
            nonlocal rank, left
            out.append((length, rank, first, each, capacity - gap))
            rank, left = rank + n * each, left - n * each
            if gap > each * length:
                gaps.setdefault(gap - each * length, []).append((first, n))

        for gap in sorted(g for g in gaps if g >= length):
            runs = gaps.pop(gap)
            each = gap // length
            while runs and left:
                first, n = runs.pop()
                used = min(n, left // each)
                if used:
                    place(gap, first, used, each)
                if used < n and left:  # fewer than a full share is left
                    place(gap, first + used, 1, left)
                    used += 1
                if used < n:
                    runs.append((first + used, n - used))
            if runs:
                gaps.setdefault(gap, []).extend(runs)
            if not left:
                break
        each = capacity // length
        for n, share in ((left // each, each), (1, left % each)):
            if n and share and left:
                opened, first = opened + n, opened
                place(capacity, first, n, share)
    return np.array(out, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; offsets have no gaps from 0 on."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep("pieces", cut_pieces(docs, path, capacity, end))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = sweep(counts, capacity)
    shift = np.int64(1 << 44)  # ranks within a length stay below it
    plan = spark.sparkContext.broadcast((table[np.argsort(table[:, 0] * shift + table[:, 1], kind="stable")]))

    def place(batches):
        runs = plan.value
        keys = runs[:, 0] * shift + runs[:, 1]
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            rank = batch["rank"].to_numpy(np.int64)
            run = runs[np.searchsorted(keys, length * shift + rank, "right") - 1]
            at = rank - run[:, 1]
            batch["sequence_id"] = run[:, 2] + at // run[:, 3]
            batch["offset"] = run[:, 4] + at % run[:, 3] * length
            yield batch.drop(columns="rank")

    kind = docs.schema["doc_id"].dataType.simpleString()
    ranked = indexed(pieces, "length", ["doc_id", "piece", "start", "ids_crc32"], scratch, "ranked").withColumnRenamed("idx", "rank")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
