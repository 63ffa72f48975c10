"""Repeated passages by the interval tree of an enhanced suffix array.

A maximal repeat of ``LENGTH`` bytes or more is an interval of the suffix array
whose common prefix is that long and whose members have different bytes to
their left; its members are all its occurrences.  One array over all texts fits no
machine, so suffixes are dealt out such that equal strings of ``LENGTH`` bytes
always meet:

1. Every window of ``LENGTH`` bytes has an anchor, the least hash among its
   ``GRAM``-byte strings.  Equal windows have equal anchors, and neighbouring windows
   mostly share one, so a text is a row of runs: windows with one anchor, about
   twenty to a run, never more than ``RUN``.
2. Anchors that only one document has repeat nothing.  Each batch of texts sends
   an anchor once, packed by hash bucket; buckets return those that other batches
   sent too.
3. The runs of all other anchors become pieces, the bytes their windows cover.  Equal
   pieces collapse: in all documents but the one with the least id the
   whole piece is a repeat (intervals whose members are wholly equal).
4. Different pieces of one anchor go into one enhanced suffix array, with a suffix for
   every window.  Suffixes whose first ``LENGTH`` bytes occur once are left out, the
   rest are sorted, common prefixes of neighbours taken, and a stack scan
   gives the interval tree; intervals with differing left bytes are the maximal
   repeats (the left end of a piece counts as differing, so nothing
   depends on how runs were cut).  A repeat longer than a piece is a chain of
   overlapping repeats of the pieces along it; their union is the same bytes.
5. An anchor with over ``MEMBERS`` runs would not fit one task.  Its equal pieces collapse
   in a grouped aggregate first; if over ``MEMBERS`` different ones are left (the edges of a
   passage that a great many documents quote) its windows are grouped one by one
   instead, with partial aggregation, which gives the same bytes.

Defined results: null texts are empty; texts under ``LENGTH`` bytes repeat nothing;
rows with one id are one document, so they take nothing from each other and
each is cut on its own; a null id counts as larger than all others; extra columns
take no part; an empty table gives an empty result.  Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import Scratch, hash128, release, ship
from tallyframe.llm.minhash import mix, powers

LENGTH, GRAM = 50, 16
RUN = LENGTH - GRAM + 1
MEMBERS = 4096
#: Bytes of text that are looked at together, and suffixes sorted together.
SLICE, SUFFIXES = 6 << 20, 1 << 17
#: Texts that are looked at together at most (their numbers are sent as 16 bits).
ROWS = 1 << 16
#: Bytes that are hashed at once: arrays of eight bytes for each stay in a core's cache.
BLOCK = 1 << 15
LAST = 2**63 - 1

_RNG = np.random.default_rng(20250612)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = int(_RNG.integers(1, 2**62)) * 2 + 1
_SPAN_BYTE = _RNG.integers(1, 2**64, (2, 256), dtype=np.uint64)
_SPAN_BASE = _RNG.integers(1, 2**64, 2, dtype=np.uint64) | np.uint64(1)
_UP = [powers(b, BLOCK + LENGTH + RUN + 1) for b in _SPAN_BASE]
_DOWN = [powers(np.uint64(pow(int(b), -1, 2**64)), BLOCK + LENGTH + RUN + 1) for b in _SPAN_BASE]


def rolled(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` bytes in a row."""
    step, run, out, done = _BYTE[raw], 1, None, 0
    while True:
        if size & 1:
            if out is None:
                out, done = step, run
            else:
                m = len(step) - done
                out, done = out[:m] * np.uint64(pow(_BASE, run, 2**64)) + step[done:done + m], done + run
        size >>= 1
        if not size:
            return mix(out)
        step, run = step[:len(step) - run] * np.uint64(pow(_BASE, run, 2**64)) + step[run:], 2 * run


def least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` values in a row."""
    run, have = values, 1
    while 2 * have <= size:
        run, have = np.minimum(run[:-have], run[have:]), 2 * have
    return run if have == size else np.minimum(run[:len(run) - (size - have)], run[size - have:])


def unpacked(text: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(text)


def _pack_texts(batches):
    """Texts compressed, as they are to be shuffled."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        yield batch.assign(text=[squeeze(t.encode()) if isinstance(t, str) else None for t in batch["text"]])


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` compressed."""
    types = ", ".join(f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(_pack_texts, types)


def stretches(batches, more: int = 0):
    """Texts as stretches (row, offset, bytes), about ``SLICE`` bytes of them at a time; a long text as several, which hold
    every window once.  ``row`` is (id, version) and ``more`` further columns; a row that repeats at once counts once."""
    held, size, last = [], 0, None
    for batch in batches:
        for d, version, text, *rest in batch.itertuples(index=False, name=None):
            if (d, version) == last:
                continue
            last, data = (d, version), text.encode() if isinstance(text, str) else unpacked(text)
            for at in range(0, max(len(data) - LENGTH + 1, 1), SLICE):
                part = data[at:at + SLICE + LENGTH - 1]
                held.append(((d, version, *rest), at, part))
                size += len(part)
                if size >= SLICE or len(held) >= ROWS:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _block_runs(raw: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    inside = np.flatnonzero(owner[LENGTH - 1:] == owner[:len(raw) - LENGTH + 1])  # windows within one part
    if not len(inside):
        return ()
    anchor = least(rolled(raw, GRAM), RUN)[inside]
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1))))
    first, anchor, count = inside[new], anchor[new], np.diff(np.append(new, len(inside)))
    if (count > RUN).any():  # periodic text
        times = -(-count // RUN)
        k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        end = np.repeat(first + count, times)
        first, anchor = np.repeat(first, times) + k * RUN, np.repeat(anchor, times)
        count = np.minimum(end - first, RUN)
    return owner[first].astype(np.int64), first, count, anchor


def runs(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes end to end, and of each run: part, first window (place in the bytes), number of windows, anchor."""
    raw = np.frombuffer(b"".join(parts), np.uint8)
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
    found = []
    for at in range(0, len(raw) - LENGTH + 1, BLOCK):
        if block := _block_runs(raw[at:at + BLOCK + LENGTH - 1], owner[at:at + BLOCK + LENGTH - 1]):
            found.append((block[0], block[1] + at, *block[2:]))
    if not found:
        none = np.zeros(0, np.int64)
        return raw, none, none, none, none.astype(np.uint64)
    return raw, *(np.concatenate(x) for x in zip(*found))


def span_hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two unrelated hashes of each of the ascending spans of bytes: sums of byte values by powers of a base, taken back to
    the span's start."""
    out = np.empty((2, len(start)), np.uint64)
    edges = np.searchsorted(start, np.arange(0, len(raw) + BLOCK, BLOCK))
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        if a == b:
            continue
        block = raw[k * BLOCK:(k + 1) * BLOCK + LENGTH + RUN]
        first, n = start[a:b] - k * BLOCK, size[a:b]
        for j in range(2):
            total = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(_SPAN_BYTE[j][block] * _UP[j][:len(block)], out=total[1:])
            out[j, a:b] = (total[first + n] - total[first]) * _DOWN[j][first]
    return tuple(mix(x + size.astype(np.uint64)).astype(np.int64) for x in out)


def _pack(values) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def short_anchor(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of an anchor's hash: two anchors that agree here by chance only cost a look at more pieces.

    The lowest bit is left free, for whether the anchor is crowded.
    """
    return ((((anchor >> np.uint64(33)) % np.uint64(buckets)) << np.uint64(32)) | (anchor & np.uint64(0xFFFFFFFF))) << np.uint64(1)


_ANCHORS = "bucket int, batch long, ids array<long>, versions array<long>, docs binary, times binary, hashes binary"


def _anchors(buckets: int):
    """Per batch of stretches: a row for each bucket with one stretch for each anchor and how many runs have it, and a
    row (bucket -1) that names the stretches' texts and lists the anchors that several of them have."""
    def run(batches):
        for held in stretches(batches):
            batch = uuid.uuid4().int >> 65
            _, part, _, _, anchor = runs([data for _, _, data in held])
            hashes = short_anchor(anchor, buckets)
            order = np.lexsort((part, hashes))
            hashes, part = hashes[order], part[order]
            first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))[:len(hashes)])
            times = np.diff(np.append(first, len(hashes)))
            pair = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (part[1:] != part[:-1])))[:len(part)]
            several = pair & np.repeat(np.add.reduceat(pair, first) > 1 if len(first) else times, times)
            docs = part.astype(np.uint16)
            out = [(-1, batch, [r[0] for r, _, _ in held], [r[1] for r, _, _ in held], _pack(docs[several]), None, _pack(hashes[several]))]
            hashes, docs, times = hashes[first], docs[first], np.minimum(times, 0xFFFF).astype(np.uint16)
            edges = np.searchsorted(hashes, np.arange(buckets + 1).astype(np.uint64) << np.uint64(33))
            low = (hashes >> np.uint64(1)).astype(np.uint32)
            out += [(k, batch, None, None, _pack(docs[a:b]), _pack(times[a:b]), _pack(low[a:b]))
                    for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            yield pd.DataFrame(out, columns=["bucket", "batch", "ids", "versions", "docs", "times", "hashes"])
    return run


def _in_several(group: pd.DataFrame, limit: int) -> pd.DataFrame:
    """Of one bucket: the anchors that several batches sent, and those with over ``limit`` runs, handed back to each batch."""
    hashes = np.frombuffer(b"".join(group["hashes"]), np.uint32)
    docs = np.frombuffer(b"".join(group["docs"]), np.uint16)
    times = np.frombuffer(b"".join(group["times"]), np.uint16)
    source = np.repeat(np.arange(len(group)), [len(x) // 4 for x in group["hashes"]])
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
    batches = np.diff(np.append(first, len(hashes)))
    crowded = np.add.reduceat(times[order].astype(np.int64), first) > limit
    keep, flag = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    keep[order], flag[order] = np.repeat((batches > 1) | crowded, batches), np.repeat(crowded, batches)
    edges = np.searchsorted(source[keep], np.arange(len(group) + 1))
    whole = (hashes[keep].astype(np.uint64) | (np.uint64(group["bucket"].iloc[0]) << np.uint64(32))) << np.uint64(1)
    docs, hashes = docs[keep], whole | flag[keep]
    return pd.DataFrame([(b, _pack(docs[x:y]), _pack(hashes[x:y])) for b, x, y in zip(group["batch"], edges, edges[1:]) if y > x],
                        columns=["batch", "docs", "hashes"])


def _by_document(group: pd.DataFrame) -> pd.DataFrame:
    """Of one batch: each stretch's text with its anchors that others have too, ascending."""
    names = group[group["bucket"] == -1].iloc[0]
    docs = np.frombuffer(b"".join(group["docs"]), np.uint16)
    hashes = np.frombuffer(b"".join(group["hashes"]), np.uint64)
    crowded = np.unique(hashes[hashes & np.uint64(1) > 0])
    hashes = hashes | np.isin(hashes | np.uint64(1), crowded)  # in all texts of the batch
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    edges = np.searchsorted(docs, np.arange(len(names["ids"]) + 1))
    return pd.DataFrame([(d, v, _pack(np.unique(hashes[a:b]))) for d, v, a, b in zip(names["ids"], names["versions"], edges, edges[1:]) if b > a],
                        columns=["d", "version", "shared"])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, d: the id, the largest number for null, version, text).

    ``version`` tells texts of one id apart: a hash of the text, or 0 where all ids are different.
    """
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d")
    alone = docs.groupBy(d).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    return docs.select("doc_id", d, (F.lit(0).cast("long") if alone else F.xxhash64("text")).alias("version"), "text")


def equal_texts(long: DataFrame, scratch: Scratch) -> DataFrame:
    """Of the texts that several ids have, the rows (d, version, n_bytes) but those of the least id: all their bytes repeat."""
    h1, h2 = hash128("text")
    texts = scratch.keep("texts", long.select("d", "version", h1.alias("h1"), h2.alias("h2"), F.octet_length("text").alias("n_bytes")))
    first = texts.groupBy("h1", "h2").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most")
    copies = scratch.keep("copies", texts.join(first, ["h1", "h2"]).where("d > least").select("d", "version", "n_bytes").distinct())
    scratch.drop("texts")
    return copies


def shared_anchors(long: DataFrame, copies: DataFrame, scratch: Scratch, limit: int = MEMBERS) -> DataFrame:
    """(d, version, shared): the anchors of each text that another one has too; copies have no row."""
    spark = long.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sent = scratch.keep("anchors", long.select("d", "version", "text").mapInPandas(_anchors(buckets), _ANCHORS))
    back = sent.where("bucket >= 0").groupBy("bucket").applyInPandas(lambda group: _in_several(group, limit), "batch long, docs binary, hashes binary")
    own = sent.where("bucket = -1")
    both = own.unionByName(back.withColumn("bucket", F.lit(0)), allowMissingColumns=True)
    lists = both.groupBy("batch").applyInPandas(_by_document, "d long, version long, shared binary").join(copies, ["d", "version"], "left_anti")
    kept = scratch.keep("shared", lists.groupBy("d", "version").agg(F.collect_set("shared").alias("shared")))
    scratch.drop("anchors")
    return kept


_PIECES = "deal long, anchor long, d long, version long, starts binary, lengths binary, piece binary"


def _pieces(buckets: int, collapse: bool = True):
    """Per batch of stretches: a row for each different piece with its places in the text of least id, and (``piece`` null) a
    row for each text with its places that are equal to a piece of one with a smaller id.  Without ``collapse``, a row for each
    different piece of each text."""
    def run(batches):
        for held in stretches(batches, 1):
            held.sort(key=lambda x: x[0][:2])
            data = [x[2] for x in held]
            raw, part, first, count, anchor = runs(data)
            short, hit, crowd = short_anchor(anchor, buckets), np.zeros(len(anchor), bool), np.zeros(len(anchor), bool)
            edges = np.searchsorted(part, np.arange(len(held) + 1))
            for (row, _, _), a, b in zip(held, edges, edges[1:]):
                known = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in row[2]])) if len(row[2]) > 1 else np.frombuffer(row[2][0], np.uint64)
                near = known[np.minimum(np.searchsorted(known, short[a:b]), len(known) - 1)]
                hit[a:b], crowd[a:b] = near | np.uint64(1) == short[a:b] | np.uint64(1), near & np.uint64(1)
            hit = np.flatnonzero(hit)
            part, first, size, anchor, crowd = part[hit], first[hit], count[hit] + LENGTH - 1, anchor[hit].astype(np.int64), crowd[hit]
            p1, p2 = span_hashes(raw, first, size)
            begin = np.cumsum([0, *map(len, data)])[:-1]
            offset = np.array([x[1] for x in held], np.int64)
            start = first - begin[part] + offset[part]
            ids = np.array([x[0][0] for x in held], np.int64)
            versions = np.array([x[0][1] for x in held], np.int64)
            order = np.lexsort((start, versions[part], ids[part], p2, p1, anchor))  # like pieces together: they compress
            part, first, size, anchor, crowd, start, p1, p2 = (x[order] for x in (part, first, size, anchor, crowd, start, p1, p2))
            d, version = ids[part], versions[part]
            piece = _changes(anchor, p1, p2)
            least_id = np.repeat(d[piece], np.diff(np.append(np.flatnonzero(piece), len(p1))))
            later = (d > least_id) & collapse
            gone, stay = np.flatnonzero(later), np.flatnonzero(~later)
            text = piece | _changes(d, version)
            heads = np.flatnonzero(text[stay])
            tails = np.append(heads[1:], len(stay))
            row = stay[heads]
            n = [start[stay[a:b]].tobytes() for a, b in zip(heads.tolist(), tails.tolist())]
            whole = raw.tobytes()
            cut = [whole[a:a + k] for a, k in zip(first[row].tolist(), size[row].tolist())]
            # Pieces of one anchor meet; those of a crowded one (no ``anchor`` yet) are spread.
            deal = np.where(crowd[row], p1[row], anchor[row])
            yield pd.DataFrame({"deal": deal, "anchor": np.where(crowd[row], anchor[row], 0), "d": d[row], "version": version[row],
                                "starts": n, "lengths": None, "piece": cut})
            gone = gone[np.lexsort((version[gone], d[gone]))]
            new = np.flatnonzero(np.concatenate(([True], (d[gone][1:] != d[gone][:-1]) | (version[gone][1:] != version[gone][:-1])))[:len(gone)])
            ends = np.append(new[1:], len(gone))
            yield pd.DataFrame({"deal": d[gone[new]], "anchor": np.zeros(len(new), np.int64), "d": d[gone[new]], "version": version[gone[new]],
                                "starts": [start[gone[a:b]].tobytes() for a, b in zip(new, ends)],
                                "lengths": [size[gone[a:b]].tobytes() for a, b in zip(new, ends)], "piece": None})
    return run


def pieces(long: DataFrame, shared: DataFrame, collapse: bool = True) -> DataFrame:
    buckets = max(int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # Rows that repeat are next to each other after this join, as it sorts by its keys.
    joined = packed(long.select("d", "version", "text")).join(shared.hint("merge"), ["d", "version"])
    return joined.mapInPandas(_pieces(buckets, collapse), _PIECES)


def enhanced_array(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes (bytes from ``start`` on, ``size`` of them) and the common prefix of each with the one before."""
    width = -(-int(size.max()) // 8) * 8
    at = np.arange(width)
    table = data[np.minimum(start[:, None] + at, len(data) - 1)]
    table[at >= size[:, None]] = 0
    words = table.view(">u8").astype(np.uint64)
    order = np.lexsort((size, *(words[:, k] for k in range(words.shape[1] - 1, -1, -1))))
    table, size = table[order], size[order]
    differ = table[1:] != table[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    return order, np.concatenate(([0], np.minimum(common, np.minimum(size[1:], size[:-1]))))


def interval_tree(common: np.ndarray, first: int, last: int) -> list[tuple[int, int, int]]:
    """Stack scan over ranks ``first``..``last``: (depth, left, right) of every interval of a common prefix."""
    out, stack = [], []
    for rank, depth in enumerate(common[first + 1:last + 1].tolist(), first + 1):
        left = rank - 1
        while stack and stack[-1][0] > depth:
            top, left = stack.pop()
            out.append((top, left, rank - 1))
        if not stack or stack[-1][0] < depth:
            stack.append((depth, left))
    out += [(depth, left, last) for depth, left in reversed(stack)]
    return out


def maximal_repeats(members: list[bytes]):
    """(member, offset) of suffixes by rank, and the maximal repeats of ``members`` as arrays depth, left, right of ranks."""
    none = np.zeros(0, np.int64)
    if not members:
        return none, none, none, none, none
    data = np.frombuffer(b"".join(members), np.uint8)
    length = np.array([len(m) for m in members])
    base = np.cumsum(length) - length
    windows = length - LENGTH + 1
    member = np.repeat(np.arange(len(members)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    start = base[member] + offset
    seen, back, times = np.unique(rolled(data, LENGTH)[start], return_inverse=True, return_counts=True)
    keep = times[back] > 1
    member, offset, start = member[keep], offset[keep], start[keep]
    if not len(member):
        return member, offset, none, none, none
    order, common = enhanced_array(data, start, (length[member] - offset))
    member, offset, start = member[order], offset[order], start[order]
    edge = offset == 0
    left = data[start - 1]
    change = np.concatenate(([0], np.cumsum((left[1:] != left[:-1]) | edge[1:] | edge[:-1])))
    heads = np.flatnonzero(common < LENGTH)
    tails = np.append(heads[1:], len(common)) - 1
    two = tails - heads == 1
    found = [(common[tails[two]], heads[two], tails[two])]
    trees = [x for a, b in zip(heads[tails - heads > 1], tails[tails - heads > 1]) for x in interval_tree(common, a, b)]
    found += [tuple(np.array(x) for x in zip(*trees))] if trees else []
    depth, first, last = (np.concatenate(x) for x in zip(*found))
    diverse = change[last] > change[first]
    return member, offset, depth[diverse], first[diverse], last[diverse]


_GONE = "d long, version long, starts binary, shift int, length int, lengths binary"
_RESOLVED = f"{_GONE}, anchor long, piece binary"


def _lots(batches):
    """Pieces sorted by anchor (``deal``), whole anchors together, about ``SUFFIXES`` suffixes at a time."""
    held, size = None, 0
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        size += int(batch["piece"].map(len).sum()) - (LENGTH - 1) * len(batch)
        if size >= SUFFIXES:
            anchor = held["deal"].to_numpy()
            edge = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on
            if edge:
                yield held.iloc[:edge]
                held = held.iloc[edge:].reset_index(drop=True)
                size = int(held["piece"].map(len).sum()) - (LENGTH - 1) * len(held)
    if held is not None and len(held):
        yield held


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _resolve(batches):
    """Of pieces sorted by anchor, bytes and id: the places of a piece in all texts but the one of least id, and of each
    different piece the maximal repeats that a text of smaller id has too.  Other rows pass."""
    names = [c.split()[0] for c in _RESOLVED.split(", ")]
    passed = []

    def pieces_of_anchors():
        for batch in batches:
            here = batch["piece"].notna() & (batch["anchor"] == 0)
            if not here.all():
                passed.append(batch[~here].assign(shift=0, length=0)[names])
            yield batch[here].reset_index(drop=True)

    for lot in _lots(pieces_of_anchors()):
        yield from passed
        passed.clear()
        anchor, d, version = (lot[c].to_numpy() for c in ("deal", "d", "version"))
        starts, piece = lot["starts"].tolist(), lot["piece"].tolist()
        new = _changes(anchor)
        new[1:] |= np.fromiter((x != y for x, y in zip(piece, piece[1:])), bool, len(piece) - 1)
        kind = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        gone = np.flatnonzero(d > d[head][kind])
        out = [(d[gone], version[gone], [starts[i] for i in gone], np.zeros(len(gone), np.int64), np.array([len(piece[i]) for i in gone], np.int64))]
        group = np.cumsum(_changes(anchor[head])) - 1
        several = np.flatnonzero(np.bincount(group)[group] > 1)  # kinds whose anchor has others
        member, offset, depth, first, last = maximal_repeats([piece[i] for i in head[several]])
        owner = d[head[several]][member]
        cover = np.zeros(len(member), np.int64)
        two = last - first == 1
        for x, y in ((first[two], last[two]), (last[two], first[two])):
            later = owner[x] > owner[y]
            cover[x[later]] = np.maximum(cover[x[later]], depth[two][later])
        rest = np.flatnonzero(~two)
        for a, b, long in zip(first[rest].tolist(), last[rest].tolist(), depth[rest].tolist()):
            inside = owner[a:b + 1]
            later = a + np.flatnonzero(inside > inside.min())
            cover[later] = np.maximum(cover[later], long)
        hit = np.flatnonzero(cover)
        # Rows of the least id: one for each text and stretch that has the piece there.
        rows = np.flatnonzero(d == d[head][kind])
        begin = np.searchsorted(kind[rows], np.arange(len(head) + 1))
        which = several[member[hit]]
        times = begin[which + 1] - begin[which]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        row = rows[np.repeat(begin[which], times) + step]
        out.append((d[row], version[row], [starts[i] for i in row], np.repeat(offset[hit], times), np.repeat(cover[hit], times)))
        for columns in out:
            yield pd.DataFrame(dict(zip(names, columns))).assign(lengths=None, anchor=0, piece=None)
    yield from passed


def resolved(found: DataFrame) -> DataFrame:
    """``found`` dealt out by anchor and sorted, so that an anchor's rows follow each other in one task, and resolved there."""
    dealt = found.repartition("deal").sortWithinPartitions("deal", "piece", "d")
    return dealt.mapInPandas(_resolve, _RESOLVED)


def crowded_removed(hot: DataFrame, limit: int = MEMBERS) -> DataFrame:
    """The same for the pieces of crowded anchors: equal ones collapse by an aggregate first, and what is still too much
    for one task goes by windows."""
    flat = [c.split()[0] for c in _GONE.split(", ")]
    kinds = hot.groupBy("anchor", "piece").agg(F.min("d").alias("least"))
    members = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("members"))
    known = hot.join(kinds.join(members, "anchor"), ["anchor", "piece"])
    equal = known.where("d > least").withColumn("length", F.octet_length("piece"))
    some = known.where(f"d = least and members between 2 and {limit}").withColumn("deal", F.col("anchor")).withColumn("anchor", F.lit(0).cast("long"))
    in_array = resolved(some.select([c.split()[0] for c in _PIECES.split(", ")]))
    windows = windows_removed(known.where(f"d = least and members > {limit}"))
    return reduce(DataFrame.unionByName, (x.select(*flat) for x in (equal, in_array, windows)))


def removed(found: DataFrame, copies: DataFrame, scratch: Scratch, limit: int = MEMBERS) -> DataFrame:
    """(d, version, starts, shift, length, lengths): stretches that occur in a document with a smaller id."""
    flat = [c.split()[0] for c in _GONE.split(", ")]
    known = scratch.keep("resolved", resolved(found))
    release(copies.sparkSession)
    start = F.unhex(F.lit("00" * 8)).alias("starts")
    whole = copies.select("d", "version", start, F.lit(0).alias("shift"), F.col("n_bytes").alias("length"), F.lit(None).cast("binary").alias("lengths"))
    hot = scratch.keep("crowded", crowded_removed(known.where("piece is not null"), limit))
    return reduce(DataFrame.unionByName, (x.select(*flat) for x in (known.where("piece is null"), whole, hot)))


def windows_removed(crowded: DataFrame) -> DataFrame:
    """The same for pieces of crowded anchors, window by window."""
    at = F.explode(F.sequence(F.lit(0), F.octet_length("piece") - LENGTH))
    one = crowded.select("d", "version", "starts", "piece", at.alias("shift"))
    window = F.substring(F.col("piece"), F.col("shift") + 1, F.lit(LENGTH))
    keys: list[Column] = [F.xxhash64(window).alias("w1"), F.xxhash64(F.lit("second"), window).alias("w2")]
    one = one.select("d", "version", "starts", "shift", *keys)
    firsts = one.groupBy("w1", "w2").agg(F.min("d").alias("least"))
    return (one.join(firsts, ["w1", "w2"]).where("d > least")
            .select("d", "version", "starts", "shift", F.lit(LENGTH).alias("length"), F.lit(None).cast("binary").alias("lengths")))


_GROUPS = "repeat long, length int, d long, version long, starts binary, shift int, anchor long, piece binary"


def _group_rows(batches):
    """Of pieces sorted by anchor, bytes and id: each maximal repeat with every text that has it; other rows pass."""
    names = [c.split()[0] for c in _GROUPS.split(", ")]
    passed = []

    def pieces_of_anchors():
        for batch in batches:
            here = batch["anchor"] == 0
            if not here.all():
                passed.append(batch[~here].assign(repeat=0, length=0, shift=0)[names])
            yield batch[here].reset_index(drop=True)

    for lot in _lots(pieces_of_anchors()):
        yield from passed
        passed.clear()
        anchor, d, version = (lot[c].to_numpy() for c in ("deal", "d", "version"))
        starts, piece = lot["starts"].tolist(), lot["piece"].tolist()
        new = _changes(anchor)
        new[1:] |= np.fromiter((x != y for x, y in zip(piece, piece[1:])), bool, len(piece) - 1)
        head = np.append(np.flatnonzero(new), len(piece))
        members = [piece[i] for i in head[:-1]]
        member, offset, depth, first, last = maximal_repeats(members)
        groups = [(m[o:o + n], [(int(member[r]), int(offset[r])) for r in range(a, b + 1)])
                  for m, o, n, a, b in zip((members[member[a]] for a in first), offset[first].tolist(), depth.tolist(), first.tolist(), last.tolist())]
        # A piece that no other one holds whole is a repeat of its own if it occurs twice.
        held = {g[0] for g in groups}
        groups += [(m, [(k, 0)]) for k, m in enumerate(members) if m not in held and (head[k + 1] - head[k] > 1 or len(starts[head[k]]) > 8)]
        out = [(xxhash.xxh3_64_intdigest(text) - 2**63, len(text), d[i], version[i], starts[i], o, 0, None)
               for text, places in groups for k, o in places for i in range(head[k], head[k + 1])]
        yield pd.DataFrame(out, columns=names)
    yield from passed


def repeat_groups(docs: DataFrame, limit: int = MEMBERS) -> DataFrame:
    """Passages of ``LENGTH`` bytes or more that several texts have, with all occurrences: (repeat, length, doc_id, start),
    ``start`` in bytes.

    ``repeat`` is a hash of the passage.  Repeats are maximal within pieces (a longer passage is a chain of them), those of
    anchors with over ``limit`` runs are given window by window.  An occurrence stands once for each time its text is in
    the table under an id; rows that repeat as a whole count once.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "repeats")
    rows = keyed(docs)
    long = rows.where(F.octet_length("text") >= LENGTH)
    nothing = long.select("d", "version").limit(0)
    found = pieces(long, shared_anchors(long, nothing, scratch, limit), False)
    known = scratch.keep("groups", found.repartition("deal").sortWithinPartitions("deal", "piece", "d").mapInPandas(_group_rows, _GROUPS))
    hot = known.where("piece is not null")
    windows = hot.select("d", "version", "starts", "piece", F.explode(F.sequence(F.lit(0), F.octet_length("piece") - LENGTH)).alias("shift"))
    text = F.substring(F.col("piece"), F.col("shift") + 1, F.lit(LENGTH))
    windows = windows.select(F.xxhash64(text).alias("repeat"), F.lit(LENGTH).alias("length"), "d", "version", "starts", "shift")
    listed = known.where("piece is null").select(windows.columns).unionByName(windows)
    places = listed.mapInPandas(_places, "repeat long, length int, d long, version long, start long").distinct()
    several = places.groupBy("repeat", "length").agg(F.count_distinct("d", "version").alias("n")).where("n > 1").drop("n")
    ids = long.select("doc_id", "d", "version").distinct()
    return places.join(several, ["repeat", "length"]).join(ids, ["d", "version"]).select("repeat", "length", "doc_id", "start")


def _places(batches):
    for batch in batches:
        spots = [np.frombuffer(x, np.int64) for x in batch["starts"]]
        times = [len(x) for x in spots]
        start = (np.concatenate(spots) if spots else np.zeros(0, np.int64)) + np.repeat(batch["shift"].to_numpy(np.int64), times)
        yield pd.DataFrame({c: np.repeat(batch[c].to_numpy(), times) for c in ("repeat", "length", "d", "version")}).assign(start=start)


def _merged(parts, size: int) -> list[tuple[int, int]]:
    """Maximal stretches that the parts cover."""
    spans = []
    for part in parts:
        start = np.frombuffer(part["starts"], np.int64) + part["shift"]
        long = np.frombuffer(part["lengths"], np.int64) if part["lengths"] is not None else np.full(len(start), part["length"])
        spans.append(np.stack((start, start + long), 1))
    spans = np.concatenate(spans)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > reach[:-1])))
    return list(zip(spans[new, 0].tolist(), reach[np.append(new[1:], len(spans)) - 1].tolist()))


def cut(batches):
    """Texts without their removed stretches, and the figures of the cut."""
    for batch in batches:
        out = []
        for doc_id, text, parts in zip(batch["doc_id"], batch["text"], batch["parts"]):
            data = unpacked(text) if text is not None else b""
            spans = _merged(parts, len(data)) if parts is not None else []
            edges = [0, *(x for s in spans for x in s), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
        figures = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        yield pd.concat([batch[["doc_id"]].reset_index(drop=True), figures], axis=1)


def dedup_passages(docs: DataFrame, limit: int = MEMBERS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept``, the bytes that stay.

    ``limit`` is how many pieces of an anchor go into one suffix array; it bounds memory and changes no result.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "suffix")
    rows = keyed(docs)
    long = rows.where(F.octet_length("text") >= LENGTH)
    copies = equal_texts(long, scratch)
    shared = shared_anchors(long, copies, scratch, limit)
    release(spark)
    gone = removed(pieces(long, shared), copies, scratch, limit)
    release(spark)
    spans = gone.groupBy("d", "version").agg(F.collect_list(F.struct("starts", "shift", "length", "lengths")).alias("parts"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return packed(rows).join(spans, ["d", "version"], "left").select("doc_id", "text", "parts").mapInPandas(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
