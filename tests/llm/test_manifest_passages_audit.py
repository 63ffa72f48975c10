"""Merkle manifest, repeated passages and filter audit against brute force, on given tables and on dirty rows."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import audit, merkle, registry, suffix
from tallyframe.llm.common import Scratch
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, digest string, part string, starts int"
SAME = "the same forty words " * 12
DIRTY = [
    (1, None, None, None, None, "x", "y", "p", 1),
    (2, "", "en", "", 0, "x", None, "p", 1),
    (3, SAME, "en", "s", 5, None, "y", "p", 1),
    (3, SAME, "en", "s", 5, None, "y", "p", 1),
    (3, "Other text of id three. " + SAME, "en", "s", 5, None, "y", "p", 1),
    (4, "Lead. " + SAME + "Tail", "", "s", 9, "x", "y", "p", 1),
    (5, "a" * 5000, "en", "t", 9, "x", "y", "p", 1),
    (6, "b" + "a" * 700 + "\0\0" + "ab" * 90, "fr", "t", 9, "x", "y", "p", 1),
    (7, "ab" * 300 + "\0" + "naïve 漢字 " * 20, "fr", "-", 9, "x", "y", "p", 1),
    (8, "naïve 漢字 " * 20, None, "-", 9, "x", "y", "p", 1),
    (None, "Lead. " + SAME + "Tail", "en", "s", 9, "x", "y", "p", 1),
    (None, "NO ID HERE # " * 9, "en", None, 9, "x", "y", "p", 1),
]


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(DIRTY, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# op11

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """Root of a list of digests, and the siblings (left, right) of each, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for k, i in enumerate(at):
            run, slot = runs[i // 16], i % 16
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[k] = i // 16
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def brute_manifest(rows):
    groups = {}
    for r in rows:
        fields = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        d = sha("".join(map(framed, fields)))
        spoilt = d
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
            low = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])
            spoilt = sha("".join(map(framed, [*fields[:4], low])))
        groups.setdefault("" if r["source"] is None else "+" + r["source"], []).append((r["doc_id"] is not None, r["doc_id"], d, spoilt))
    names = sorted(groups, key=str.encode)
    trees = {g: climb([x[2] for x in sorted(groups[g])]) for g in names}
    root, top = climb([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, top):
        for (_, doc_id, d, spoilt), path in zip(sorted(groups[g]), trees[g][1]):
            folded = spoilt
            for left, right in path + above:
                folded = sha(left + folded + right)
            out.append((doc_id, d, trees[g][0], root, sha("".join(a + b for a, b in path + above)), folded, folded == root))
    return sorted(out, key=str)


def test_merkle_manifest(spark, docs, dirty, empty):
    assert sorted(map(tuple, registry.op11(spark, SF_SMALL).collect()), key=str) == brute_manifest(docs.collect())
    got = merkle.verify(merkle.manifest(dirty)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(dirty.collect())
    assert merkle.manifest(empty).count() == 0


@pytest.mark.parametrize("n", [1, 16, 17, 257, 4097])
def test_merkle_tree_sizes(spark, n):
    """One group of n rows: lone leaves, full runs, runs of one node, three and four levels."""
    made = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("Text").alias("text"), F.lit("en").alias("lang"),
                                 F.lit("s").alias("source"), F.lit(4).alias("n_chars"))
    got = merkle.verify(merkle.manifest(made)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(made.collect())
    spoilt = {i for i in range(n) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {r["doc_id"] for r in got if not r["verified"]} == spoilt


def test_merkle_ranges_of_a_hot_group(spark):
    """Indexes run on over the partitions that a group is spread over."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("grp"),
                                    (-F.col("id")).alias("k"))
    got = merkle.indexed(rows, "grp", ["k"], Scratch(spark, "t"), "rows").collect()
    for g in {r["grp"] for r in got}:
        own = sorted((r["k"], r["idx"], r["n"]) for r in got if r["grp"] == g)
        assert [x[1] for x in own] == list(range(len(own))) and {x[2] for x in own} == {len(own)}


# op12

def brute_cut(rows, size=suffix.LENGTH):
    last = 2**63
    texts = [(last if r["doc_id"] is None else r["doc_id"], r["doc_id"], (r["text"] or "").encode()) for r in rows]
    least = {}
    for d, _, b in sorted(texts, key=lambda x: x[0]):
        for k in range(len(b) - size + 1):
            least.setdefault(b[k:k + size], d)
    out = []
    for d, doc_id, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if least[b[k:k + size]] < d:
                gone[k:k + size] = b"\1" * size
        kept = bytes(c for c, x in zip(b, gone) if not x)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def figures(df):
    return sorted((tuple(r) for r in df.drop("kept").collect()), key=str)


def quoting(spark, copies=40):
    """Documents that quote a passage whole or in part, at any place, beside text of their own."""
    rng = random.Random(5)
    said = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = []
    for i in range(copies):
        a = rng.randrange(0, 200)
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 300)))
        rows.append((i * 7 % 41, own + said[a:a + rng.choice([49, 50, 51, 120, 200])] + own[:30] + said[:rng.choice([0, 60])]))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("limit", [suffix.MEMBERS, 4, 1])
def test_passages(spark, docs, dirty, empty, limit):
    """All ways for an anchor's pieces: one suffix array, one after equal pieces have collapsed, and window by window."""
    for table in (dirty, quoting(spark)):
        assert figures(suffix.dedup_passages(table, limit)) == brute_cut(table.collect())
    assert suffix.dedup_passages(empty, limit).count() == 0
    if limit == suffix.MEMBERS:
        assert figures(suffix.dedup_passages(docs)) == brute_cut(docs.collect())


def test_stretches_and_runs(monkeypatch):
    """Long texts are cut into stretches that hold every window once; runs hold every window of every part once."""
    monkeypatch.setattr(suffix, "SLICE", 64)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in (400, 49, 50, 51, 113, 114, 0)] + ["a" * 300, "ab" * 90 + "\0" * 80]
    frame = pd.DataFrame({"d": range(9), "version": 0, "text": texts})
    lots = list(suffix.stretches([frame, frame.tail(1)]))  # the last row comes twice at once: it counts once
    held = [x for lot in lots for x in lot]
    for k, t in enumerate(texts):
        at = [(o + i, data[i:i + 50]) for (d, _), o, data in held if d == k for i in range(len(data) - 49)]
        assert sorted(at) == [(i, t.encode()[i:i + 50]) for i in range(len(t) - 49)]
    for lot in lots:
        parts = [data for _, _, data in lot]
        raw, part, first, count, anchor = suffix.runs(parts)
        begin = np.cumsum([0, *map(len, parts)])
        windows = [(p, f - begin[p] + i) for p, f, c in zip(part, first, count) for i in range(c)]
        assert sorted(windows) == [(p, i) for p, x in enumerate(parts) for i in range(len(x) - 49)]
        assert not len(count) or count.max() <= suffix.RUN
        by_text = {}
        for p, f, c, a in zip(part, first, count, anchor):
            for i in range(c):
                assert by_text.setdefault(raw[f + i:f + i + 50].tobytes(), a) == a  # equal windows, equal anchors


def test_pieces_of_one_batch():
    """Pieces collapse to the least id; what a larger id has of them is gone, at all its places."""
    said = bytes(random.Random(1).choices(b"abcdefg", k=200)).decode()
    rows = [(7, 1, "x" * 60 + said), (3, 1, said + "-" + said), (9, 1, said[:120]), (9, 2, "q" + said[:120])]
    raw, part, first, count, anchor = suffix.runs([t.encode() for _, _, t in rows])
    every = [np.unique(suffix.short_anchor(anchor, 4)).tobytes()]
    frame = pd.DataFrame([(d, v, t, every) for d, v, t in rows], columns=["d", "version", "text", "shared"])
    found = pd.concat(suffix._pieces(4)([frame]))
    texts = {(d, v): t.encode() for d, v, t in rows}
    for r in found.to_dict("records"):
        starts = np.frombuffer(r["starts"], np.int64)
        if r["piece"] is not None:
            assert all(texts[r["d"], r["version"]][s:s + len(r["piece"])] == r["piece"] for s in starts) and 50 <= len(r["piece"]) <= 84
        else:
            for s, n in zip(starts, np.frombuffer(r["lengths"], np.int64)):
                cut = texts[r["d"], r["version"]][s:s + n]
                assert any(cut in t for (d, _), t in texts.items() if d < r["d"])
    opened = found[found["piece"].notna()]
    assert opened.groupby("piece")["d"].nunique().max() == 1


def test_maximal_repeats_against_all_pairs():
    """Every maximal repeat of the members with all its occurrences, as comparing all places finds them."""
    rng = random.Random(3)
    said = bytes(rng.choice(b"ab") for _ in range(90))
    members = [said[:84], b"x" + said[3:80], said[10:70] + b"q", said[3:80] + b"z", said[20:84], b"ab" * 40, b"ba" * 41, b"\0" * 55, b"\0" * 53]
    member, offset, depth, first, last = suffix.maximal_repeats(members)
    got = {}
    for d, a, b in zip(depth, first, last):
        places = {(int(member[r]), int(offset[r])) for r in range(a, b + 1)}
        strings = {members[m][o:o + d] for m, o in places}
        assert len(strings) == 1
        got[strings.pop()] = places
    want = {}
    for m, x in enumerate(members):
        for o in range(len(x) - 49):
            for n in range(50, len(x) - o + 1):
                want.setdefault(x[o:o + n], set()).add((m, o))
    def maximal(s, places):
        right = {members[m][o + len(s):o + len(s) + 1] or ("end", m, o) for m, o in places}
        left = {members[m][o - 1:o] if o else ("start", m, o) for m, o in places}
        return len(places) > 1 and len(right) > 1 and len(left) > 1
    assert got == {s: p for s, p in want.items() if maximal(s, p)}


def brute_windows(rows):
    """Every window of 50 bytes that several texts have: its places."""
    seen = {}
    for doc_id, text in {(r["doc_id"], r["text"] or "") for r in rows}:
        data = text.encode()
        for k in range(len(data) - 49):
            seen.setdefault(data[k:k + 50], set()).add((doc_id, text, k))
    return {w: {(d, k) for d, _, k in p} for w, p in seen.items() if len({x[:2] for x in p}) > 1}


@pytest.mark.parametrize("limit", [suffix.MEMBERS, 1])
def test_repeat_groups(spark, dirty, limit):
    """Groups hold equal bytes, all their occurrences, and between them every window that repeats."""
    table = quoting(spark).unionByName(spark.createDataFrame([(100, SAME), (101, SAME), (102, "x" * 200)], "doc_id long, text string"))
    rows = table.collect()
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], []).append((r["text"] or "").encode())
    groups = {}
    for r in suffix.repeat_groups(table, limit).collect():
        groups.setdefault((r["repeat"], r["length"]), set()).add((r["doc_id"], r["start"]))
    want, got = brute_windows(rows), set()
    for (_, n), places in groups.items():
        cuts = [{t[s:s + n] for t in texts[d]} for d, s in places]
        common = set.intersection(*cuts)
        assert len(places) > 1 and len(common) == 1 and n >= 50
        passage = common.pop()
        for k in range(n - 49):
            w = passage[k:k + 50]
            got.add(w)
            if w in want:
                assert {(d, s + k) for d, s in places} <= want[w]
        if limit == 1:
            assert places == want[passage]  # window by window, all occurrences
    assert set(want) <= got
    assert suffix.repeat_groups(table.limit(0)).count() == 0


# op13

def brute_audit(docs, labels):
    said = {}
    for r in labels:
        q, t = said.get(r["doc_id"], (False, False))
        said[r["doc_id"]] = (q or r["quality"] == 1, t or r["toxic"] == 1)
    first = {}
    for r in docs:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            first[t] = min(first.get(t, r["doc_id"]), r["doc_id"])
    parts = {}
    for r in docs:
        t = r["text"] or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": r["doc_id"] is not None and t in first and first[t] < r["doc_id"]}
        good, toxic = said.get(r["doc_id"], (False, False)) if r["doc_id"] is not None else (False, False)
        parts.setdefault(r["lang"] or "", []).append((frozenset(x for x in fails if fails[x]), good, toxic))
    out = []
    for part, rows in parts.items():
        removed_at, lines = {}, []
        for order in permutations("ABCDE"):
            left = rows
            for k, x in enumerate(order):
                out_now = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                removed_at[x] = removed_at.get(x, 0) + len(out_now)
                lines.append((x, part, "".join(order), k + 1, len(left), len(out_now), sum(x in r[0] for r in rows) - len(out_now),
                              sum(r[0] == {x} for r in rows), sum(r[1] for r in out_now), sum(r[2] for r in out_now)))
        out += [(*line[1:], removed_at[line[0]]) for line in lines]
    return sorted(out)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit(spark, docs, dirty, empty):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    got = registry.op13(spark, SF_SMALL).select(*AUDIT)
    assert sorted(map(tuple, got.collect())) == brute_audit(docs.collect(), labels.collect())
    said = spark.createDataFrame([(3, 1, 0, "x"), (3, 0, 1, "x"), (5, None, 1, "x"), (None, 1, 1, "x"), (99, 1, 1, "x")],
                                 "doc_id long, quality int, toxic int, part string")
    got = audit.audit(dirty, said).select(*AUDIT)
    assert sorted(map(tuple, got.collect())) == brute_audit(dirty.collect(), said.collect())
    assert audit.audit(empty, said).count() == 0 and audit.audit(dirty, said.limit(0)).count() == 3 * 600


def test_posting_lists(spark, dirty, monkeypatch):
    """Lists are ascending, hold each failing row once, and any cut into ranges gives the same sums."""
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    whole = audit.interactions(audit.postings(dirty, labels))
    monkeypatch.setattr(audit, "RANGE_BITS", 1)
    lists = audit.postings(dirty, labels)
    rows = lists.collect()
    assert len(rows) > 3 and sum(r["n"] for r in rows) == len(DIRTY) and all(r["n"] <= 2 for r in rows)
    assert all(list(r[x]) == sorted(set(r[x])) for r in rows for x in audit.LISTS)
    assert sorted(map(tuple, audit.interactions(lists).collect())) == sorted(map(tuple, whole.collect()))


def test_merges_of_posting_lists():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lists = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(rng.integers(0, 6))]
        both = sorted(set().union(*map(set, lists)))
        assert audit.union(lists).tolist() == both
        for x in lists:
            assert audit.among(x, np.array(both, np.int64)).all()
            assert x[audit.among(x, lists[0])].tolist() == sorted(set(x.tolist()) & set(lists[0].tolist()))
