"""Each operator against brute force, a round trip or held-out accuracy, on whole small tables and on dirty rows."""

import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from tallyframe.llm import ann, bpe, chat, langid, line_dedup, minhash, packing, pii, registry, topk, warc
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, rank int, lines string"
LONG = "word " * 3000 + "end"
DIRTY = [
    (1, None, None, None, None, "x", 1, "y"),
    (2, "", "en", "s", 0, "x", 1, "y"),
    (3, "  \n\t\n", "en", "s", 5, None, 1, None),
    (4, "Mail a.b@c.de or x@y, 10.0.0.1 and 300.1.1.1; card 4111 1111 1111 1111, call +49 (30) 1234567.", "en", "s", 9, "x", 1, "y"),
    (4, "Mail a.b@c.de or x@y, 10.0.0.1 and 300.1.1.1; card 4111 1111 1111 1111, call +49 (30) 1234567.", "en", "s", 9, "x", 1, "y"),
    (5, "one two three four five six\n\nOne  two\rthree\x0b", None, "s", 9, "x", 1, "y"),
    (6, LONG, "en", "s", 9, "x", 1, "y"),
    (7, "123 456 !!!", "en", "s", 9, "x", 1, "y"),
    (8, "naïve 漢字 \U0001f642 é <|endoftext|>  double  spaces \n x ", "fr", "s", 9, "x", 1, "y"),
    (None, "no id here at all, friends", "en", "s", 9, "x", 1, "y"),
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


def rows(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


# op1

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def brute_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m[0])
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_pii_base_spans(spark, docs, dirty):
    for text in ["a@b.c@d.e", "x@y.z..w @q.r", "1.2.3.4.5.6.7.8", "0001.2.3.4", "a@@b.cc a@b-.c", "++12345678(9)0 4111-1111 1111-1111"] + [r[1] or "" for r in DIRTY]:
        assert pii.base_spans(text) == brute_spans(text), text
    got = rows(registry.op1(spark, SF_SMALL), "doc_id")
    for r in docs.collect():
        spans = brute_spans(r["text"])
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [got[r["doc_id"]][f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in spans) for i in range(4)]


def test_pii_disclosing_terms(spark, empty, dirty):
    said = [(i, f"common words {i} zorblax@mail.example.org belongs to Zorblax today", "en", "s", 1, "", 1, "") for i in range(6)]
    other = [(100 + i, "common words today belongs to nobody", "en", "s", 1, "", 1, "") for i in range(200)]
    made = spark.createDataFrame(said + other, DOCS)
    found = rows(pii.find(made), "doc_id")
    text = said[0][1]
    at = text.index("Zorblax")
    assert found[0]["added"] == f"removed:{at}:{at + 7}"  # only what the entity's documents alone have
    assert all(found[100 + i]["added"] == "" for i in range(200))
    clean = rows(pii.sanitise(made), "doc_id")
    assert clean[0]["text"] == "common words 0 [EMAIL] belongs to  today" and clean[100]["text"] == other[0][1]
    assert clean[0]["lines"] == "" and set(made.columns) < set(pii.sanitise(made).columns)
    assert pii.find(empty).count() == 0 and pii.sanitise(dirty).count() == len(DIRTY)
    assert pii.redact("ab cd", "generalised:0:2") == "[TERM] cd" and pii.redact(None, "") is None


def test_pii_runs_of_zeros(spark):
    """Parts of an address may have any number of zeros before them."""
    zeros = "0" * 5000
    for text in (zeros + ".1.1.1", f"1.{zeros}.{zeros}7.255", zeros + "256.1.1.1", "1" * 5000 + ".1.1.1", "000.00.0.0"):
        want = [(0, 1, len(text))] if not text.startswith(zeros + "256") and text[0] + text[3] != "11" else []
        assert [x for x in pii.base_spans(text) if x[1] == 1] == want
    made = spark.createDataFrame([(1, zeros + ".1.1.1"), (2, "plain")], "doc_id long, text string")
    assert rows(pii.find(made), "doc_id")[1]["n_ip"] == 1 and rows(pii.sanitise(made), "doc_id")[1]["text"] == "[IP]"


@pytest.mark.parametrize("named", [36, 15])
def test_pii_address_of_a_whole_site(spark, named):
    """An address that many documents name takes no ordinary word with it, from no document; a rare one still does."""
    footer = "please write to desk@site.example.org for help"
    said = [(i, f"sold here today item{i} {footer if i < named else 'please write to us for help'}") for i in range(60)]
    hidden = [(100 + i, "Zorblax z@only.example.org sold here today") for i in range(4)]
    found = rows(pii.find(spark.createDataFrame(said + hidden, "doc_id long, text string")), "doc_id")
    assert all(found[i]["added"] == "" for i in range(60))
    assert all(found[100 + i]["added"] == "removed:0:7" for i in range(4))
    clean = rows(pii.sanitise(spark.createDataFrame(said + hidden, "doc_id long, text string")), "doc_id")
    assert [clean[i]["text"] for i in range(60)] == [t.replace("desk@site.example.org", "[EMAIL]") for _, t in said]


def test_pii_long_text_of_many_entities(spark):
    """A term near thousands of entities is held once with its places; long runs of digits are read once."""
    text = " ".join(f"Contact u{i}@mail.example.org" for i in range(4000))
    hidden = "\u0130zmir k@only.example.org"
    made = spark.createDataFrame([(1, text), (1, text), *((i, hidden) for i in range(2, 6)), *((i, "plain") for i in range(6, 60))],
                                 "doc_id long, text string")
    found = pii.find(made).collect()
    assert [r["n_email"] for r in found if r["doc_id"] == 1] == [4000, 4000]
    assert {r["added"] for r in found if 2 <= r["doc_id"] < 6} == {"removed:0:5"}
    scanned = list(pii._scan(pii.WINDOW)([pd.DataFrame({"doc_id": [1], "text": [text], "version": [0]})]))[0]
    assert [len(x) for x in scanned["at"][0]] == [8000] and scanned["at_terms"][0] == ["contact"]
    assert pii.base_spans("1" * 300_000 + " 1.2.3.4") == [(300_001, 1, 300_008)]


def test_pii_terms_far_from_the_entity(spark):
    """Windows nominate terms; whole documents count them, and the verdict holds wherever a term stands."""
    gap = " common words of no weight at all today"
    said = [f"Zorblax z@mail.example.org{gap}" if i < 2 else f"z@mail.example.org{gap} Zorblax" for i in range(10)]
    said += [f"Quuxly q@mail.example.org{gap}" if i < 3 else f"q@mail.example.org{gap} Quuxly" for i in range(24)]
    said += ["Zorblax alone"] + ["common words of no weight at all today"] * 200 + ["m@mail.example.org"] * 5 + ["mail example org"] * 40
    made = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(made).collect()}
    for i, text in enumerate(said):
        want = re.sub("Zorblax|Quuxly", "", EMAIL.sub("[EMAIL]", text))
        assert clean[i] == want, (i, clean[i])
    assert pii.marked(pii.marks(spark, made.limit(0).select(made.text.alias("key"))).value, "x") is False
    bits = pii.marks(spark, made.select(made.text.alias("key"))).value
    assert all(pii.marked(bits, t) for t in said) and sum(map(int.bit_count, bits)) == len(set(said))


def test_pii_window_counts_words(spark):
    """Six words on either side are near, however long they are."""
    key, outer = "0af9" * 40, [c * 30 for c in "abcdefg"]
    text = " ".join([*outer, "k@only.example.org", key, *outer[::-1]])
    spans = pii.base_spans(text)
    near = {t for _, t in pii.context(text, spans, pii.Covered(spans), 6)}
    assert near == {key, *outer[1:]}
    text = f"k@only.example.org {key} end"
    made = spark.createDataFrame([*((i, text) for i in range(5)), *((i, "the end") for i in range(5, 60))], "doc_id long, text string")
    assert {r["text"] for r in pii.sanitise(made).collect()} == {"[EMAIL]  end", "the end"}


# op2

def brute_lines(data, least):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    seen = defaultdict(set)
    for i, t in data:
        for x in (t or "").split("\n"):
            seen[key(x)].add(i)
    gone = {k for k, v in seen.items() if k and len(v) >= least}
    return [(i, len((t or "").split("\n")), "\n".join(x for x in (t or "").split("\n") if key(x) not in gone)) for i, t in data]


@pytest.mark.parametrize("least", [2, 10])
def test_line_dedup(spark, docs, dirty, empty, least):
    for df in (docs, dirty):
        want = Counter(brute_lines([(r["doc_id"], r["text"]) for r in df.collect()], least))
        out = line_dedup.dedup_lines(df, least)
        assert Counter((r["doc_id"], r["n_lines"], r["kept_text"]) for r in out.collect()) == want
    assert line_dedup.dedup_lines(empty).count() == 0


# op3

def test_chat_round_trip(spark):
    hard = ["", None, "### user: x </turn>\n", "\\", "a\\", "\\\\### ", "</turn>", " </turn>\n### assistant: y", "a: b", "\\n", "plain"]
    data = [(c, t, r, x) for c in (1, None) for t, x in enumerate(hard) for r in ("user", "assistant", "a: b", None)]
    table = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    made = chat.format_turns(table)
    assert all(chat.parse(r["formatted"]) == [(r["role"], r["text"], *chat.parse(r["formatted"])[0][2:])] for r in made.collect())
    got = rows(chat.read_back(made), "conv_id")
    for conv in (1, None):
        turns = sorted((t, r or "", x or "") for c, t, r, x in data if c == conv)
        assert got[conv]["n_turns"] == len(turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(table.limit(0))).count() == 0
    with pytest.raises(chat.GrammarError):
        chat.parse("### user: unfinished")


def test_chat_query(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    got = rows(registry.op3(spark, SF_SMALL), "conv_id")
    turns = defaultdict(list)
    for r in table:
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    said = "\\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", said), (1, "assistant", said)]
    assert set(got) == set(turns)
    for conv, own in turns.items():
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in sorted(own)).encode()).hexdigest()


# op4

def test_language_id(spark, docs, dirty, empty):
    got = rows(registry.op4(spark, SF_SMALL), "doc_id")
    held = [r for r in docs.collect() if got[r["doc_id"]]["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held if r["lang"] and any(map(str.isalpha, r["text"] or ""))]
    assert np.mean(right) > 0.9
    model = langid.fit(docs)
    out = langid.predict(dirty, model).collect()
    assert len(out) == len(DIRTY) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} == {1, 2, 3, 7}
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(dirty, langid.fit(empty)).collect()} == {"und"}


# op5

def test_bpe(spark, docs, dirty, empty):
    import tiktoken

    path, pattern = registry.vocabulary("byte_bpe_50k.tiktoken"), registry.split_pattern()
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    for df in (docs, dirty):
        got = [(r["doc_id"], list(r["ids"]), r["decoded_sha256"]) for r in bpe.encode_documents(df, path, pattern, True).collect()]
        own = [(r["doc_id"], want.encode_ordinary(r["text"] or ""), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in df.collect()]
        assert sorted(got, key=str) == sorted(own, key=str)
    assert bpe.encode_documents(empty, path, pattern).count() == 0
    codec = bpe.Codec(path, pattern)
    rng = np.random.default_rng(3)
    for size in rng.integers(1, 400, 300):
        text = "".join(rng.choice(list("the ing tion\n\té漢\U0001f642'sz9 "), size))
        assert codec.encode(text).tolist() == want.encode_ordinary(text)
        assert "".join(codec.decode_stream(codec.encode(text), 1)) == text


def test_utf8_stream():
    data = "a é 漢 \U0001f642 z".encode()
    for cut in range(len(data) + 1):
        s = bpe.Utf8Stream()
        assert s.feed(data[:cut]) + s.feed(data[cut:]) == data.decode()
        s.end()
    for bad in (b"\xff", b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\x80"):
        with pytest.raises(UnicodeDecodeError):
            s = bpe.Utf8Stream()
            s.feed(bad + b"a")
    with pytest.raises(UnicodeDecodeError):
        s = bpe.Utf8Stream()
        s.feed("é".encode()[:1])
        s.end()


# op6

def test_packing_token_ids_are_the_tokenizers(docs):
    """Both ways to the ids agree with the library of the file: on all texts, on characters of every kind, on long runs."""
    from tokenizers import Tokenizer

    def library(path):
        own = Tokenizer.from_file(path)
        own.encode_special_tokens = True
        return lambda text: own.encode(text, add_special_tokens=False).ids

    path, other = registry.vocabulary("byte_bpe_50k.json"), registry.vocabulary("word_bpe_49k.json")
    assert packing.byte_level_ranks(path) is not None and packing.byte_level_ranks(other) is None
    chars = [chr(c) for c in range(1, 0x30000, 41) if not 0xD800 <= c <= 0xDFFF] + [chr(c) for c in range(0x3000)]
    mixed = [" ".join(f"a{c}b1{c} {c}{c} '{c}s!{c}" for c in chars[k:k + 500]) + "\n ".join(chars[k:k + 500]) for k in range(0, len(chars), 500)]
    texts = [r["text"] or "" for r in docs.collect()] + mixed + ["", "<|endoftext|> x", " " * 5000 + "x", "a" * 20_000, "\r\n\t \u3000\x85 it's we'LL"]
    for file, some in ((path, texts), (other, texts[:20])):
        encode, plain = packing.token_ids(file), library(file)
        assert all(np.frombuffer(encode(t), "<u4").tolist() == plain(t) for t in some)


def test_packing(spark, docs, dirty, empty):
    from tokenizers import Tokenizer

    path = registry.vocabulary("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    for df, size in ((docs, 2048), (dirty, 64)):
        out = [r.asDict() for r in packing.pack(df, path, size).collect()]
        by_doc, held = defaultdict(list), defaultdict(list)
        for r in out:
            by_doc[r["doc_id"]].append(r)
            held[r["sequence_id"]].append((r["offset"], r["length"]))
        want = defaultdict(list)
        for d in df.collect():
            ids = own.encode(d["text"] or "", add_special_tokens=False).ids + [0]
            first = (len(ids) - 1) % size + 1
            edges = [0, *range(first, len(ids) + 1, size)]
            want[d["doc_id"]] += [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
        assert {k: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
        for places in held.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= size
        least = -(-sum(r["length"] for r in out) // size)
        assert len(held) <= 1.05 * least + 1
        gaps = []  # plain best fit, longest first
        for n in sorted((r["length"] for r in out), reverse=True):
            fit = min((g for g in gaps if g >= n), default=None)
            if fit is not None:
                gaps.remove(fit)
            gaps.append((size if fit is None else fit) - n)
        assert sorted(size - sum(n for _, n in places) for places in held.values()) == sorted(gaps)
    assert packing.pack(empty, path).count() == 0


def test_sweep_is_best_fit():
    table = packing.sweep({60: 2, 40: 1, 30: 2, 10: 3}, 100)
    assert table[:, 2].max() == 2  # 250 tokens in three sequences
    assert sorted(map(tuple, table.tolist())) == [(10, 0, 1, 1, 90), (10, 1, 2, 2, 30), (30, 0, 1, 1, 60), (30, 1, 2, 1, 0), (40, 0, 0, 1, 60), (60, 0, 0, 1, 0)]


# op7, op8

def vectors(spark):
    rng = np.random.default_rng(5)
    vecs = [rng.standard_normal(8).round(2).tolist() for _ in range(300)] + [[0.5] * 8] * 40
    bad = [None, [0.0] * 8, [None, *[0.1] * 7], [float("nan"), *[0.1] * 7], [float("inf"), *[0.1] * 7]]
    return spark.createDataFrame([(i, v, 1, "x") for i, v in enumerate(vecs + bad)] + [(None, [0.1] * 8, 1, "x")], "id long, vec array<double>, rank int, score string"), vecs


def test_exact_top_k(spark):
    table, vecs = vectors(spark)
    whole = dict(enumerate(np.floor(256 * np.array(v)) for v in vecs)) | {341: np.zeros(8)}
    quantised = table.where(topk.usable(table["vec"])).selectExpr("id", "transform(vec, x -> cast(floor(256 * x) as double)) as vec")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(quantised, quantised.where("id % 10 = 0"), 5, 64, 16).collect()}
    want = {}
    for q in range(0, 340, 10):
        order = sorted((-int(whole[q] @ whole[c]), c) for c in whole if c != q)[:5]
        want |= {(q, k + 1): (c, -s) for k, (s, c) in enumerate(order)}
    assert got == want
    big = spark.createDataFrame([(i, [2.0**30 + i, 2.0**30, 1.0]) for i in range(4)], "id long, vec array<double>")
    top = topk.top_k(big, big.where("id = 0"), 2).collect()
    assert {(r["vec_id"], r["score"]) for r in top} == {(3, 2**30 * (2**30 + 3) + 2**60 + 1), (2, 2**30 * (2**30 + 2) + 2**60 + 1)}
    assert topk.top_k(quantised.limit(0), quantised.limit(0), 5).count() == 0 and topk.top_k(big, big.limit(0), 2).count() == 0


def test_exact_top_k_broadcasts_no_side(spark):
    """The driver holds neither side, however small the files look; the query blocks are moved once, not once a candidate block."""
    table = spark.range(0, 600, 1, 3).selectExpr("id", "array(cast(id % 7 as double), cast(id % 11 as double)) as vec")
    found = topk.top_k(table, table.where("id % 5 = 0"), 3, 50, 6)
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan
    want = {}
    for q in range(0, 600, 5):
        order = sorted((-((q % 7) * (c % 7) + (q % 11) * (c % 11)), c) for c in range(600) if c != q)[:3]
        want |= {(q, k + 1): (c, -s) for k, (s, c) in enumerate(order)}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows} == want and len(rows) == len(want)


def test_learned_partitions(spark):
    table, vecs = vectors(spark)
    got = defaultdict(list)
    for r in ann.nearest(table, table.where("id % 20 = 0"), 20).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 340, 20))
    hits = 0
    for q, found in got.items():
        found.sort()
        exact = {c: float(np.dot(vecs[q], vecs[c])) for c in range(340) if c != q}
        order = sorted((-s, c) for c, s in exact.items())
        assert [f[0] for f in found] == list(range(1, 21)) and all(abs(exact[c] - s) < 1e-9 for _, c, s in found)
        hits += sum(s >= -order[19][0] - 1e-9 for _, _, s in found)
    assert hits / (20 * len(got)) >= 0.9
    few = table.where("id < 5")
    assert ann.nearest(few, few.where("id = 0"), 20).count() == 4 and ann.nearest(table.limit(0), table.limit(0), 20).count() == 0


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    x, ids = np.array([r["embedding"] for r in table], float), [r["vec_id"] for r in table]
    place = {i: k for k, i in enumerate(ids)}
    got = defaultdict(set)
    for r in registry.op8(spark, "/root/testdata/sf0.1").collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = []
    for q, found in got.items():
        s = x @ x[place[q]]
        s[place[q]] = -np.inf
        hits.append(len(found & {ids[i] for i in np.argsort(-s)[:20]}) / 20)
    assert np.mean(hits) >= 0.9


def test_partitions_are_balanced():
    x = ann.unit(np.random.default_rng(1).standard_normal((512, 6)))
    sizes = np.bincount(ann.balanced_partitions(ann.neighbour_graph(x, 6), 8))
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 1


# op9

def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark, dirty, empty):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(60)]
    made = {}
    for i in range(120):  # one large group of edits, many of them just over or under the threshold
        own = list(base)
        for at in rng.choice(60, rng.integers(0, 5), replace=False):
            own[at] = f"x{rng.integers(10**6)}"
        made[i] = " ".join(own)
    made |= {200 + i: "Shared words " * 2 + str(i % 3) for i in range(9)} | {300: "", 301: None, 302: "a b", 303: "A  b\n"}
    df = spark.createDataFrame([(i, t, "x") for i, t in made.items()], "doc_id long, text string, node string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_groups(made)
    out = minhash.near_duplicates(dirty).collect()
    assert len(out) == len({r[0] for r in DIRTY}) and all(r["kept"] for r in out)
    assert minhash.near_duplicates(empty).count() == 0


def test_near_duplicates_on_documents(spark, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in registry.op9(spark, SF_SMALL).collect()}
    assert got == brute_groups({r["doc_id"]: r["text"] for r in docs.collect()})


# op10

def test_warc_damaged_record(spark, docs):
    pages = spark.createDataFrame([(k, f"http://a.example/{k}", "x" * 200 + str(k)) for k in range(5)], "page_id long, url string, html string")
    archives = warc.write_archives(pages)
    assert warc.sound(warc.read_archives(archives)).count() == 5

    def spoil(batches):
        for batch in batches:
            yield batch.assign(member=[gzip.compress(gzip.decompress(m).replace(b"xxx3", b"yyy3")) for m in batch["member"]])

    spoilt = warc.read_archives(archives.mapInPandas(spoil, archives.schema))
    assert spoilt.where("not intact").count() == 1
    with pytest.raises(Exception, match="damaged record at"):
        warc.sound(spoilt).collect()


def test_warc(spark):
    data = [(1, "http://www.a.example.com/x?y#z", "<p>" + "a" * 200), (2, "https://b.org", "<p>" + "a" * 200), (3, None, None), (4, "http://b.org/", "short"),
            (5, "http://b.org/", "short"), (6, "http://c.net/\r\nX: y", "WARC/1.1\r\n\r\n" * 20), (2, "https://b.org", "<p>" + "a" * 200), (None, "http://d.e/", "\U0001f642" * 50)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in data], "page_id long, url string, html string, digest string, offset string")
    archives = warc.write_archives(pages).cache()
    records = warc.read_archives(archives, True)
    got = sorted((str(r["page_id"]), r["type"], r["refers_to"], bytes(r["payload"]).decode(), r["intact"]) for r in records.collect())
    want = sorted((str(i), "revisit" if i == 2 else "response", 1 if i == 2 else None, "" if i == 2 else h or "", True) for i, _, h in data)
    assert got == want
    whole = b"".join(bytes(r["member"]) for r in sorted(archives.collect(), key=lambda r: (r["archive"], r["offset"])))
    assert gzip.decompress(whole).count(b"WARC-Record-ID") == len(data)
    index = warc.build_index(records).cache()
    assert warc.captures(index).count() == len(data)
    asked = spark.createDataFrame([("http://b.org",), ("http://nowhere.com/",), ("http://a.example.com/x?y",)], "url string")
    for directory in (1, 1000):
        found = sorted(str(r["page_id"]) for r in warc.lookup(archives, index, asked, directory_rows=directory).collect())
        assert found == ["1", "2", "2", "4", "5"]
    none = warc.write_archives(pages.limit(0))
    assert none.count() == 0 and warc.captures(warc.build_index(warc.read_archives(none))).count() == 0
    assert warc.surt("https://www.Sub.Example.com:443/a?b#c") == "com,example,sub)/a?b" and warc.surt("http://x.y:81?q") == "y,x:81)/?q"


def test_warc_query_reads_through_lookup(spark, scratch_dir, monkeypatch):
    rows = [(k, f"http://a.example/{k % 7} b\n", f"{'x' * 200}{k % 5}") for k in range(40)] + [(99, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{scratch_dir}/pages.parquet")
    calls = []
    looked_up = warc.lookup
    monkeypatch.setattr(warc, "captures", lambda index: pytest.fail("the index is listed"))
    monkeypatch.setattr(warc, "lookup", lambda *a, **kw: calls.append(a) or looked_up(*a, **kw))
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in registry.op10(spark, scratch_dir).collect())
    assert calls and got == [(k, "revisit" if k >= 5 else "response", k % 5 if k >= 5 else None) for k in range(40)] + [(99, "response", None)]


def test_warc_runs(spark):
    pages = spark.createDataFrame([(k, f"http://a.example/{k}", "x" * 20) for k in range(30)], "page_id long, url string, html string")
    archives = warc.write_archives(pages.coalesce(2)).cache()
    index = warc.build_index(warc.read_archives(archives)).cache()
    places = {r["page_id"]: (r["archive"], r["offset"], r["length"]) for r in warc.captures(index).collect()}
    covered = warc.runs_of(spark.createDataFrame(list(places.values()), "archive long, offset long, length int"), 10)
    assert {a: (f, e) for a, (f, e) in covered.items()} == {
        a: ([0], [max(o + n for b, o, n in places.values() if b == a)]) for a in {p[0] for p in places.values()}}
    asked = spark.createDataFrame([(f"http://a.example/{k}",) for k in range(0, 30, 3)], "url string")
    for most in (0, 100):  # by a join, and by runs sent to the tasks
        assert sorted(r["page_id"] for r in warc.lookup(archives, index, asked, most_runs=most).collect()) == list(range(0, 30, 3))


# pipeline

def test_pipeline(spark, dirty, empty):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "pii", "packing"]
    for df in (dirty, empty):
        now = df
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF_SMALL)
            assert now.columns == df.columns, name
        left = now.collect()
        assert {r["doc_id"] for r in left} <= {r[0] for r in DIRTY}
        assert not any("@c.de" in (r["text"] or "") for r in left)
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF_SMALL).count() >= len(left)


def test_language_stage(spark):
    """Without a model all text stays; with one, the likelihood decides: clean held-out text stays, junk with letters goes."""
    from corpus_pipeline import language_id

    docs = spark.read.parquet(SF_SMALL.replace("sf0.001", "sf0.01") + "/documents.parquet")  # enough rows for a firm model
    base = docs.collect()
    held = {r["doc_id"] for r in docs.where(langid.held_out(docs.doc_id)).collect()}
    schema = "doc_id long, text string, lang string"
    only_held = [(r["doc_id"], r["text"], r["lang"] if r["doc_id"] in held else None) for r in base]
    for data in ([(i, t, None) for i, t, _ in only_held], only_held):
        data = [*data, (10**6, None, None), (10**6 + 1, " \n\t", None), (10**6 + 2, "42", None)]
        kept = {r["doc_id"] for r in language_id(spark, spark.createDataFrame(data, schema), "").collect()}
        assert kept == {i for i, t, _ in data if t and t.strip()}
    junk = ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff" * 3, "Zm9vYmFyIGJheiBxdXV4IGFiYw==QkFaUVVY" * 3, "\x00\x01\x02\x03a\x04\x05",
            "@#$%^&*()_+ {}[]<>?/ ~` a ;:", "ДЖЯЩЫЭЮ" * 20]
    ids = range(10**6, 10**6 + len(junk))
    clean = [(r["doc_id"], r["text"], r["lang"]) for r in base]
    made = spark.createDataFrame([*clean, *((i, t, None) for i, t in zip(ids, junk))], schema)
    kept = {r["doc_id"] for r in language_id(spark, made, "").collect()}
    assert kept == {i for i, t, _ in clean if langid.has_letter(t or "")} and held & kept
    assert langid.in_language(made, langid.fit(made.limit(0))).count() == made.count()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_near_dedup_stage_with_repeated_ids(spark, kind):
    """Each text of an id is compared on its own, and one of identical rows stays."""
    from corpus_pipeline import near_dedup

    copy, own = (" ".join(f"{w}{i}" for i in range(n)) for w, n in (("copy", 80), ("own", 40)))
    data = [(-3, copy), (10, copy), (10, own), (10, own), (9, "short text"), (9, None), (None, copy), (None, "nobody's own text"), (11, own + " end")]
    made = spark.createDataFrame(data, "doc_id long, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text", "1 near_key")
    got = near_dedup(spark, made, "")
    assert got.columns == made.columns
    want = [(-3, copy), (10, own), (9, "short text"), (9, None), (None, "nobody's own text")]
    shown = lambda i: i if i is None or kind == "long" else str(i)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((shown(i), t) for i, t in want)
