"""WARC archives of pages with a two-level capture index.

Archives are tables of records: (archive, offset, length, member), ``member``
being one gzip member with one WARC/1.1 record.  The members of an archive by
offset, end to end, are a ``.warc.gz`` file; Parquet keeps them so that every
store Spark reads will do, tasks publish whole files only, and a range of
offsets is read by its row groups.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the smallest
page id is written as response, the others as revisits of it, without payload.

The index has two levels.  Captures (reversed-host URL key, page id, archive,
offset, length, digest, type) are range-sorted and written as compressed blocks
of at most ``BLOCK`` lines; the directory has the first and last key of each
block, of which a bounded, sparse part goes to the tasks.  ``lookup`` finds the
blocks of a key by binary search there, opens only those, finds the key in them
by binary search, and reads only the ranges that they name.

Defined results: null html is an empty payload, null url an empty URL; rows with
the same id are separate records, all of them responses where their id is the
payload's smallest; a null ``page_id`` is kept and is never referred to; extra
columns are ignored; empty tables give empty archives.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import Scratch, ship

MIN_REVISIT, BLOCK, DIRECTORY_ROWS, RANGED, RUNS, LEVEL = 100, 1024, 50_000, 200, 50_000, 4
DATE = "2024-01-01T00:00:00Z"  # the tables hold no capture time

ARCHIVE = "archive long, offset long, length int, member binary"
CAPTURE = ["urlkey", "page_id", "archive", "offset", "length", "digest", "type"]


def surt(url: str) -> str:
    """The URL with its host's labels reversed, scheme, port 80/443, leading www and fragment left out: com,example)/path?query."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:] or "/"
    name, _, port = host.partition(":")
    name = name.removeprefix("www.")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (path if path[0] == "/" else "/" + path)


def target(url: str) -> str:
    """The URL as a record's header has it: characters that could break a line are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id, url: str, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record."""
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Target-URI: {target(url)}", f"WARC-Date: {DATE}",
             f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
             "Content-Type: text/html; charset=utf-8"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = b"" if revisit else payload
    return "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def read_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; ValueError if it is none."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    n = int(headers["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the block's length is wrong")
    return headers, rest[:n]


def _page(value: str) -> int | None:
    text = value.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "None" else int(text)


def _write(batches):
    task, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        rows = []
        for page_id, url, html, digest, first, revisit in zip(*(batch[c] for c in ("page_id", "url", "html", "digest", "first", "revisit"))):
            page = None if page_id is None or page_id != page_id else int(page_id)
            refers = None if first is None or first != first else int(first)
            payload = html.encode() if isinstance(html, str) else b""
            member = gzip.compress(record(page, url if isinstance(url, str) else "", payload, digest, refers, revisit), LEVEL, mtime=0)
            rows.append((task, at, len(member), member))
            at += len(member)
        yield pd.DataFrame(rows, columns=["archive", "offset", "length", "member"])


def write_archives(pages: DataFrame) -> DataFrame:
    """The archive table of ``pages`` (page_id, url, html), an archive per task."""
    ship(pages.sparkSession)
    own = pages.select(F.col("page_id").alias("id"), F.coalesce(F.col("url"), F.lit("")).alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    sized = F.octet_length("html") >= MIN_REVISIT
    # hot payloads collapse before the shuffle; only payloads that occur again go to the join
    again = (own.where(sized).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
             .where("n > 1 and first is not null").select("digest", "first"))
    revisit = F.coalesce(sized & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.lit(False))
    rows = own.join(again, "digest", "left").select(F.col("id").cast("string").alias("page_id"), "url", "html", "digest",
                                                    F.col("first").cast("string").alias("first"), revisit.alias("revisit"))
    return rows.mapInPandas(_write, ARCHIVE)


def _read(keep_payload: bool):
    names = ["archive", "offset", "length", "page_id", "url", "type", "payload_bytes", "digest", "refers_to", "intact"] + ["payload"] * keep_payload

    def run(batches):
        for batch in batches:
            rows = []
            for archive, offset, length, member in zip(batch["archive"], batch["offset"], batch["length"], batch["member"]):
                headers, block = read_record(gzip.decompress(member))
                kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                whole = kind == "revisit" or (hashlib.sha256(block).hexdigest() == digest and len(block) == int(headers["X-Payload-Length"]))
                rows.append((archive, offset, length, _page(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], kind,
                             int(headers["X-Payload-Length"]), digest, _page(headers["WARC-Refers-To"]) if kind == "revisit" else None,
                             whole, *[bytes(block)] * keep_payload))
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    return run


def read_archives(archives: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Every record of an archive table, parsed; ``intact``: a response's payload has its digest and length."""
    ship(archives.sparkSession)
    schema = "archive long, offset long, length int, page_id long, url string, type string, payload_bytes long, digest string, refers_to long, intact boolean"
    return archives.mapInPandas(_read(keep_payload), schema + ", payload binary" * keep_payload)


def sound(records: DataFrame) -> DataFrame:
    """``records`` of :func:`read_archives`; one whose payload doesn't have its digest or length is an error."""
    said = F.concat_ws(" ", F.lit("damaged record at"), "archive", "offset")
    return records.where(F.when(F.col("intact"), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))


def _blocks(batches):
    task, n, lines, keys = TaskContext.get().partitionId(), 0, [], []

    def block():
        return pd.DataFrame({"block": [(task << 32) + n], "first_key": [keys[0]], "last_key": [keys[-1]], "lines": [len(lines)],
                             "data": [zlib.compress("\n".join(lines).encode(), 6)]})

    for batch in batches:
        for row in zip(*(batch[c] for c in CAPTURE)):
            keys.append(row[0])
            lines.append("\t".join(str(x) for x in row))
            if len(lines) == BLOCK:
                yield block()
                n, lines, keys = n + 1, [], []
    if lines:
        yield block()


def _surt_udf():
    @F.pandas_udf("string")
    def key(url: pd.Series) -> pd.Series:
        return url.map(lambda u: surt(target(u)))

    return key


def build_index(records: DataFrame) -> DataFrame:
    """The compressed blocks (block, first_key, last_key, lines, data) of the captures of ``read_archives``.

    Range-sorted by key, then page and place, so that a host with a third of all pages is several ranges.
    """
    ship(records.sparkSession)
    key = _surt_udf()
    rows = records.select(key("url").alias("urlkey"), F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page_id"),
                          "archive", "offset", "length", "digest", "type")
    order = ["urlkey", "page_id", "archive", "offset"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _blocks, "block long, first_key string, last_key string, lines int, data binary")


def _open(wanted):
    """Captures of each block, or those of the wanted keys, which are found by binary search in its lines."""

    def run(batches):
        for batch in batches:
            rows = []
            for k, data in enumerate(batch["data"]):
                lines = zlib.decompress(data).decode().split("\n")
                if wanted:
                    keys = [x[:x.index("\t")] for x in lines]
                    lines = [x for key in batch["keys"].iloc[k] for x in lines[bisect_left(keys, key):bisect_right(keys, key)]]
                for x in lines:
                    urlkey, page, archive, offset, length, digest, kind = x.rsplit("\t", 6)
                    rows.append((urlkey, int(page) if page else None, int(archive), int(offset), int(length), digest, kind))
            yield pd.DataFrame(rows, columns=CAPTURE).astype({"page_id": "Int64"})

    return run


SCHEMA = "urlkey string, page_id long, archive long, offset long, length int, digest string, type string"


def captures(index: DataFrame) -> DataFrame:
    """All captures of the index."""
    ship(index.sparkSession)
    return index.select("data").mapInPandas(_open(False), SCHEMA)


def find_blocks(index: DataFrame, keys: DataFrame, directory_rows: int = DIRECTORY_ROWS) -> DataFrame:
    """(block, urlkey) of every block whose range holds a key of ``keys`` (urlkey).

    A sparse directory of about ``directory_rows`` first keys at most goes to the tasks; keys and blocks
    are put between its entries by binary search and meet there.
    """
    every = max(1, -(-index.count() // directory_rows))
    sparse = index.where(F.pmod(F.xxhash64("block"), F.lit(every)) == 0).select("first_key").collect()
    shared = index.sparkSession.sparkContext.broadcast(sorted(r["first_key"] for r in sparse))

    @F.pandas_udf("int")
    def between(key: pd.Series) -> pd.Series:
        return key.map(lambda k: bisect_right(shared.value, k))

    spread = index.select("block", "first_key", "last_key", F.explode(F.sequence(between("first_key"), between("last_key"))).alias("slot"))
    asked = keys.select("urlkey").distinct().withColumn("slot", between("urlkey"))
    return asked.join(spread, "slot").where((F.col("urlkey") >= F.col("first_key")) & (F.col("urlkey") <= F.col("last_key"))).select("block", "urlkey")


def runs_of(ranges: DataFrame, most: int) -> dict[int, tuple[list[int], list[int]]] | None:
    """Archive -> ascending first and end offsets of what its ``ranges`` cover, neighbours joined; None for over ``most`` runs."""
    begin = ranges.select("archive", F.col("offset").alias("at"))
    end = ranges.select("archive", (F.col("offset") + F.col("length")).alias("at"))
    first = begin.join(end, ["archive", "at"], "left_anti").limit(most + 1).collect()
    if len(first) > most:
        return None
    out: dict[int, tuple[list[int], list[int]]] = {}
    for k, found in enumerate((first, end.join(begin, ["archive", "at"], "left_anti").collect())):
        for archive, at in sorted(map(tuple, found)):
            out.setdefault(archive, ([], []))[k].append(at)
    return out


def _in_runs(spark, runs: dict):
    shared = spark.sparkContext.broadcast(runs)

    @F.pandas_udf("boolean")
    def inside(archive: pd.Series, offset: pd.Series) -> pd.Series:
        out, archives, offsets = np.zeros(len(archive), bool), archive.to_numpy(), offset.to_numpy()
        for a in np.unique(archives):
            if int(a) in shared.value:
                first, end = shared.value[int(a)]
                rows = np.flatnonzero(archives == a)
                k = np.searchsorted(first, offsets[rows], "right") - 1
                out[rows] = (k >= 0) & (offsets[rows] < np.asarray(end)[k])
        return pd.Series(out)

    return inside


def lookup(archives: DataFrame, index: DataFrame, urls: DataFrame, keep_payload: bool = True, directory_rows: int = DIRECTORY_ROWS,
           most_runs: int = RUNS) -> DataFrame:
    """The records of ``urls`` (url): directory, then blocks, then ranges.

    Neighbouring ranges are read as one run, and up to ``most_runs`` runs go to the tasks that scan the archives, so no
    record is moved; with more of them a join finds the records.  Where the ranges lie in ``RANGED`` archives at most,
    each archive's range is a predicate that the scan prunes files and row groups by.
    """
    spark = archives.sparkSession
    ship(spark)
    key = _surt_udf()
    at = find_blocks(index, urls.select(key(F.coalesce(F.col("url"), F.lit(""))).alias("urlkey")), directory_rows)
    opened = index.join(at.groupBy("block").agg(F.sort_array(F.collect_set("urlkey")).alias("keys")), "block").select("data", "keys")
    ranges = Scratch(spark, "warc-lookup").keep("ranges", opened.mapInPandas(_open(True), SCHEMA).select("archive", "offset", "length"))
    runs = runs_of(ranges, most_runs)
    if runs is None:
        return read_archives(archives.join(ranges, ["archive", "offset", "length"], "left_semi"), keep_payload)
    if len(runs) <= RANGED:
        inside = F.lit(False)
        for archive, (first, end) in runs.items():
            inside = inside | ((F.col("archive") == archive) & (F.col("offset") >= first[0]) & (F.col("offset") < end[-1]))
        archives = archives.where(inside)
    return read_archives(archives.where(_in_runs(spark, runs)("archive", "offset")), keep_payload)
