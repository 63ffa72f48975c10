"""Thin queries of the operators over whole tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import ann, audit, bpe, chat, langid, line_dedup, merkle, minhash, packing, pii, suffix, topk, warc
from tallyframe.llm.common import LOWER, UPPER, Scratch


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies: in ``TALLYFRAME_TOKENIZERS``, else in the installed package."""
    if where := os.environ.get("TALLYFRAME_TOKENIZERS"):
        return os.path.join(where, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data and of terms that give it away, per document."""
    found = pii.find(read(spark, sf_dir, "documents"))
    counts = [f"n_{k}" for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                        "spans",
                        F.when(F.col("added") == "", 0).otherwise(F.size(F.split("added", ","))).cast("long").alias("n_added"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    hard = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], table.schema)
    return chat.read_back(chat.format_turns(table.unionByName(hard)))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    return langid.predict(docs.drop("lang"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them, as digests."""
    return bpe.encode_documents(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), split_pattern())


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every fiftieth vector."""
    table = read(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    rows = table.select(F.col("vec_id").alias("id"), whole.alias("vec"))
    return topk.top_k(rows, rows.where("id % 50 = 0"), 5)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return ann.nearest(rows, rows.where("id % 20 = 0"), 20)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents, one of each kept."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and indexed, then looked up by their URLs: directory, blocks, ranges."""
    scratch = Scratch(spark, "warc")
    pages = read(spark, sf_dir, "pages")
    archives = scratch.keep("archives", warc.write_archives(pages))
    records = scratch.keep("records", warc.read_archives(archives))
    index = scratch.keep("index", warc.build_index(records))
    back = warc.sound(warc.lookup(archives, index, pages.select("url"), keep_payload=False))
    return back.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                       "refers_to")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a copy with some texts lower-cased still verifies."""
    return merkle.verify(merkle.manifest(read(spark, sf_dir, "documents")))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of passages that a document of smaller id has."""
    return suffix.dedup_passages(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, per language."""
    return audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_pii_sanitise": op1,
    "op2_line_dedup": op2,
    "op3_chat_format": op3,
    "op4_language_id": op4,
    "op5_byte_bpe": op5,
    "op6_best_fit_packing": op6,
    "op7_exact_topk": op7,
    "op8_learned_partitions": op8,
    "op9_minmax_dedup": op9,
    "op10_warc_index": op10,
    "op11_merkle_manifest": op11,
    "op12_suffix_dedup": op12,
    "op13_filter_audit": op13,
}


def _merkle_sql(levels: int = 8) -> str:
    """The manifest as one CTE a level; ``levels`` runs of 16 hold any table of up to 16^levels rows a source."""
    def framed(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def tree(name: str) -> str:
        out = []
        for k in range(levels):
            w = "PARTITION BY grp, idx // 16 ORDER BY idx"
            out.append(f"""
        {name}s{k} AS (SELECT *, coalesce(string_agg(d, '') OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                       coalesce(string_agg(d, '') OVER ({w} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
                FROM {name}{k} WHERE n > 1),
        {name}{k + 1} AS (SELECT grp, idx // 16 AS idx, (any_value(n) + 15) // 16 AS n, sha256(string_agg(d, '' ORDER BY idx)) AS d
                FROM {name}s{k} GROUP BY grp, idx // 16),""")
        ones = " UNION ALL ".join(f"SELECT grp, d FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
        return "".join(out) + f"\n        {name}_roots AS ({ones}),"

    def climb(name: str, start: str, digest: str, steps: str) -> str:
        """Walk ``start`` (grp, pos, proof, {digest}) up the tree, a CTE a level."""
        out = [f"{steps}0 AS ({start}),"]
        for k in range(levels):
            out.append(f"""
        {steps}{k + 1} AS (SELECT w.* REPLACE (CASE WHEN s.grp IS NULL THEN w.pos ELSE w.pos // 16 END AS pos, proof || coalesce(l || r, '') AS proof,
                CASE WHEN s.grp IS NULL THEN w.{digest} ELSE sha256(l || w.{digest} || r) END AS {digest})
                FROM {steps}{k} w LEFT JOIN {name}s{k} s ON s.grp = w.grp AND s.idx = w.pos),""")
        return "".join(out)

    crc = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
             lambda i: list_concat([ord(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""
    fields = " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
        WITH leaves AS (
            SELECT doc_id, coalesce('+' || source, '') AS grp, sha256({fields} || {framed("text")}) AS d,
                   CASE WHEN ({crc}) % 5 = 0 THEN sha256({fields} || {framed(lowered)}) END AS spoilt FROM documents),
        a0 AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
        {tree("a")}
        b0 AS (SELECT '' AS grp, grp AS label, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n, d FROM a_roots),
        {tree("b")}
        {climb("a", "SELECT doc_id, grp, idx AS pos, '' AS proof, d AS leaf, coalesce(spoilt, d) AS folded FROM a0", "folded", "p")}
        {climb("b", f"SELECT doc_id, '' AS grp, b0.idx AS pos, proof, leaf, folded, b0.d AS subroot FROM p{levels} p JOIN b0 ON b0.label = p.grp", "folded", "q")}
        done AS (SELECT * FROM q{levels})
        SELECT doc_id, leaf, subroot, b_roots.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b_roots.d AS verified
        FROM done JOIN b_roots ON true"""


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {
    "op2_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, pos, ls[pos] AS line, translate(trim(ls[pos], {_SPACE}), '{UPPER}', '{LOWER}') AS k
            FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS pos
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
        shared AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(shared.k) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE shared.k IS NULL), '')) AS kept_sha256
        FROM lines LEFT JOIN shared USING (k) GROUP BY doc_id""",
    "op7_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op9_minmax_dedup": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                             '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
        shingles AS (
            SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                   ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON x = other),
        least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)""",
    "op10_warc_index": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op11_merkle_manifest": _merkle_sql(),
    "op13_filter_audit": """
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
                          list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
        f AS (SELECT part, (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
                     + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x))::INT
                     + 8 * regexp_matches(x, '[#$%&*|]')::INT
                     + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false)::INT AS m,
                     coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
              FROM t LEFT JOIN labels USING (doc_id)),
        c AS (SELECT part, m, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY 1, 2),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
        o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bs FROM l p, l q, l r, l s, l t
              WHERE p.b | q.b | r.b | s.b | t.b = 31),
        steps AS (SELECT filter_order, step, bs[step] AS b, coalesce(list_sum(bs[1:step - 1]), 0)::INT AS pre
                  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        g AS (SELECT part, filter_order, step, b,
                     coalesce(sum(n) FILTER (WHERE m & (pre | b) = 0), 0)::BIGINT AS kept,
                     coalesce(sum(n) FILTER (WHERE m & b > 0 AND m & pre = 0), 0)::BIGINT AS removed,
                     coalesce(sum(n) FILTER (WHERE m & b > 0 AND m & pre > 0), 0)::BIGINT AS redundant,
                     coalesce(sum(n) FILTER (WHERE m = b), 0)::BIGINT AS unique_fails,
                     coalesce(sum(good) FILTER (WHERE m & b > 0 AND m & pre = 0), 0)::BIGINT AS good_lost,
                     coalesce(sum(toxic) FILTER (WHERE m & b > 0 AND m & pre = 0), 0)::BIGINT AS toxic_lost
              FROM c, steps GROUP BY part, filter_order, step, b)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley FROM g""",
}
