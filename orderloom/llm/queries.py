"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    bin_packing,
    chat_format,
    conversation_repair,
    html_extract,
    mixing,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash,
    source_divergence,
    token_counts,
    topk_search,
    web_archive,
)
from orderloom.llm.common import read

# Fixed value: the conversation that the contract adds, full of the template's own marks.
PLANTED = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(
        [(-1, 0, "user", PLANTED), (-1, 1, "assistant", PLANTED)], "conv_id bigint, turn bigint, role string, text string"
    )
    formatted = chat_format.format_conversations(turns.unionByName(planted))
    whole = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.withColumn("loss", chat_format.masked_text(F.col("parsed"))).select(
        "conv_id",
        F.size("parsed").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "level",
        "round_trip",
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality_classifier.scored(docs, model)
    return scored.select(
        "doc.doc_id", quality_classifier.held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted"
    )


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op4_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack_documents(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three edits at places drawn from its id.

    A sentence goes in, eight characters go out, and a stretch is replaced by the text's
    own beginning. With a second count of the edited text from scratch, by the tests.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    place = lambda n: F.pmod(F.xxhash64(F.lit(n), "doc_id"), F.length("text") + 1)
    edits = F.array(
        F.struct(place(1).alias("start"), F.lit(0).alias("deleted"), F.lit(" An added sentence.").alias("inserted")),
        F.struct(place(2).alias("start"), F.lit(8).alias("deleted"), F.lit("").alias("inserted")),
        F.struct(place(3).alias("start"), F.lit(40).alias("deleted"), F.substring("text", 1, 25).alias("inserted")),
    )
    return token_counts.count_after_edits(docs.withColumn("edits", edits))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select(
        "doc.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken")
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc.doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.span_list(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_list(secret_scan.all_spans()).alias("spans"),
    )


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, topk_search.every_twentieth(vectors))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.judged(docs, quality_rules.fit(docs, read(spark, sf_dir, "labels")))


def op11_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = web_archive.write_archives(read(spark, sf_dir, "pages"))
    found = web_archive.read_records(web_archive.read_index(packages), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(read(spark, sf_dir, "conversations"))
    return conversation_repair.report(conversation_repair.repair(turns, F.col("dropped")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            op1_chat_format,
            op2_quality_classifier,
            op3_html_extract,
            op4_bin_packing,
            op5_token_counts,
            op6_simhash,
            op7_mixing,
            op8_secret_scan,
            op9_topk_search,
            op10_quality_rules,
            op11_web_archive,
            op12_source_divergence,
            op13_conversation_repair,
        )
    }


OP1_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
    SELECT *,
        CASE WHEN regexp_matches(role, '(?s)\\.') OR regexp_matches(text, '(?s)\\.') OR contains(role, '</s>') OR contains(text, '</s>')
              OR contains(role || ' ', ' [/INST]') THEN 1 ELSE 0 END AS level,
        len(regexp_extract_all(role, '\\|[<\[]/?(?:s>|INST\])')) + len(regexp_extract_all(text, '\\|[<\[]/?(?:s>|INST\])')) AS escapes
    FROM turns
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
    CAST(sum(length(role) + length(text) + 22 + level * escapes) AS BIGINT) AS formatted_chars,
    max(level) AS level,
    TRUE AS round_trip
FROM marked GROUP BY conv_id
"""

OP7_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash,
        coalesce('=' || source, '') AS source_key
    FROM documents
), cells AS (
    SELECT *,
        CASE WHEN size <= 64 THEN size ELSE 64 + floor(16 * log2(size / 64.0::DOUBLE)) END AS band,
        CAST('0x' || substr(hash, 1, 7) AS BIGINT) % 256 AS bucket
    FROM docs
), sources AS (
    SELECT source, source_key, sum(size) AS source_size FROM docs GROUP BY ALL
), weighed AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
        3.0::DOUBLE * source_size AS cap
    FROM sources
), filling AS (
    SELECT cap / weight AS fills_at, sum(cap) AS cap, sum(weight) AS weight FROM weighed GROUP BY ALL
), levels AS (
    SELECT fills_at,
        (CAST((SELECT sum(source_size) FROM weighed) AS DOUBLE)
            - coalesce(sum(cap) OVER (ORDER BY fills_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY fills_at ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM filling
), targets AS (
    SELECT source_key, CAST(source_size AS BIGINT) AS source_size,
        least(cap, (SELECT arg_min(level, fills_at) FROM levels WHERE level <= fills_at) * weight) AS target,
        CAST('0x' || substr(md5('7' || source_key), 1, 5) AS BIGINT) / 1048576.0::DOUBLE AS start
    FROM weighed
), ranked AS (
    SELECT doc_id, size, source_size, target, start,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        row_number() OVER (PARTITION BY source_key ORDER BY band, bucket, hash, doc_id) AS place
    FROM cells JOIN targets USING (source_key)
)
SELECT doc_id, size, source_size, target,
    CAST(least(floor(rate * place + start) - floor(rate * (place - 1) + start), 3) AS BIGINT) * size AS taken
FROM ranked
"""

OP11_SQL = r"""
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), answered AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload) AS response FROM payloads
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
    CASE WHEN coalesce(page_id, response - 1) != response THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN coalesce(page_id, response - 1) != response THEN response END AS refers_to,
    url
FROM answered
"""

OP12_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), used AS (
    SELECT id, lang, source, unnest(terms) AS term FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM used GROUP BY ALL
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM used GROUP BY ALL HAVING count(DISTINCT id) >= 30
), langs AS (
    SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counts JOIN kept USING (lang, term) GROUP BY ALL
), rates AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (l.total + 5 * l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
    LEFT JOIN rates x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN rates y ON y.lang = a.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM rates WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 50
"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against brute force."""
    return {"op1_chat_format": OP1_SQL, "op7_mixing": OP7_SQL, "op11_web_archive": OP11_SQL, "op12_source_divergence": OP12_SQL}
