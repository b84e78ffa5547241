"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tianguis.llm import (
    bpe,
    chat,
    filter_audit,
    fingerprint,
    language,
    licenses,
    mixing,
    packing,
    repair,
    simhash,
    suffix_array,
    topk,
    url_filter,
)
from tianguis.llm.common import small_batches, table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_neighbours(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (~language.learns()).alias("held_out"))
    return language.identify(docs, ["doc_id", "held_out"])


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_array.deduplicate(table(spark, sf_dir, "documents"), ["doc_id"], texts=False)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), added_tokens=True).drop("ids")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


#: A conversation whose texts hold a header and an end of a turn.
HOSTILE = [(-7, n, role, "\\### Assistant: </turn> ok") for n, role in enumerate(("user", "assistant"))]


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(HOSTILE, "conv_id bigint, turn bigint, role string, text string")
    return chat.digest_conversations(rows.unionByName(more), spans=False)


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        "source",
        F.col("__epoch").alias("epoch"),
        F.col("__block").alias("block"),
        F.col("__slot").alias("slot"),
        F.col("__source_weight").alias("source_weight"),
        F.col("__epochs").alias("epochs"),
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest_repairs(repair.damaged(table(spark, sf_dir, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_simhash": op2_simhash,
    "op3_fingerprint": op3_fingerprint,
    "op4_language": op4_language,
    "op5_suffix_array": op5_suffix_array,
    "op6_packing": op6_packing,
    "op7_licenses": op7_licenses,
    "op8_chat": op8_chat,
    "op9_top_k": op9_top_k,
    "op10_mixing": op10_mixing,
    "op11_bpe": op11_bpe,
    "op12_filter_audit": op12_filter_audit,
    "op13_repair": op13_repair,
    "pipeline": pipeline,
}

CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
    SELECT *, replace(replace(replace(role, '\', '\\'), ':', '\c'), chr(10), '\n') AS name,
        CASE WHEN contains(text, '###') OR contains(text, '</turn>')
            THEN ':\' || chr(10) || replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')
            ELSE ':' || chr(10) || text END AS body
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
    CAST(sum(length('### ' || name || body || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""

TOP_K_SQL = """
WITH numbered AS MATERIALIZED (
    SELECT vec_id, embedding, row_number() OVER () AS nr FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), parts AS MATERIALIZED (
    SELECT nr, vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM numbered
), usable AS (
    SELECT nr, vec_id FROM numbered WHERE nr NOT IN (SELECT nr FROM parts WHERE x IS NULL OR NOT isfinite(x))
), weights AS (
    SELECT nr, vec_id, i, CAST(floor(1024 * x) AS BIGINT) AS w FROM parts WHERE nr IN (SELECT nr FROM usable)
), products AS (
    SELECT q.nr AS query_nr, c.nr AS other_nr, sum(q.w * c.w) AS score FROM weights q JOIN weights c ON q.i = c.i
    WHERE q.vec_id % 100 = 0 GROUP BY q.nr, c.nr
), ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(p.score, 0) AS BIGINT) AS score,
        row_number() OVER (PARTITION BY q.nr ORDER BY coalesce(p.score, 0) DESC, c.vec_id) AS place
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.nr <> c.nr
    LEFT JOIN products p ON p.query_nr = q.nr AND p.other_nr = c.nr
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""

AUDIT_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), judged AS (
    SELECT doc_id, part,
        CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
    FROM docs
), cells AS (
    SELECT part, fails, count(*) AS n,
        count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)) AS good,
        count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)) AS toxic
    FROM judged GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), steps AS (
    SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders
), named AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier FROM steps
), tried AS (
    SELECT part, filter_order, step, letter, n, good, toxic, contains(fails, letter) AS failing,
        translate(fails, earlier, '') = fails AS arrives, fails = letter AS only_this
    FROM cells, named
), counted AS (
    SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (arrives AND NOT failing), 0) AS kept,
        coalesce(sum(n) FILTER (arrives AND failing), 0) AS removed,
        coalesce(sum(n) FILTER (failing AND NOT arrives), 0) AS redundant,
        coalesce(sum(n) FILTER (only_this), 0) AS unique_fails,
        coalesce(sum(good) FILTER (arrives AND failing), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (arrives AND failing), 0) AS toxic_lost
    FROM tried GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

#: Prefixes of the rows go forward one row at a time; of each state the least (cost, audit) stays.
REPAIR_SQL = r"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations
), checked AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(place, '')]),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
            lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END))) % 20 AS which
    FROM given
), turned AS (
    SELECT conv_id, turn, CASE WHEN which = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN which = 1 THEN '' WHEN which = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, 1 AS copy
    FROM checked WHERE which <> 0
    UNION ALL SELECT conv_id, turn, role, text, 2 FROM checked WHERE which = 3
), digested AS (
    SELECT *, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS digest FROM turned
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, digest, copy) > 1 AS repeated
    FROM digested
), faulty AS (
    SELECT *, substr(role, 1, 1) AS initial,
        CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN repeated THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), pairs AS (
    SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM faulty
), facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM pairs GROUP BY conv_id
), moves(initial, was, becomes) AS (
    VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('a', 2, 3), ('u', 3, 2)
), inserts(letters, was, becomes) AS (
    VALUES ('', 0, 0), ('', 1, 1), ('', 2, 2), ('', 3, 3), ('I', 0, 2), ('I', 1, 2), ('I', 2, 3), ('I', 3, 2),
        ('II', 0, 3), ('II', 1, 3), ('II', 2, 2), ('II', 3, 3)
), names(initial, name) AS (
    VALUES ('u', 'user'), ('a', 'assistant')
), shown AS (
    SELECT conv_id, i, 'D' AS letter, 4 AS price, states.s AS was, states.s AS becomes, NULL AS line
    FROM faulty, (SELECT unnest([0, 1, 2, 3]) AS s) states
    UNION ALL
    SELECT conv_id, i, 'K', CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, was, becomes, role || ':' || text
    FROM faulty JOIN moves USING (initial) WHERE fault NOT IN ('blank', 'duplicate')
    UNION ALL
    SELECT conv_id, i, 'R', CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, was, becomes, name || ':' || text
    FROM faulty, moves JOIN names USING (initial) WHERE fault NOT IN ('blank', 'duplicate')
), best(conv_id, i, state, cost, audit, lines) AS (
    SELECT conv_id, CAST(0 AS BIGINT), inserts.becomes, CAST(3 * length(letters) AS BIGINT), letters,
        CASE length(letters) WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['user:'] ELSE ['user:', 'assistant:'] END
    FROM (SELECT DISTINCT conv_id FROM faulty), inserts WHERE inserts.was = 0
    UNION ALL
    SELECT conv_id, i, state, way.cost, way.audit, way.lines FROM (
        SELECT b.conv_id, b.i + 1 AS i, t.becomes AS state, min({
            cost: b.cost + s.price + 3 * length(t.letters), audit: b.audit || s.letter || t.letters,
            lines: b.lines || CASE WHEN s.line IS NULL THEN CAST([] AS VARCHAR[]) ELSE [s.line] END || CASE length(t.letters)
                WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [CASE t.becomes WHEN 3 THEN 'assistant:' ELSE 'user:' END]
                ELSE CASE t.becomes WHEN 3 THEN ['user:', 'assistant:'] ELSE ['assistant:', 'user:'] END END}) AS way
        FROM best b JOIN shown s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i + 1 AND s.was = b.state
            JOIN inserts t ON t.was = s.becomes
        GROUP BY b.conv_id, b.i + 1, t.becomes)
), repaired AS (
    SELECT b.conv_id, min({cost: b.cost, audit: b.audit, lines: b.lines}) AS way
    FROM best b JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.i WHERE b.state IN (0, 3) GROUP BY b.conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost, coalesce(way.audit, '') AS audit,
    sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL: dict[str, str] = {
    "op8_chat": CHAT_SQL,
    "op9_top_k": TOP_K_SQL,
    "op12_filter_audit": AUDIT_SQL,
    "op13_repair": REPAIR_SQL,
}
