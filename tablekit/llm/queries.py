"""The registered queries of this subpackage, and the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import (
    audit, bpe, exact, langid, lines, merkle, ngram_join, packing, passages, pii, quality, toxicity, vectors,
)
from tablekit.llm.store import ship
from tablekit.suite.registry import read

def op1_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents linked by 3-word shingles at a Jaccard similarity of 0.9."""
    ship(spark)
    return ngram_join.join(read(spark, sf, "documents"), k=3, percent=90)


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """The language of every document."""
    ship(spark)
    return langid.identify(read(spark, sf, "documents"))


def op3_vector_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings linked at a cosine of 0.9."""
    ship(spark)
    return vectors.dedup(read(spark, sf, "embeddings"))


def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every document's byte-level BPE ids and of what they decode to."""
    ship(spark)
    return bpe.digests(read(spark, sf, "documents"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Expected severity of every document."""
    ship(spark)
    return toxicity.grade(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of documents with equal texts."""
    ship(spark)
    return exact.dedup(read(spark, sf, "documents"))


def op7_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of 50 words or more that documents share."""
    ship(spark)
    return passages.find(read(spark, sf, "documents"))


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without lines that three documents or more hold, but for one."""
    ship(spark)
    return lines.digests(read(spark, sf, "documents"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document."""
    ship(spark)
    scored = quality.classify(read(spark, sf, "documents"), read(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(read(spark, sf, "documents")).withColumn("sequence_id", F.col("sequence_id").cast("long"))


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What five filters do in each of their 120 orders."""
    return audit.audit(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op12_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digests(read(spark, sf, "documents"))


def op13_merkle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's proof in the manifest; documents whose id's crc32 is divisible by 7 come back altered."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return merkle.audit(read(spark, sf, "documents"), altered={"n_chars": F.col("n_chars") + 1}, where=code % 7 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_language_id, op3_vector_dedup, op4_byte_bpe, op5_toxicity, op6_exact_dedup, op7_passages,
        op8_line_dedup, op9_quality, op10_packing, op11_filter_audit, op12_pii, op13_merkle,
    )
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_line_dedup": """
        WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        each AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut),
        keyed AS (
          SELECT doc_id, line, place, translate(
            trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each),
        often AS (
          SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
          SELECT doc_id, line, place, keep IS NOT NULL AND doc_id <> keep AS gone
          FROM keyed LEFT JOIN often ON keyed.key = often.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op11_filter_audit": r"""
        WITH copies AS (SELECT doc_id, lang, coalesce(text, '') AS text,
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS copy FROM documents),
        split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM copies),
        rows AS (
          SELECT doc_id, coalesce(lang, '') AS part, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
              100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
              regexp_matches(text, '[#$%&*|]'), copy] AS fails,
            EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = split.doc_id AND quality = 1) AS good,
            EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = split.doc_id AND toxic = 1) AS toxic FROM split),
        counts AS (
          SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
          FROM rows GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        orders AS (
          SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM letters a JOIN letters b ON b.c <> a.c
            JOIN letters d ON d.c NOT IN (a.c, b.c) JOIN letters e ON e.c NOT IN (a.c, b.c, d.c)
            JOIN letters f ON f.c NOT IN (a.c, b.c, d.c, e.c)),
        steps AS (
          SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS c, strpos('ABCDE', filter_order[step]) AS own,
            list_transform(list_filter(string_split(filter_order[:step - 1], ''), lambda x: x <> ''), lambda x: strpos('ABCDE', x)) AS earlier
          FROM orders CROSS JOIN (SELECT unnest(range(1, 6)) AS step)),
        each AS (
          SELECT part, filter_order, step, c, own, fails, n, good, toxic, fails[own] AS own_fails,
            len(list_filter(earlier, lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS n_fails
          FROM counts CROSS JOIN steps),
        summed AS (
          SELECT part, filter_order, step, c, CAST(coalesce(sum(n) FILTER (WHERE NOT own_fails AND NOT gone), 0) AS BIGINT) AS kept,
            CAST(coalesce(sum(n) FILTER (WHERE own_fails AND NOT gone), 0) AS BIGINT) AS removed,
            CAST(coalesce(sum(n) FILTER (WHERE own_fails AND gone), 0) AS BIGINT) AS redundant,
            CAST(coalesce(sum(n) FILTER (WHERE own_fails AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
            CAST(coalesce(sum(good) FILTER (WHERE own_fails AND NOT gone), 0) AS BIGINT) AS good_lost,
            CAST(coalesce(sum(toxic) FILTER (WHERE own_fails AND NOT gone), 0) AS BIGINT) AS toxic_lost FROM each GROUP BY ALL)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
          CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley FROM summed
    """,
    "op13_merkle": """
        WITH RECURSIVE given AS (
          SELECT doc_id, lang, n_chars, text, source, list_reduce(
            list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
              lambda c: [ord(c)::BIGINT] || list_transform(range(8), lambda i: (-1)::BIGINT)))),
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS code
          FROM documents),
        fields AS (
          SELECT doc_id, lang, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
              || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
            coalesce(strlen(text) || ':' || text, '-') AS tail, n_chars,
            n_chars + CASE WHEN xor(code, 4294967295) % 7 = 0 THEN 1 ELSE 0 END AS changed FROM given),
        leaves AS (
          SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
            sha256(head || coalesce(strlen(CAST(changed AS VARCHAR)) || ':' || changed, '-') || tail) AS other FROM fields),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
        nodes AS (
          SELECT lang, 0 AS level, idx, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM placed
          UNION ALL
          SELECT lang, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
          FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2),
        tops AS (
          SELECT 0 AS level, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, digest, count(*) OVER () AS n FROM nodes WHERE n = 1
          UNION ALL
          SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
          FROM tops WHERE n > 1 GROUP BY level, idx // 2),
        every AS (
          SELECT coalesce('=' || lang, '') AS part, false AS upper, level, idx, digest, n FROM nodes
          UNION ALL SELECT '', true, level, idx, digest, n FROM tops),
        parts AS (
          SELECT part, digest AS subroot, row_number() OVER (ORDER BY part) - 1 AS place, count(*) OVER () AS n
          FROM every WHERE NOT upper AND n = 1),
        climb AS (
          SELECT doc_id, leaf, other, coalesce('=' || lang, '') AS part, false AS upper, 0 AS level, idx AS at, '' AS proof,
            other AS folded, count(*) OVER (PARTITION BY lang) AS n FROM placed
          UNION ALL
          SELECT c.doc_id, c.leaf, c.other, c.part, c.upper OR c.n = 1, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
            CASE WHEN c.n = 1 THEN p.place ELSE c.at // 2 END, CASE WHEN c.n = 1 THEN proof ELSE proof || coalesce(s.digest, '') END,
            CASE WHEN c.n = 1 THEN folded WHEN c.at % 2 = 1 THEN sha256(s.digest || folded) ELSE sha256(folded || coalesce(s.digest, '')) END,
            CASE WHEN c.n = 1 THEN p.n ELSE (c.n + 1) // 2 END
          FROM climb c JOIN parts p ON p.part = c.part
            LEFT JOIN every s ON s.upper = c.upper AND s.level = c.level AND s.idx = xor(c.at, 1) AND (c.upper OR s.part = c.part)
          WHERE c.n > 1 OR NOT c.upper)
        SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
        FROM climb c JOIN parts p ON p.part = c.part CROSS JOIN (SELECT digest FROM tops WHERE n = 1) r
        WHERE c.upper AND c.n = 1
    """,
}
