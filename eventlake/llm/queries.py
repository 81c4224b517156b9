"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    bpe,
    filter_audit,
    jaccard_join,
    packing,
    pii,
    prefix_trie,
    secret_scan,
    sharding,
    spotsigs,
    suffix_dedup,
    topk,
    toxicity,
    warc,
)
from eventlake.llm.work import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.measure(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.shard(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), words=4, percent=85)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.tokenize(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep_ids=False,
    )


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.archive(table(spark, sf_dir, "pages")).select(columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_pii,
        op3_sharding,
        op4_toxicity,
        op5_jaccard_join,
        op6_fingerprints,
        op7_secrets,
        op8_packing,
        op9_bpe,
        op10_top_k,
        op11_filter_audit,
        op12_prefix_trie,
        op13_warc,
    )
}

ORACLES: dict[str, str] = {
    "op10_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
            WHERE a.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
        FROM scored
        WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY rank <= 10
    """,
    "op11_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        first AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
        marks AS (
            SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS bad
            FROM labels GROUP BY doc_id
        ),
        flags AS (
            SELECT part,
                   [len(w) < 200,
                    100 * len(list_distinct(w)) < 50 * len(w),
                    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                    regexp_matches(t, '[#$%&*|]'),
                    coalesce(doc_id > first_id, false)] AS fails,
                   coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
            FROM d JOIN first USING (t) LEFT JOIN marks USING (doc_id)
        ),
        cells AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad
            FROM flags GROUP BY part, fails
        ),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
        orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ),
        steps AS (
            SELECT filter_order, CAST(step AS INTEGER) AS step,
                   list_transform(range(1, 6), lambda i: ascii(substr(filter_order, i, 1)) - 64) AS seq
            FROM orders, range(1, 6) r(step)
        ),
        counted AS (
            SELECT part, filter_order, step, seq[step] AS f,
                   sum(CASE WHEN before OR fails[seq[step]] THEN 0 ELSE n END) AS kept,
                   sum(CASE WHEN fails[seq[step]] AND NOT before THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN fails[seq[step]] AND before THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN fails[seq[step]] AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN fails[seq[step]] AND NOT before THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN fails[seq[step]] AND NOT before THEN bad ELSE 0 END) AS toxic_lost
            FROM (
                SELECT *, len(list_filter(seq[1:step - 1], lambda i: fails[i])) > 0 AS before,
                       len(list_filter(fails, lambda x: x)) AS failed
                FROM cells, steps
            )
            GROUP BY ALL
        )
        SELECT part, filter_order, step,
               CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
        FROM counted
    """,
    "op12_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                                 ORDER BY turn NULLS FIRST, role, text) AS own
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        -- CRC-32 of the decimal id: each byte and seven zeros, one bit a step.
        heads AS (
            SELECT conv_id, own, CAST(xor(crc, 4294967295) % 4 AS BIGINT) AS h
            FROM (
                SELECT *, list_reduce(
                    list_concat([4294967295::UBIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                        lambda c: list_concat([ascii(c)::UBIGINT], list_transform(range(7), lambda i: 0::UBIGINT))))),
                    lambda crc, x: CASE WHEN xor(crc, x) % 2 = 1 THEN xor(xor(crc, x) >> 1, 3988292384::UBIGINT)
                                        ELSE xor(crc, x) >> 1 END) AS crc
                FROM turns
            )
        ),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS path
            FROM heads c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20
        ),
        members AS (
            SELECT conv_id, len(path) AS length, CAST(d AS BIGINT) AS depth, path[1:d] AS prefix
            FROM rebuilt, unnest(range(0, len(path) + 1)) r(d)
        ),
        nodes AS (
            SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                   FILTER (WHERE length = depth), '')) AS ends_sha256
            FROM members GROUP BY depth, prefix
        ),
        counted AS (
            SELECT n.*, p.conv_id AS parent_conv_id,
                   (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:c.depth - 1] = n.prefix) AS n_children,
                   CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1)
                       * len(regexp_extract_all(n.prefix[-1].text, '[^\x20\x09-\x0D]+')) END AS saved
            FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
        ),
        subtrees AS (
            SELECT depth, prefix, sum(CAST(n_children = 0 AS INTEGER)) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT r.d AS depth, prefix[1:r.d] AS prefix, n_children, saved
                  FROM counted, unnest(range(0, depth + 1)) r(d))
            GROUP BY ALL
        )
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
        FROM counted JOIN subtrees USING (depth, prefix)
    """,
    "op13_warc": """
        WITH p AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
        FROM f
    """,
}
