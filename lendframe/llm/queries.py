"""The registered queries of the operators of this subpackage, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.llm import (
    bpe,
    conversation_trie,
    decontaminate,
    html_template,
    minhash,
    quality,
    rule_forest,
    secret_scan,
    suffix_dedup,
    topk,
    url_rules,
    vector_codes,
    warc,
)
from lendframe.llm.common import held_out, read_table, vocabulary_path

ENCODER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# The host rules of op8, as (verdict, host, start of the path).
HOST_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that several documents share."""
    return suffix_dedup.passages(read_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, vocabulary_path(ENCODER), ids=False)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out documents are not learned from."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_template.extract(read_table(spark, sf_dir, "pages"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secret_scan.scan(read_table(spark, sf_dir, "documents"), vocabulary_path(RANKS))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the best place of each."""
    return decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; a page is labelled by the label row whose doc_id is its page_id."""
    pages, labels = read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels")
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    labelled = pages.join(marks, pages.page_id == marks.doc_id).select("url", "bad")
    return url_rules.judge(pages, HOST_RULES, url_rules.mine(labelled))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: 3-word shingles, similarity 0.85 or more."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, percent=85)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive every page as ARC, convert to WARC, and list what the WARC files hold."""
    found = warc.archive(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict on every document; labels of held-out documents do not calibrate the threshold."""
    labels = read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return rule_forest.judge(read_table(spark, sf_dir, "documents"), labels)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and errors of every usable vector."""
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations, with the totals of its subtree."""
    return conversation_trie.trie(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_bpe, op3_quality, op4_html_template, op5_secret_scan, op6_decontamination,
        op7_topk, op8_url_rules, op9_minhash, op10_warc, op11_rule_forest, op12_vector_codes,
        op13_conversation_trie,
    )
}

def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    """Product codes: one assignment and one replacement step per round, as common table expressions."""
    steps = [
        """k AS (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "w AS (SELECT (max(len(embedding)) + %d) // %d AS w FROM k)" % (parts - 1, parts),
        f"""x AS MATERIALIZED (SELECT r, (i - 1) // w AS p, (i - 1) % w AS j,
            CAST(floor(4096 * coalesce(CAST(embedding[i] AS DOUBLE), 0)) AS BIGINT) AS x
            FROM (SELECT *, unnest(range(1, {parts} * w + 1)) AS i FROM k, w))""",
        f"""s AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {entries})""",
        "b0 AS MATERIALIZED (SELECT p, e, j, x AS c FROM x JOIN s USING (r))",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (SELECT r, p, min(d) AS d, arg_min(e, (d, e)) AS e FROM (
                SELECT r, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM x JOIN b{n} USING (p, j) GROUP BY r, p, e)
                GROUP BY r, p)"""
        )
        if n < rounds:
            steps.append(
                f"""b{n + 1} AS MATERIALIZED (SELECT p, e, j, coalesce(m, c) AS c FROM b{n} LEFT JOIN (
                    SELECT p, e, j, (s - ((s % n) + n) % n) // n AS m FROM (
                        SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{n} USING (r, p) GROUP BY p, e, j))
                    USING (p, e, j))"""
            )
    return (
        "WITH " + ", ".join(steps) + f""", t AS (
            SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{rounds}) AS codebooks_sha256
        FROM t JOIN k USING (r)"""
    )


ORACLES: dict[str, str] = {
    "op12_vector_codes": _codes_sql(8, 16, 6),
    # crc32 by its bitwise definition: eight shifts per byte of the decimal id.
    "op13_conversation_trie": """
        WITH t AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                md5(concat(CAST(length(coalesce(role, '')) AS VARCHAR), ':', coalesce(role, ''), ':', coalesce(text, '')))) AS n,
                {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT conv_id, list(turn ORDER BY n) AS own,
                xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                    lambda x: ord(x)::BIGINT)),
                    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                        lambda u, v: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384::BIGINT) ELSE u >> 1 END)),
                    4294967295::BIGINT) % 4 AS h
            FROM t GROUP BY conv_id
        ), r AS (
            SELECT c.conv_id, list_concat(coalesce(s.own, [])[1:c.h], c.own[c.h + 1:]) AS turns
            FROM c LEFT JOIN c s ON s.conv_id = c.conv_id - c.conv_id % 20
        ), p AS (
            SELECT conv_id, len(turns) AS length, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r
        ), n AS (
            SELECT depth, turns[1:depth] AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), ''))
                    AS ends_sha256
            FROM p GROUP BY ALL
        ), m AS (
            SELECT n.*, q.conv_id AS parent_conv_id FROM n LEFT JOIN n q ON n.depth > 0 AND q.depth = n.depth - 1
                AND q.k = n.k[1:n.depth - 1]
        ), x AS (
            SELECT depth - 1 AS depth, k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL
        ), y AS (
            SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN x USING (depth, k)
        ), z AS (
            SELECT a AS depth, k[1:a] AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(CASE WHEN depth = 0 THEN 0
                ELSE (n_convs - 1) * len(regexp_extract_all(k[depth].text, '[^\\x20\\x09-\\x0D]+')) END) AS BIGINT) AS saved_tokens
            FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM y) GROUP BY ALL
        )
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM y JOIN z USING (depth, k)
    """,
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), r AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END
                AS first FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
        FROM r
    """,
}
