"""One query per operator, over its whole table and with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, exact, lines, lm, mixing, runindex, simhash, subword, toxicity, warc
from .common import Workspace, bucket_of, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "op1")
    root = f"{ws.path}/warc"
    archives = warc.write_archives(table(spark, sf_dir, "pages"), ws, root)
    return warc.records_of(warc.read_archives(archives, root))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), Workspace(spark, "op2")).drop("source")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.encode(table(spark, sf_dir, "documents"), keep_ids=False)


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"), bucket_of("doc_id", 5) != 1, Workspace(spark, "op4"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), bucket_of("doc_id", 5) != 0)
    scored = toxicity.toxicity(docs, lexicon)
    return scored.select("doc_id", (bucket_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.line_dedup(table(spark, sf_dir, "documents"), Workspace(spark, "op6"))
    return cut.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"), Workspace(spark, "op7"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), Workspace(spark, "op8"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.repeat_dedup(table(spark, sf_dir, "documents"), Workspace(spark, "op9"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_dedup(table(spark, sf_dir, "embeddings"), Workspace(spark, "op10"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_warc, op2_mixing, op3_sentencepiece, op4_lm_scores, op5_toxicity, op6_line_dedup, op7_exact_dedup, op8_simhash, op9_suffix_dedup, op10_embedding_dedup, pipeline)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB. The others have none: it lacks their hashes, seeds, learned models or vocabularies, or would take too long on whole tables."""
    return {
        "op1_warc": """
            WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
            h AS (SELECT page_id, octet_length(encode(t)) AS n, sha1(t) AS x, max(page_id) OVER (PARTITION BY t) AS keep FROM p)
            SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
                array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
                CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
                CASE WHEN page_id <> keep THEN keep END AS refers_to
            FROM h""",
        "op6_line_dedup": """
            WITH d AS (SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents),
            n AS (SELECT doc_id, ls, list_transform(ls, lambda x: len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))) AS ws FROM d),
            p AS (SELECT doc_id, ls, ws, unnest(range(1, len(ls) + 1)) AS i FROM n),
            w AS (SELECT doc_id, i, z, ls[i : i + z - 1] AS run FROM p, (VALUES (1), (2), (3)) AS t(z)
                WHERE i + z - 1 <= len(ls) AND (z = 3 OR list_sum(ws[i : i + z - 1]) >= 50)),
            f AS (SELECT doc_id, i, z, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS rn FROM w),
            g AS (SELECT doc_id, list(DISTINCT i + k) AS gs FROM (SELECT doc_id, i, unnest(range(z)) AS k FROM f WHERE rn > 1) GROUP BY doc_id),
            m AS (SELECT d.doc_id, ls, list_transform(range(1, len(ls) + 1), lambda i: gs IS NOT NULL AND list_contains(gs, i)) AS gone
                FROM d LEFT JOIN g ON d.doc_id = g.doc_id)
            SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(list_filter(gone, lambda x: x)) AS BIGINT) AS n_removed,
                CAST(len(list_filter(range(1, len(ls) + 1), lambda i: gone[i] AND (i = 1 OR NOT gone[i - 1]))) AS BIGINT) AS n_runs,
                sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT gone[i]), lambda i: ls[i]), chr(10)), '')) AS text_sha256
            FROM m""",
        "op7_exact_dedup": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
            SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
                doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
        "op10_embedding_dedup": """
            WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
            l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
            r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
            c AS (SELECT a, least(a, min(b)) AS m FROM r GROUP BY a),
            n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
            SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(m, vec_id) AS component_id, vec_id = coalesce(m, vec_id) AS kept
            FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id""",
    }
