"""The registered query of each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import held_out, materialise, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokencount import apply_edits, build_trees, scripted_edits

    trees = materialise(build_trees(table(spark, sf_dir, "documents")), "token-trees")
    return apply_edits(scripted_edits(trees), keep=False).select("doc_id", "n_tokens_before", "n_tokens", "n_pieces", "n_recounted")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive

    return archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_texts

    encoded = encode_texts(table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_pfair_mixing": op7_pfair_mixing,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_bpe_automaton": op10_bpe_automaton,
}

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, h, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS first_id FROM p)
        SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST(1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (k // 4) AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31) AS BIGINT), 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM d""",
    "op8_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, {_NORM} AS norm FROM documents)
        WINDOW w AS (PARTITION BY norm)""",
}
