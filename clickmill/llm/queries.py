"""The registered queries of this subpackage, each over its whole table, and the same results as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clickmill.llm import alignment, centroids, decontamination, language, near_dedup, packing, pii, quotations, repeats, secrets, token_files, toxicity, vector_search
from clickmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages. Pages have page_id, and -1 - page_id in doc_id, which no document has."""
    docs = table(spark, sf_dir, "documents")
    langs, model = language.train(docs)
    pages = language.page_rows(table(spark, sf_dir, "pages")).withColumn("key", -1 - F.col("key"))
    found = language.identify(language.document_rows(docs).unionByName(pages), langs, model)
    page_id = F.when(F.col("key") < 0, -1 - F.col("key")).alias("page_id")
    return found.select(F.col("key").alias("doc_id"), page_id, "declared", "lang", "posterior", "text_lang", "n_grams", "kept")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op6_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_products(table(spark, sf_dir, "embeddings"))


def op9_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.reply_ordered(table(spark, sf_dir, "conversations"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"), result=repeats.digests)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.alignment(table(spark, sf_dir, "documents"), *paths)


def op13_walsh_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_template_decontamination": op1_template_decontamination,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_language_fusion": op3_language_fusion,
    "op4_token_files": op4_token_files,
    "op5_markov_secrets": op5_markov_secrets,
    "op6_boosted_pii": op6_boosted_pii,
    "op7_ftrl_toxicity": op7_ftrl_toxicity,
    "op8_pivot_top_k": op8_pivot_top_k,
    "op9_quotation_links": op9_quotation_links,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_run_index": op11_run_index,
    "op12_token_alignment": op12_token_alignment,
    "op13_walsh_centroids": op13_walsh_centroids,
}


def _centroid_sql() -> str:
    """Three rounds of plain distances to all centroids."""
    square = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    text = """
        WITH kept AS (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x,
                   row_number() OVER (ORDER BY vec_id IS NULL, sha256(concat('1:', CAST(vec_id AS VARCHAR))), embedding) AS place
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), c0 AS (SELECT place - 1 AS k, x FROM kept WHERE vec_id IS NOT NULL AND place <= 16)"""
    for step in range(centroids.ROUNDS + 1):
        text += f""", p{step} AS (
            SELECT v.r, v.vec_id, v.x, c.k, CAST({square} AS BIGINT) AS d,
                   row_number() OVER (PARTITION BY v.r ORDER BY {square}, c.k) AS n
            FROM kept AS v, c{step} AS c
        ), a{step} AS (SELECT * FROM p{step} WHERE n = 1)"""
        if step < centroids.ROUNDS:
            text += f""", s{step} AS (SELECT k, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{step}),
        m{step} AS (
            SELECT k, i, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
            FROM s{step} GROUP BY k, i
        ), c{step + 1} AS (
            SELECT c.k, coalesce(l.x, c.x) AS x
            FROM c{step} AS c LEFT JOIN (SELECT k, list(v ORDER BY i) AS x FROM m{step} GROUP BY k) AS l ON l.k = c.k
        )"""
    return text + f"""
        SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance,
               CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{centroids.ROUNDS} AS a JOIN c{centroids.ROUNDS} AS c ON c.k = a.k
    """


ORACLES: dict[str, str] = {
    # The k best by plain arithmetic over all pairs of a query and a candidate.
    "op8_pivot_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    # Quotations by joins with all originals of the conversation, replies in depth-first order by a recursive walk.
    "op9_quotation_links": r"""
        WITH RECURSIVE m AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text)) AS spot
            FROM (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
        ), split AS (
            SELECT conv_id, spot, string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)) AS lines FROM m
        ), raw AS (
            SELECT conv_id, spot, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM split
        ), lines AS (
            SELECT conv_id, spot, i, regexp_replace(line, '^[ \t]*((?:>[ \t]?)+)', '') AS line,
                   length(regexp_replace(regexp_extract(line, '^[ \t]*((?:>[ \t]?)+)', 1), '[^>]', '', 'g')) AS level
            FROM raw
        ), marked AS (
            SELECT *, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g')) AS words,
                   level = 0 AND NOT (coalesce(lead(level) OVER w, 0) > 0
                     AND regexp_matches(line, '(?i)^[ \t]*(?:on\b.*\bwrote|.*\b(?:said|wrote)):[ \t]*$')) AS own,
                   coalesce(level <> lag(level) OVER w, true) AS opens
            FROM lines WINDOW w AS (PARTITION BY conv_id, spot ORDER BY i)
        ), numbered AS (
            SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY conv_id, spot ORDER BY i) AS passage FROM marked
        ), cut AS (
            SELECT conv_id, spot, passage, level, string_agg(words, ' ' ORDER BY i) AS whole,
                   max(struct_pack(n := length(words), line := words)).line AS longest
            FROM numbered WHERE words <> '' GROUP BY conv_id, spot, passage, level
        ), units AS (
            SELECT conv_id, spot, string_agg(words, ' ' ORDER BY i) AS key FROM numbered WHERE own AND words <> '' GROUP BY conv_id, spot
            UNION SELECT conv_id, spot, whole FROM cut WHERE level = 0
            UNION SELECT conv_id, spot, words FROM numbered WHERE level = 0 AND words <> ''
        ), quoted AS (
            SELECT c.conv_id, c.spot, c.passage, c.level,
                   coalesce(max(CASE WHEN u.key = c.whole THEN u.spot END), max(u.spot)) AS original
            FROM cut AS c LEFT JOIN units AS u ON u.conv_id = c.conv_id AND u.spot < c.spot AND u.key IN (c.whole, c.longest)
            WHERE c.level > 0 GROUP BY c.conv_id, c.spot, c.passage, c.level
        ), found AS (
            SELECT conv_id, spot, count(*) AS n_quoted, count(original) AS n_linked,
                   min(CASE WHEN original IS NOT NULL THEN struct_pack(l := level, p := passage, o := original) END).o AS original
            FROM quoted GROUP BY conv_id, spot
        ), texts AS (
            SELECT conv_id, spot, regexp_replace(coalesce(string_agg(CASE WHEN own THEN line END, chr(10) ORDER BY i), ''),
                                               '^[\s\x0B]+|[\s\x0B]+$', '', 'g') AS text
            FROM numbered GROUP BY conv_id, spot
        ), linked AS (
            SELECT m.conv_id, m.spot, m.turn, m.role, texts.text, coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked,
                   coalesce(original, CASE WHEN m.spot > 1 THEN m.spot - 1 END) AS parent
            FROM m JOIN texts USING (conv_id, spot) LEFT JOIN found USING (conv_id, spot)
        ), walk AS (
            SELECT conv_id, spot, [spot] AS path FROM linked WHERE parent IS NULL
            UNION ALL
            SELECT l.conv_id, l.spot, list_append(w.path, l.spot) FROM linked AS l JOIN walk AS w ON l.conv_id = w.conv_id AND l.parent = w.spot
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY path) AS position FROM walk JOIN linked USING (conv_id, spot)
        )
        SELECT p.conv_id, p.position, p.turn, p.role, p.text, o.position AS reply_to, o.turn AS reply_to_turn,
               p.n_quoted, p.n_linked, concat('<|', coalesce(p.role, ''), '|>', chr(10), p.text, chr(10)) AS formatted
        FROM placed AS p LEFT JOIN placed AS o ON o.conv_id = p.conv_id AND o.spot = p.parent
    """,
    "op13_walsh_centroids": _centroid_sql(),
}
