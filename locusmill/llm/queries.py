"""The registered corpus queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, exact_dedup, html_extract, line_crf, mixing, piece_sampling, pii, quality_rules, simhash, token_counts, token_planes, toxicity
from .common import crc_bucket, table

#: The public tokenizers' files; the folder comes with the public_tokenizers package.
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_bucket("doc_id", 3) == 1
    found = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    predicted = (F.col("score") >= 0.7).cast("int")
    return found.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"), "evidence", F.size("passages").alias("n_passages"))


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_planes.token_folder(spark, uuid.uuid4().hex)
    token_planes.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path(WORD_BPE))
    return token_planes.read_tokens(spark, path)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]]
    sha = F.sha2(pii.joined(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *counts, sha.alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), bits=3, shingle=3)


def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_bucket("doc_id", 5) == 0
    found = line_crf.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    predicted = (F.col("score") >= 0.3).cast("int")
    return found.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"), "n_lines")


def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.sample_segmentations(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE), k=2, with_ids=True, block_chars=1_000_000)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.drop("text", "lang")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", F.col("taken").cast("long").alias("taken"), "copies")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


_ALL = (
    op1_toxicity, op2_token_planes, op3_pii, op4_simhash, op5_line_crf, op6_piece_sampling,
    op7_quality_rules, op8_mixing, op9_exact_dedup, op10_html_extract, op11_divergence, op12_token_counts,
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLE_SQL = {
    "op9_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t
    """,
    "op11_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        g AS (SELECT DISTINCT lang, source FROM d),
        t AS (SELECT doc, lang, source, unnest(terms) AS term FROM d),
        k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
        c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
        full_counts AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS p FROM full_counts WINDOW w AS (PARTITION BY lang, source)),
        lang_counts AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
        q AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS q FROM lang_counts WINDOW w AS (PARTITION BY lang)),
        sums AS (
            SELECT a.lang, a.source, b.source AS peer, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.peer = b.source
        ),
        terms AS (
            SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q) * (p.p - q.q) // q.q AS value
            FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
}
