"""The jobs as registered queries: each runs its job twice into one new folder of the shared folder and returns the whole output."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from jobs import release_check, result_feed
from locusmill.sources.shared import shared_folder


def new_folder(spark: SparkSession) -> str:
    """A folder for one run; it is left there."""
    return f"{shared_folder(spark)}/jobs/{uuid.uuid4().hex}"


def job1_result_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stand for results: users for traits, event types for chromosomes."""
    folder = new_folder(spark)
    settings = {"trait": "user_id", "variant": "event_id", "score": "value", "chromosome": "event_type"}
    for _ in range(2):
        result_feed.run(spark, f"{sf_dir}/events.parquet", f"{folder}/output", f"{folder}/checkpoint", settings)
    return result_feed.read_output(spark, f"{folder}/output")


def job2_release_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and conversations against customers as participants."""
    folder = new_folder(spark)
    settings = {
        "tables": {
            "documents": {"id": ["doc_id"], "text": "text", "cell": ["lang", "source"]},
            "conversations": {"id": ["conv_id", "turn"], "text": "text", "cell": ["role"]},
        },
        "participants": {"id": "c_custkey"},
    }
    for _ in range(2):
        release_check.run(spark, sf_dir, f"{sf_dir}/customer.parquet", folder, settings)
    return release_check.read_output(spark, folder)


QUERIES = {f.__name__: f for f in (job1_result_feed, job2_release_check)}

SQL = {
    "job1_result_feed": """
        WITH r AS (SELECT user_id::VARCHAR AS trait, event_id::VARCHAR AS variant, value AS score, event_type AS chromosome FROM events),
        checked AS (
            SELECT *, CASE WHEN coalesce(trait, '') = '' THEN 'no trait' WHEN coalesce(variant, '') = '' THEN 'no variant'
                           WHEN coalesce(chromosome, '') = '' THEN 'no chromosome' WHEN score IS NULL OR isnan(score) THEN 'no score' END AS reason
            FROM r
        ),
        good AS (SELECT DISTINCT trait, variant, score, chromosome FROM checked WHERE reason IS NULL),
        best AS (
            SELECT *, count(*) OVER (PARTITION BY chromosome, trait) AS n,
                   row_number() OVER (PARTITION BY chromosome, trait ORDER BY score DESC, variant) AS place
            FROM good
        )
        SELECT 'row' AS part, chromosome, trait, variant, score, 1::BIGINT AS n, NULL::VARCHAR AS reason FROM good
        UNION ALL SELECT 'trait', chromosome, trait, variant, score, n, NULL FROM best WHERE place = 1
        UNION ALL SELECT 'rejected', chromosome, trait, variant, score, 1, reason FROM checked WHERE reason IS NOT NULL
    """,
    "job2_release_check": """
        WITH people AS (SELECT DISTINCT c_custkey::VARCHAR AS number FROM customer),
        texts AS (
            SELECT 'documents' AS "table", coalesce(doc_id::VARCHAR, 'none') AS id, coalesce(lang, 'none') AS cell_1, coalesce(source, 'none') AS cell_2, coalesce(text, '') AS text FROM documents
            UNION ALL
            SELECT 'conversations', coalesce(conv_id::VARCHAR, 'none') || ':' || coalesce(turn::VARCHAR, 'none'), coalesce(role, 'none'), 'all', coalesce(text, '') FROM conversations
        ),
        cut AS (SELECT row_number() OVER () AS k, *, regexp_extract_all(text, '[0-9]+') AS numbers, string_split_regex(text, '[0-9]+') AS gaps FROM texts),
        places AS (SELECT k, gaps, numbers, unnest(range(1, len(numbers) + 1)) AS i FROM cut),
        hits AS (
            SELECT k, i, numbers[i] AS number, gaps[i + 1] AS after, people.number IS NOT NULL AS is_id
            FROM places LEFT JOIN people ON people.number = numbers[i]
        ),
        found AS (
            SELECT k, string_agg(CASE WHEN is_id THEN '[participant]' ELSE number END || after, '' ORDER BY i) AS rest,
                   count(*) FILTER (WHERE is_id) AS n_ids, count(DISTINCT number) FILTER (WHERE is_id) AS n_people
            FROM hits GROUP BY k
        ),
        masked AS (
            SELECT "table", cell_1, cell_2, id, gaps[1] || coalesce(rest, '') AS text, coalesce(n_ids, 0) AS n_ids, coalesce(n_people, 0) AS n_people
            FROM cut LEFT JOIN found USING (k)
        ),
        counts AS (SELECT "table", cell_1, cell_2, count(*) AS n_texts, count(*) FILTER (WHERE n_ids > 0) AS with_ids FROM masked GROUP BY ALL),
        persons AS (SELECT "table", cell_1, cell_2, count(DISTINCT number) AS people FROM hits JOIN cut USING (k) WHERE is_id GROUP BY ALL),
        cells AS (SELECT counts.*, coalesce(people, 0) AS people FROM counts LEFT JOIN persons USING ("table", cell_1, cell_2))
        SELECT 'text' AS part, "table", cell_1, cell_2, id, text, n_ids, n_people, NULL::BIGINT AS n_texts, NULL::BIGINT AS n_texts_with_ids, NULL::BOOLEAN AS suppressed FROM masked
        UNION ALL
        SELECT 'cell', "table", cell_1, cell_2, NULL, NULL, NULL, CASE WHEN people NOT BETWEEN 1 AND 19 THEN people END, n_texts,
               CASE WHEN with_ids NOT BETWEEN 1 AND 19 THEN with_ids END, with_ids BETWEEN 1 AND 19 OR people BETWEEN 1 AND 19
        FROM cells
    """,
}
