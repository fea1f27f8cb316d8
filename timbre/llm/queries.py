"""The registered training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timbre.llm.common import read_table
from timbre.llm.hard_negatives import hard_negatives
from timbre.llm.histogram_shard import shard_report
from timbre.llm.html_text import main_text
from timbre.llm.line_dedup import line_report
from timbre.llm.media_tiff import media_features
from timbre.llm.order_minhash import near_classes
from timbre.llm.periodic_runs import run_report
from timbre.llm.personal_data import personal_report, report_sql
from timbre.llm.quality_rules import quality_report
from timbre.llm.retrieval_pack import packed_pieces
from timbre.llm.secret_scan import secret_spans
from timbre.llm.source_mix import mix_report
from timbre.llm.warc_archive import archive_round_trip


def op1_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages")).drop("url")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read_table(spark, sf_dir, "pages"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(read_table(spark, sf_dir, "documents"))


def op6_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(read_table(spark, sf_dir, "documents"))


def op7_retrieval_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_histogram_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_report(read_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_warc_chain": op1_warc_chain,
    "op2_source_mix": op2_source_mix,
    "op3_order_minhash": op3_order_minhash,
    "op4_html_text": op4_html_text,
    "op5_secret_scan": op5_secret_scan,
    "op6_tiff_pages": op6_tiff_pages,
    "op7_retrieval_pack": op7_retrieval_pack,
    "op8_quality_rules": op8_quality_rules,
    "op9_histogram_shard": op9_histogram_shard,
    "op10_line_dedup": op10_line_dedup,
    "op11_personal_data": op11_personal_data,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}

#: Of the other operators SQL lacks the method (hashes, alignment, tokens, formats, schedules).
ORACLE_SQL: dict[str, str] = {
    "op1_warc_chain": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), q AS (SELECT page_id, strlen(h) AS n, sha256(h) AS d FROM p),
        f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first_id FROM q), r AS (SELECT *, coalesce(first_id < page_id, false) AS again FROM f)
        SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to FROM r""",
    "op10_line_dedup": """WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
        k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key),
        m AS (SELECT k.*, coalesce(f.first_id < k.doc_id, false) AS gone FROM k LEFT JOIN f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id""",
    "op11_personal_data": report_sql(),
    "op13_hard_negatives": """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.l AS own, b.vec_id AS id, b.l AS l, list_dot_product(a.v, b.v)::BIGINT AS score FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, own, id AS positive_id, score AS ps FROM s WHERE l = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank, id AS negative_id, ps AS positive_score, score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.l <> p.own AND 30 * ps <= 100 * score AND 100 * score <= 90 * ps)
        SELECT * FROM n WHERE rank <= 10""",
}
