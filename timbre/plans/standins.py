"""Stage tables made from the driver's tables by arithmetic on their keys.

There is no audio in the data folder, so clips are documents: the duration is
the text's length, and every measure is a modular function of the key. The
definitions are SQL that Spark and DuckDB read alike; ``with_standins`` puts
them before an oracle query, ``standin`` runs one in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def modular(a: int, b: int, low: float, high: float, key: str = "doc_id") -> str:
    """A number in [low, high) that depends on the key, in steps of a thousandth of the range."""
    return f"(cast({low} as double) + (({key} * {a} + {b}) % 1000) * cast({high - low} as double) / 1000)"


DEFINITIONS = {
    "raw_meta": f"""
        SELECT doc_id, lpad(cast(doc_id AS string), 8, '0') AS clip_id, concat('P', cast(doc_id % 8 AS string)) AS shard,
            text AS original_text, lang AS original_language, source AS original_speaker,
            CASE WHEN doc_id % 41 = 0 THEN NULL ELSE cast(n_chars AS double) / 100 END AS duration_s,
            CASE WHEN doc_id % 37 = 0 THEN NULL ELSE {modular(7919, 0, 2, 5)} END AS original_dnsmos
        FROM documents""",
    "s0": """
        SELECT doc_id, clip_id, shard, original_speaker, coalesce(duration_s, cast(0 AS double)) AS duration_s, original_dnsmos, original_language,
            coalesce(duration_s BETWEEN 3.0 AND 30.0, false) AND original_language IN ('en', 'fr') AND coalesce(original_dnsmos >= 2.6, false) AS passed
        FROM raw_meta""",
    "measures": f"""
        SELECT doc_id, clip_id, shard, {modular(104729, 3, 6, 9)} AS aes_pq, {modular(1299, 5, 1, 3)} AS aes_pc, {modular(15485, 9, 4.6, 8)} AS aes_ce,
            {modular(86028, 7, 18, 60)} AS snr_db, {modular(7741, 1, 0, 0.0012)} AS clipping_ratio, {modular(611, 13, 3000, 12000)} AS bandwidth_hz
        FROM s0 WHERE passed""",
    "s1": """
        SELECT *, aes_pq >= 7.0 AND aes_pc <= 2.5 AND aes_ce >= 5.0 AND snr_db >= 20.0 AND clipping_ratio <= 0.001 AND bandwidth_hz >= 4000.0 AS passed
        FROM measures""",
    "s2": f"""
        SELECT doc_id, clip_id, {modular(31337, 7, 1, 9)} AS f0_std_st, {modular(2713, 11, 5, 25)} AS f0_range_st, {modular(4211, 3, 2, 12)} AS energy_std_db,
            {modular(977, 19, 2, 8)} AS speech_rate_cps, {modular(3571, 23, 0, 1)} AS rate_var_cv, doc_id % 5 AS pause_count, {modular(5903, 29, 0.2, 1)} AS f0_tracker_confidence
        FROM s1 WHERE passed""",
    "s3": """
        SELECT doc_id, clip_id, CASE doc_id % 7 WHEN 0 THEN 'overlap_rejected' WHEN 1 THEN 'intruded_rejected' WHEN 2 THEN 'intruded_trimmed' WHEN 3 THEN 'degraded_pass' ELSE 'single' END AS verdict,
            doc_id % 7 = 2 AS trimmed, CASE WHEN doc_id % 7 = 2 AND doc_id % 3 <> 0 THEN cast(4 + doc_id % 5 AS double) END AS trimmed_duration_s
        FROM s2""",
    "s4": """
        SELECT doc_id, clip_id, CASE WHEN doc_id % 17 = 0 THEN 'failed' ELSE 'ok' END AS s4_status,
            CASE WHEN doc_id % 34 = 0 THEN 'HTTP 429 Too Many Requests' WHEN doc_id % 17 = 0 THEN 'bad response' END AS error,
            CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'broken' WHEN doc_id % 5 = 0 THEN 'fixable' ELSE 'match' END AS text_verdict,
            CASE WHEN doc_id % 17 = 0 THEN NULL ELSE element_at(EMOTION_LIST, cast(doc_id % 10 AS int) + 1) END AS emotion_primary,
            CASE WHEN doc_id % 17 = 0 THEN NULL ELSE cast(1 + doc_id % 5 AS int) END AS emotion_intensity,
            CASE WHEN doc_id % 17 = 0 OR doc_id % 29 = 0 THEN NULL ELSE cast(1 + (doc_id * 7 + 3) % 5 AS int) END AS prosody_expressiveness,
            CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN ARRAY_OF('truncated_tail', 'artifact') WHEN doc_id % 4 = 0 THEN ARRAY_OF('artifact') ELSE EMPTY_LIST END AS defects,
            doc_id % 17 <> 0 AND doc_id % 6 <> 0 AS usable
        FROM s2 WHERE doc_id % 19 <> 0""",
    "win_cos": """
        SELECT doc_id, clip_id, n_windows, i, cast(0.5 AS double) + ((doc_id * 31 + (CASE WHEN i < 1 + doc_id % 3 THEN 1 ELSE i END) * 577) % 500) / cast(1000 AS double) AS cosine
        FROM (SELECT doc_id, clip_id, cast(1 + doc_id % 9 AS bigint) AS n_windows, EXPLODE_TO(doc_id % 9) AS i FROM s0)""",
}
#: Dialect words: what differs between the two engines, for the few nested values.
SPARK = {"EMOTION_LIST": "array('neutral', 'happy', 'excited', 'sad', 'angry', 'fearful', 'surprised', 'disgusted', 'affectionate', 'serious')", "ARRAY_OF(": "array(", "EMPTY_LIST": "cast(array() AS array<string>)", "EXPLODE_TO(": "explode(sequence(0L, "}
DUCK = {"element_at(": "list_extract(", "EMOTION_LIST": "['neutral', 'happy', 'excited', 'sad', 'angry', 'fearful', 'surprised', 'disgusted', 'affectionate', 'serious']", "ARRAY_OF(": "list_value(", "EMPTY_LIST": "cast([] AS VARCHAR[])", "EXPLODE_TO(": "unnest(range(0, 1 + "}


def translated(sql: str, words: dict[str, str]) -> str:
    for a, b in words.items():
        sql = sql.replace(a, b)
    return sql


def spark_definition(name: str) -> str:
    return translated(DEFINITIONS[name], SPARK).replace("explode(sequence(0L, doc_id % 9)", "explode(sequence(0L, doc_id % 9))") if name == "win_cos" else translated(DEFINITIONS[name], SPARK)


def duck_definition(name: str) -> str:
    sql = translated(DEFINITIONS[name], DUCK)
    return sql.replace("unnest(range(0, 1 + doc_id % 9)", "unnest(range(0, 1 + doc_id % 9))") if name == "win_cos" else sql


def needed(name: str) -> list[str]:
    """The stand-ins that ``name`` is made of, itself last."""
    out: list[str] = []
    for other in DEFINITIONS:
        if other != name and (f"FROM {other}" in DEFINITIONS[name]):
            out += [x for x in needed(other) if x not in out]
    return [*out, name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in over the tables of ``sf_dir``, as one plan without views."""
    parts = [f"{n} AS ({spark_definition(n)})" for n in needed(name)]
    return spark.sql(f"WITH {', '.join(parts)} SELECT * FROM {name}".replace("FROM documents", "FROM {documents}"), documents=table(spark, sf_dir, "documents"))


def with_standins(names: str, sql: str) -> str:
    """Oracle SQL: the named stand-ins as common table expressions, then ``sql`` (a SELECT, or more CTEs and one)."""
    order: list[str] = []
    for name in names.split():
        order += [x for x in needed(name) if x not in order]
    parts = ", ".join(f"{n} AS ({duck_definition(n)})" for n in order)
    sql = sql.strip()
    return f"WITH {parts}, {sql[5:]}" if sql.upper().startswith("WITH ") else f"WITH {parts} {sql}"
