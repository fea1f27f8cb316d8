"""Driver queries over the driver's own tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.config import LabelRule, ProsodyWeights
from timbre.functions import text
from timbre.operators import labels, reports, rolling, sampling, scoring, tasks
from timbre.plans.catalog import query
from timbre.plans.standins import table
from timbre.sources.shards import ALIASES

POINTS = reports.QUANTILES
PART_WEIGHTS = [("p_retailprice", 0.7), ("p_size", 0.3)]


def quantile_sql(source: str, metrics: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, count({m}) AS n, round(avg({m}), 6) AS mean, cast({p} AS double) AS q, round(cast(quantile_cont({m}, {p}) AS double), 6) AS value FROM {source}" for m in metrics for p in POINTS)


@query("metric_quantiles", quantile_sql("part", ["p_retailprice", "p_size"]))
def metric_quantiles(spark, sf_dir):
    out = reports.metric_quantiles(table(spark, sf_dir, "part"), ["p_retailprice", "p_size"])
    return out.select("metric", "n", F.round("mean", 6).alias("mean"), "q", F.round("value", 6).alias("value"))


@query("lineitem_quantiles", quantile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def lineitem_quantiles(spark, sf_dir):
    out = reports.metric_quantiles(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("metric", "n", F.round("mean", 6).alias("mean"), "q", F.round("value", 6).alias("value"))


def suggestion_sql(metric: str, kind: str, want: float) -> str:
    low, high = max(p for p in POINTS if p <= want), min(p for p in POINTS if p >= want)
    return f"SELECT '{metric}' AS metric, '{kind}' AS kind, round(a + (b - a) * ({want} - {low}) / {max(high - low, 1e-9)}, 6) AS suggested FROM (SELECT cast(quantile_cont({metric}, {low}) AS double) AS a, cast(quantile_cont({metric}, {high}) AS double) AS b FROM part)"


@query("suggested_thresholds", suggestion_sql("p_retailprice", "min", 0.4) + " UNION ALL " + suggestion_sql("p_size", "max", 0.6))
def suggested_thresholds(spark, sf_dir):
    out = reports.suggested_thresholds(table(spark, sf_dir, "part"), [("p_retailprice", "min"), ("p_size", "max")], 0.6)
    return out.select("metric", "kind", F.round("suggested", 6).alias("suggested"))


def z_sql(over: str) -> str:
    return " + ".join(f"cast({w} AS double) * coalesce(({m} - avg({m}) OVER ({over})) / nullif(stddev_pop({m}) OVER ({over}), 0), 0)" for m, w in PART_WEIGHTS)


@query("zscore_global", f"SELECT p_partkey, round({z_sql('')}, 6) AS score FROM part")
def zscore_global(spark, sf_dir):
    return scoring.zscore_sum(table(spark, sf_dir, "part"), PART_WEIGHTS, "score").select("p_partkey", F.round("score", 6).alias("score"))


@query("zscore_partitioned", f"SELECT p_partkey, round({z_sql('PARTITION BY p_brand')}, 6) AS score FROM part")
def zscore_partitioned(spark, sf_dir):
    return scoring.zscore_sum(table(spark, sf_dir, "part"), PART_WEIGHTS, "score", by=["p_brand"]).select("p_partkey", F.round("score", 6).alias("score"))


def minmax_sql(constant: str) -> str:
    return f"SELECT p_partkey, round(CASE WHEN max(p_retailprice) OVER () > min(p_retailprice) OVER () THEN (p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) ELSE {constant} END, 6) AS price, cast({constant} AS double) AS flat FROM part"


def minmax_query(name: str, constant: float) -> None:
    @query(name, minmax_sql(str(constant)))
    def run(spark, sf_dir):
        rows = table(spark, sf_dir, "part").withColumn("same", F.lit(5.0))
        return scoring.minmax(rows, {"price": "p_retailprice", "flat": "same"}, constant).select("p_partkey", F.round("price", 6).alias("price"), "flat")


minmax_query("minmax_const_one", 1.0)
minmax_query("minmax_const_zero", 0.0)


@query("cer", "SELECT a.item_id, round(CASE WHEN r = '' THEN CASE WHEN h = '' THEN 0 ELSE 1 END ELSE levenshtein(r, h) / length(r) END, 6) AS cer FROM (SELECT item_id, left(text, 60) AS r, replace(left(text, 66), 'e', 'a') AS h FROM benchmark WHERE regexp_full_match(text, '[\\x00-\\x7F]*')) a")
def cer(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").where(F.col("text").rlike(r"^[\x00-\x7F]*$"))
    return rows.select("item_id", F.round(text.char_error_rate(F.left("text", F.lit(60)), F.replace(F.left("text", F.lit(66)), F.lit("e"), F.lit("a"))), 6).alias("cer"))


@query("cer_whole")
def cer_whole(spark, sf_dir):
    """Whole texts of all rows; SQL's levenshtein counts bytes, so it isn't given."""
    hypothesis = F.concat(F.replace("text", F.lit("e"), F.lit("a")), F.lit(" added"))
    return table(spark, sf_dir, "benchmark").select("item_id", F.round(text.char_error_rate(F.col("text"), hypothesis), 6).alias("cer"))


@query("content_hash", "SELECT doc_id, sha256(text) AS hash FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("hash"))


@query("alias_resolution", """SELECT doc_id, cast(doc_id AS varchar) AS id, lang AS language, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE cast(n_chars AS double) END AS duration_s, source AS speaker FROM documents""")
def alias_resolution(spark, sf_dir):
    """Sidecar documents under mixed alias names; a duration that isn't a number is null."""
    docs = table(spark, sf_dir, "documents")
    key = lambda *names: F.element_at(F.array(*map(F.lit, names)), (F.col("doc_id") % len(names) + 1).cast("int"))
    names = lambda field: ALIASES[field]
    pairs = [key(*names("original_id")), F.col("doc_id").cast("string"), key(*names("original_language")), F.col("lang"), key(*names("duration_s")), F.when(F.col("doc_id") % 5 == 0, "n/a").otherwise(F.col("n_chars").cast("string")), key(*names("original_speaker")), F.col("source")]
    rows = docs.select("doc_id", F.to_json(F.create_map(*pairs)).alias("j"))
    j = F.col("j")
    return rows.select(
        "doc_id", text.first_of(j, names("original_id")).alias("id"), text.first_of(j, names("original_language")).alias("language"),
        text.to_number(text.first_of(j, names("duration_s"))).alias("duration_s"), text.first_of(j, names("original_speaker")).alias("speaker"),
    )


@query("clean_values", """SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, left(html, 500) AS cut, CASE WHEN length(html) < 1024 THEN concat(length(html), ' B') ELSE concat(printf('%.1f', length(html) / 1024.0), ' KB') END AS size,
    CASE WHEN page_id % 3 = 0 THEN NULL ELSE cast(page_id AS double) END AS scrubbed FROM pages""")
def clean_values(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    dirty = F.when(F.col("page_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("page_id").cast("double"))
    return rows.select("page_id", text.base_name(F.col("url")).alias("base"), text.shortened(F.col("html")).alias("cut"), text.human_bytes(F.length("html")).alias("size"), text.scrubbed(dirty).alias("scrubbed"))


TASKS = "tasks AS (SELECT concat('T', lpad(cast(s_suppkey AS varchar), 5, '0')) AS task_id, s_suppkey AS k FROM supplier)"


def task_rows(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("T"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("task_id"), F.col("s_suppkey").alias("k"))


@query("pending_tasks", f"WITH {TASKS} SELECT task_id FROM tasks WHERE k % 3 <> 0")
def pending_tasks(spark, sf_dir):
    rows = task_rows(spark, sf_dir)
    return tasks.pending(rows, rows.where("k % 3 = 0"))


@query("limit_pending", f"WITH {TASKS} SELECT task_id FROM tasks WHERE k % 3 <> 0 ORDER BY task_id LIMIT 5")
def limit_pending(spark, sf_dir):
    rows = task_rows(spark, sf_dir)
    return tasks.pending(rows, rows.where("k % 3 = 0"), limit=5)


@query("stage_progress", f"""WITH {TASKS}, st AS (SELECT * FROM (VALUES ('s0', 2), ('s1', 3), ('s4', 5)) AS v(stage, m)),
    log AS (SELECT stage, task_id, CASE WHEN k % m = 0 THEN 'done' WHEN k % m = 1 THEN 'failed' END AS status FROM tasks, st),
    t AS (SELECT stage, CASE WHEN stage = 's4' THEN NULL ELSE (SELECT count(*) FROM tasks) END AS listed, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'failed') AS failed FROM log GROUP BY stage)
    SELECT stage, coalesce(listed, done) AS total, done, failed, greatest(coalesce(listed, done) - done, 0) AS pending FROM t""")
def stage_progress(spark, sf_dir):
    stages = F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.lit(m).alias("m")) for s, m in (("s0", 2), ("s1", 3), ("s4", 5)))))
    rows = task_rows(spark, sf_dir).select("task_id", "k", stages.alias("x")).select("task_id", "k", "x.*")
    log = rows.select("stage", "task_id", F.when(F.col("k") % F.col("m") == 0, "done").when(F.col("k") % F.col("m") == 1, "failed").alias("status")).where("status IS NOT NULL")
    return tasks.stage_progress(rows.where("stage <> 's4'").select("stage", "task_id"), log)


@query("failure_quarantine", "SELECT concat('O', o_custkey) AS task_id, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) >= 5")
def failure_quarantine(spark, sf_dir):
    failures = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("O"), F.col("o_custkey").cast("string")).alias("task_id"))
    return tasks.quarantined(failures, 5)


@query("throughput_eta", "WITH n AS (SELECT max(ts) AS now FROM events), a AS (SELECT count(*) AS done, count(*) FILTER (ts > now - INTERVAL 1 HOUR AND ts <= now) AS last_hour FROM events, n) SELECT done, last_hour, greatest(200000 - done, 0) AS remaining, round(greatest(200000 - done, 0) / nullif(last_hour, 0), 6) AS eta_hours FROM a")
def throughput_eta(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    log = events.crossJoin(F.broadcast(events.agg(F.max("ts").alias("now"))))
    out = tasks.throughput(log, "ts", F.col("now"), 200000)
    return out.withColumn("eta_hours", F.round("eta_hours", 6))


#: CRC-32 of the bytes of an ASCII text, a bit at a time.
CRC = "xor(list_reduce(list_transform(string_split(task_id, ''), lambda c: cast(ascii(c) AS bigint)), lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, b)), cast(4294967295 AS bigint)), 4294967295)"


@query("hash_partition", f"WITH {TASKS} SELECT task_id, cast({CRC} % 8 AS int) AS worker FROM tasks")
def hash_partition(spark, sf_dir):
    rows = task_rows(spark, sf_dir)
    return rows.select("task_id", text.hash_slot(F.col("task_id"), 8).alias("worker"))


@query("shard_range_expand", "SELECT concat('P', lpad(cast(i AS varchar), 3, '0')) AS shard FROM range(7, 13) t(i) UNION ALL SELECT 'Q5' UNION ALL SELECT concat('R', i) FROM range(9, 12) t(i)")
def shard_range_expand(spark, sf_dir):
    return tasks.expanded_shards(spark, "P007..P012, Q5, R9..R11")


@query("stale_files", "SELECT concat('data/', n_name, '.parquet') AS path FROM nation WHERE n_nationkey % 2 = 1")
def stale_files(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    path = F.concat(F.when(F.col("n_nationkey") % 2 == 1, "data/").otherwise(F.lit("docs/")), "n_name", F.lit(".parquet")).alias("path")
    return tasks.stale(nations.select(path), nations.where("n_nationkey % 2 = 0").select(path), ("data/",))


@query("union_parts", "SELECT c_custkey AS key, c_name AS name, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def union_parts(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return tasks.union_parts(a, b)


@query("customer_cap", "WITH r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rk, max(c_acctbal) OVER (PARTITION BY c_nationkey, c_mktsegment) AS best FROM customer) SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY rk, best DESC, c_mktsegment DESC) <= 20 AS kept FROM r")
def customer_cap(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))
    return sampling.capped_round_robin(rows, 20, "nation", "c_mktsegment", "c_acctbal", "c_custkey").select("c_custkey", "kept")


@query("global_rank", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS priority_rank FROM orders")
def global_rank(spark, sf_dir):
    return scoring.ranked(table(spark, sf_dir, "orders"), [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "priority_rank")


@query("lineitem_ranked", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS priority_rank FROM lineitem")
def lineitem_ranked(spark, sf_dir):
    order = [F.desc("l_extendedprice"), *(F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))]
    return scoring.ranked(table(spark, sf_dir, "lineitem"), order).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "priority_rank")


@query("label_schema_errors", """SELECT conv_id, turn, CASE conv_id % 5 WHEN 0 THEN 'unknown:emotion.mood' WHEN 1 THEN 'usable' WHEN 2 THEN 'text_fixed,context.summary' WHEN 3 THEN 'unknown:extra' END AS error FROM conversations""")
def label_schema_errors(spark, sf_dir):
    """Documents with a foreign key in a block, without a field, without two fields, with a foreign key on top, and whole ones."""
    good = '{"text_verdict":"match","text_fixed":"","text_punctuated":"","emotion":{"primary":"happy","secondary":null,"intensity":2,"confidence":0.5},"prosody":{"expressiveness":3,"speaking_style":"speech","rhythm":"steady","prominent_stress":true},"context":{"scenario":"drama","register":"formal","summary":""},"language":{"primary":"en","code_switch":false,"accent":"standard"},"paralinguistic":["sigh"],"defects":[],"usable":true}'
    bad = (good.replace('"intensity"', '"mood":1,"intensity"'), good.replace(',"usable":true', ""), good.replace('"text_fixed":"",', "").replace(',"summary":""', ""), good.replace('"usable"', '"extra":1,"usable"'), good)
    kind, response = F.col("conv_id") % 5, F.lit(good)
    for i, text in enumerate(bad):
        response = F.when(kind == i, text).otherwise(response)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", response.alias("response"))
    return labels.parse_labels(rows, "response").select("conv_id", "turn", "error")


@query("correlation", "SELECT count(*) AS n, round(corr(l_quantity, l_extendedprice), 6) AS r, round(avg(l_quantity - l_extendedprice), 4) AS mean_diff FROM lineitem")
def correlation(spark, sf_dir):
    return reports.agreement(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice").select("n", F.round("r", 6).alias("r"), F.round("mean_diff", 4).alias("mean_diff"))


@query("size_rollover", """WITH RECURSIVE o AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
    f AS (SELECT source, doc_id, k, 0 AS shard_no, n_chars AS held FROM o WHERE k = 1
        UNION ALL SELECT o.source, o.doc_id, o.k, CASE WHEN f.held >= 50000 THEN f.shard_no + 1 ELSE f.shard_no END, CASE WHEN f.held >= 50000 THEN o.n_chars ELSE f.held + o.n_chars END FROM f JOIN o ON o.source = f.source AND o.k = f.k + 1)
    SELECT doc_id, source, cast(shard_no AS bigint) AS shard_no FROM f""")
def size_rollover(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return rolling.rollover(rows, ["source"], ["doc_id"], "n_chars", 50000).select("doc_id", "source", "shard_no")


@query("deterministic_shuffle", "SELECT doc_id, source, row_number() OVER (ORDER BY md5(concat('1234:', doc_id)), doc_id) - 1 AS place FROM documents")
def deterministic_shuffle(spark, sf_dir):
    """Documents in shuffled order, with their places in it."""
    rows = sampling.shuffled(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return scoring.ranked(rows, sampling.shuffle_order("doc_id"), "place")


@query("event_props", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def event_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


def answering(first_tries: int):
    """A provider that answers a clip of an odd number wrongly at first, and one in seven always."""
    seen: dict[str, int] = {}

    async def provider(clip_id: str, text: str) -> str:
        n = seen[clip_id] = seen.get(clip_id, 0) + 1
        key = int(clip_id.split("-")[0])
        if key % 7 == 0 or key % 2 == 1 and n <= first_tries:
            return "{not json"
        return labels.seeded_document(clip_id, text)

    return provider


@query("label_retries", """SELECT concat(conv_id, '-', turn) AS clip_id, CASE WHEN conv_id % 7 = 0 THEN 'failed' ELSE 'ok' END AS s4_status, CASE WHEN conv_id % 7 = 0 THEN 'malformed answer: JSONDecodeError' END AS error,
    CASE WHEN conv_id % 7 <> 0 THEN coalesce(text, '') END AS text_fixed, CASE WHEN conv_id % 7 <> 0 THEN md5(coalesce(text, '')) END AS digest FROM conversations""")
def label_retries(spark, sf_dir):
    """Turns labelled by a provider whose answers are malformed at first or for good."""
    rows = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("clip_id"), "text")
    rule = LabelRule(max_attempts=3, backoff_cap_s=0.0)
    out = labels.label_rows(labels.label_calls(rows, rule, answering(2)))
    return out.select("clip_id", "s4_status", "error", F.col("labels.text_fixed").alias("text_fixed"), F.md5(F.col("labels.text_punctuated").cast("binary")).alias("digest"))


@query("label_parse", """SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' ELSE 'failed' END AS s4_status,
    CASE conv_id % 4 WHEN 2 THEN 'emotion.intensity' WHEN 3 THEN 'malformed' END AS error, CASE WHEN conv_id % 4 < 2 THEN 'happy' END AS emotion FROM conversations""")
def label_parse(spark, sf_dir):
    """Responses that are valid, fenced, out of range or malformed."""
    good = '{"text_verdict":"match","text_fixed":"","text_punctuated":"","emotion":{"primary":"happy","secondary":null,"intensity":%s,"confidence":0.5},"prosody":{"expressiveness":3,"speaking_style":"speech","rhythm":"steady","prominent_stress":true},"context":{"scenario":"drama","register":"formal","summary":""},"language":{"primary":"en","code_switch":false,"accent":"standard"},"paralinguistic":["sigh"],"defects":[],"usable":true}'
    kind = F.col("conv_id") % 4
    response = F.when(kind == 0, good % 3).when(kind == 1, "```json\n" + good % 5 + "\n```").when(kind == 2, good % 9).otherwise("{not json")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", response.alias("response"))
    return labels.parse_labels(rows, "response").select("conv_id", "turn", "s4_status", "error", F.col("labels.emotion.primary").alias("emotion"))


@query("default_weights", " UNION ALL ".join(f"SELECT '{m}' AS metric, cast({w} AS double) AS weight" for m, w in ProsodyWeights().items()))
def default_weights(spark, sf_dir):
    kind = T.StructType([T.StructField("metric", T.StringType()), T.StructField("weight", T.DoubleType())])
    return spark.createDataFrame(ProsodyWeights().items(), kind)
