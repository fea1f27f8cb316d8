"""Driver queries on stage tables, part states, encoded clips and the requests that carry them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.config import AcousticGate
from timbre.functions import clip_audio, signal, text
from timbre.operators import batching, gates, part_state, reports, sequences
from timbre.plans import clip_queries as clips
from timbre.plans import record_queries, shard_queries, signal_queries
from timbre.plans.catalog import query
from timbre.plans.standins import standin, table, with_standins
from timbre.sources import tables, tars
from timbre.store import fresh_path

S0 = T.StructType([T.StructField(n, k) for n, k in (("doc_id", T.LongType()), ("clip_id", T.StringType()), ("shard", T.StringType()), ("duration_s", T.DoubleType()), ("passed", T.BooleanType()), ("reject_reason", T.StringType()))])


@query("stage_roundtrip", with_standins("s0", "SELECT doc_id, clip_id, shard, duration_s, passed, cast(NULL AS varchar) AS reject_reason, 'done' AS status FROM s0"))
def stage_roundtrip(spark, sf_dir):
    """A stage table written by shards in three tasks, one of them twice, read as a view with the log of its tasks."""
    rows, root = standin(spark, sf_dir, "s0").select("doc_id", "clip_id", "shard", "duration_s", "passed"), fresh_path(spark, "stage")
    for part in ("shard < 'P4'", "shard >= 'P3'", "shard = 'P7'"):
        some = rows.where(part)
        tables.write_stages({"s0": (some, S0)}, root, some.select(F.col("shard").alias("task_id")).distinct(), "s0")
    tables.read_stage(spark, f"{root}/s0", view="written_s0")
    tables.read_log(spark, f"{root}/task_log").select("task_id", "status").distinct().createOrReplaceTempView("written_log")
    return spark.sql("SELECT s.doc_id, s.clip_id, s.shard, s.duration_s, s.passed, s.reject_reason, l.status FROM written_s0 s JOIN written_log l ON s.shard = l.task_id")


METRICS = ["aes_pq", "aes_ce", "snr_db"]
LIMITS = [x for x in gates.acoustic_limits(AcousticGate()) if x[0] in METRICS]
KILLS = {name: f"count(*) FILTER ({name} IS NULL OR {name} {sign} {value})" for name, sign, value in LIMITS}


def states(spark, sf_dir) -> str:
    """Where the states of the measures are kept, a part at a time; the first one arrives twice."""
    rows, path = standin(spark, sf_dir, "measures"), fresh_path(spark, "states")
    for part in ("shard < 'P3'", "shard >= 'P3' AND shard < 'P6'", "shard >= 'P6'", "shard < 'P3'"):
        part_state.add_parts(part_state.part_states(rows.where(part), "shard", METRICS, LIMITS), path)
    return path


@query("part_statistics", with_standins("measures", " UNION ALL ".join(f"SELECT '{m}' AS metric, count({m}) AS n, round(avg({m}), 6) AS mean, round(stddev_pop({m}), 6) AS std, min({m}) AS low, max({m}) AS high, {KILLS[m]} AS killed FROM measures" for m in METRICS)))
def part_statistics(spark, sf_dir):
    """Statistics of all rows from the merged states of their parts."""
    out = part_state.summary(part_state.merged(part_state.read_states(spark, states(spark, sf_dir))))
    return out.select("metric", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "low", "high", "killed")


@query("prefix_statistics", with_standins("measures", "WITH p AS (SELECT DISTINCT shard FROM measures) " + " UNION ALL ".join(f"SELECT p.shard AS upto, '{m}' AS metric, count({m}) AS n, round(avg({m}), 6) AS mean, round(stddev_pop({m}), 6) AS std, min({m}) AS low, max({m}) AS high, {KILLS[m]} AS killed FROM p JOIN measures m ON m.shard <= p.shard GROUP BY p.shard" for m in METRICS)))
def prefix_statistics(spark, sf_dir):
    """Statistics after each part, of it and those before it."""
    out = part_state.prefixes(part_state.read_states(spark, states(spark, sf_dir)))
    return out.select("upto", "metric", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "low", "high", "killed")


@query("part_scores", with_standins("measures", "SELECT clip_id, round(0.7 * coalesce((aes_pq - avg(aes_pq) OVER ()) / nullif(stddev_pop(aes_pq) OVER (), 0), 0) + 0.3 * coalesce((snr_db - avg(snr_db) OVER ()) / nullif(stddev_pop(snr_db) OVER (), 0), 0), 6) AS score FROM measures"))
def part_scores(spark, sf_dir):
    """Scores of all clips by the merged states, without another pass for the statistics."""
    whole = part_state.merged(part_state.read_states(spark, states(spark, sf_dir)))
    out = part_state.scored(standin(spark, sf_dir, "measures"), whole, [("aes_pq", 0.7), ("snr_db", 0.3)])
    return out.select("clip_id", F.round("score", 6).alias("score"))


SHOWN = "clip_id audio_duration_s source_original_speaker speaker_embedding_ref_emb_row omni_labels_emotion_primary omni_labels_language_accent selection_tier pipeline_version".split()


@query("reloaded_documents", with_standins("raw_meta s0 s1 s2 s3 s4", f"WITH {record_queries.WIDE} SELECT {', '.join(f'{record_queries.sql_leaves()[c]} AS {c}' for c in SHOWN)} FROM wide WHERE tier IN ('S', 'A')"))
def reloaded_documents(spark, sf_dir):
    """The release's documents written as JSON lines and loaded again; those of its tiers are taken."""
    path = fresh_path(spark, "documents")
    tables.write_documents(record_queries.published.published_records(record_queries.wide(spark, sf_dir), record_queries.RELEASE), path)
    rows = record_queries.meta.flatten(spark.read.schema(record_queries.published.RECORD).json(path))
    return rows.where(F.col("selection_tier").isin("S", "A")).select(*SHOWN)


@query("tier_folders", with_standins("s0 s1 s2 s3", f"WITH {clips.JOINED}, {clips.SCORED}, {clips.TIERED} SELECT clip_id, tier FROM tiered"))
def tier_folders(spark, sf_dir):
    """A release written in a folder for each tier."""
    path = fresh_path(spark, "tiers")
    tables.write_tiers(clips.tiered(spark, sf_dir).select("clip_id", "tier"), path)
    return tables.read_stage(spark, path).select("clip_id", "tier")


@query("shard_names", "WITH RECURSIVE " + shard_queries.PACKED + " SELECT regexp_extract(shard, '([^/]*)$', 1) AS task_id, count(DISTINCT shard) AS tars, count(*) + count(audio) AS members FROM packed GROUP BY 1")
def shard_names(spark, sf_dir):
    """The names of the packed shards as tasks, and their members by the index of headers."""
    path, _ = shard_queries.packed(spark, sf_dir)
    names = tars.shard_tasks(spark, path).distinct()
    index = tars.member_index(spark, path).groupBy("shard").agg(F.count_distinct("tar").alias("tars"), F.count("*").alias("members"))
    return names.join(index, F.col("task_id") == F.col("shard")).select("task_id", "tars", "members")


RATE = 8000
SAMPLES = f"{signal_queries.FRAMES}, s AS (SELECT user_id, i, round_even(cast(cast(greatest(-1, least(1, value / 100)) AS float) * cast(32767 AS float) AS double), 0) AS q FROM frames)"


@query("wav_codec", f"WITH {SAMPLES} SELECT user_id, cast({RATE} AS int) AS rate, count(*) AS n, round(count(*) / {RATE}, 6) AS duration_s, cast(sum(q) AS bigint) AS total, cast(sum(q * (i % 100)) AS bigint) AS places, cast(44 + 2 * count(*) AS bigint) AS n_bytes, cast(ceil((44 + 2 * count(*)) / 3) * 4 + 22 AS bigint) AS uri_chars FROM s GROUP BY user_id")
def wav_codec(spark, sf_dir):
    """Each user's samples encoded as WAV, decoded again and put into a data URI."""
    rows = signal_queries.arrays(spark, sf_dir, 100.0).select("user_id", F.transform("samples", lambda x: x.cast("float")).alias("samples"))
    rows = rows.select("user_id", clip_audio.wav_of(RATE)("samples").alias("audio"))
    back = rows.select("user_id", "audio", clip_audio.decoded("audio").alias("d")).select("user_id", "audio", "d.*")
    whole = F.transform("samples", lambda x, i: F.struct(F.round(x * 32768).cast("long").alias("q"), i.alias("i")))
    total = lambda f: F.aggregate(F.transform(whole, f), F.lit(0).cast("long"), lambda a, x: a + x)
    n = F.size("samples").cast("long")
    return back.select(
        "user_id", "rate", n.alias("n"), F.round(signal.duration_s(n, F.col("rate")), 6).alias("duration_s"), total(lambda x: x["q"]).alias("total"), total(lambda x: x["q"] * (x["i"] % 100)).alias("places"),
        F.octet_length("audio").cast("long").alias("n_bytes"), F.length(F.regexp_replace(clip_audio.data_uri(F.col("audio")), r"\r?\n", "")).cast("long").alias("uri_chars"),
    )


@query("label_requests", "SELECT conv_id, turn, 'system' AS first_role, 'user' AS second_role, 'input_audio' AS first_part, concat('data:audio/wav;base64,', base64(encode(role))) AS data, concat('Check: ', coalesce(text, ''), ' - done') AS instruction FROM conversations")
def label_requests(spark, sf_dir):
    """The messages of a labelling request for each turn, read back by path."""
    rows = table(spark, sf_dir, "conversations").withColumn("m", clip_audio.messages(F.col("role").cast("binary"), F.col("text"), "You label clips.", "Check: {reference_text} - done"))
    at = lambda path: F.get_json_object("m", path)
    return rows.select("conv_id", "turn", at("$[0].role").alias("first_role"), at("$[1].role").alias("second_role"), at("$[1].content[0].type").alias("first_part"), at("$[1].content[0].input_audio.data").alias("data"), at("$[1].content[1].text").alias("instruction"))


@query("frame_rms", f"WITH {signal_queries.FRAMES}, n AS (SELECT user_id, count(*) AS n FROM frames GROUP BY user_id), k AS (SELECT user_id, unnest(range(0, cast(greatest(0, (n - 10) // 4) AS bigint) + 1)) AS frame_no FROM n) SELECT user_id, frame_no, round(sqrt(avg(value * value) + 1e-12), 6) AS rms FROM k JOIN frames USING (user_id) WHERE i >= frame_no * 4 AND i < frame_no * 4 + 10 GROUP BY user_id, frame_no")
def frame_rms(spark, sf_dir):
    """Frames of ten values every four."""
    return sequences.overlapping_frames(signal_queries.frames(spark, sf_dir), signal_queries.BY, "i", "value", 10, 4).withColumn("rms", F.round("rms", 6))


AGGREGATE = "a AS (SELECT doc_id, clip_id, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 1 + doc_id % 4 END AS nw, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE (doc_id * 37 % 100) / 100.0 END AS mw, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE (doc_id * 53 % 100) / 100.0 END AS lw, (doc_id * 71 % 100) / 100.0 AS conf FROM s0), b AS (SELECT *, coalesce(nw, 1) AS n, coalesce(mw, 1.0) AS m, coalesce(lw, mw, 1.0) AS l FROM a)"


@query("purity_of_aggregates", with_standins("s0", f"WITH {AGGREGATE} SELECT clip_id, CASE WHEN n <= 1 THEN 'single' WHEN m < 0.80 AND conf < 0.45 THEN 'overlap_rejected' WHEN m < 0.80 OR l < 0.70 THEN 'degraded_pass' ELSE 'single' END AS verdict, false AS trimmed FROM b"))
def purity_of_aggregates(spark, sf_dir):
    """Verdicts where a model gives no windows but their count, mean and least cosine, any of which may lack."""
    k = F.col("doc_id")
    part = lambda a: (k * a % 100) / 100.0
    rows = standin(spark, sf_dir, "s0").select("clip_id", F.when(k % 6 != 0, 1 + k % 4).alias("n_windows"), F.when(k % 5 != 0, part(37)).alias("mean_win_cos"), F.when(k % 7 != 0, part(53)).alias("min_win_cos"), part(71).alias("f0_tracker_confidence"), F.lit(5.0).alias("duration_s"))
    return sequences.purity(sequences.aggregate_windows(rows), clips.PURITY).select("clip_id", "verdict", "trimmed")


@query("span_fit", with_standins("s0", "WITH p AS (SELECT clip_id, range(0, 1 + doc_id % 5) AS s, doc_id % 8 AS n FROM s0) SELECT clip_id, array_to_string(CASE WHEN len(s) >= n THEN s[1:n] ELSE list_concat(s, list_transform(range(0, n - len(s)), lambda x: s[len(s)])) END, ',') AS spans FROM p"))
def span_fit(spark, sf_dir):
    """Lists of spans cut to a number of windows, or their last one repeated."""
    k = F.col("doc_id")
    rows = standin(spark, sf_dir, "s0").select("clip_id", F.sequence(F.lit(0).cast("long"), k % 5).alias("s"), (k % 8).cast("int").alias("n"))
    return rows.select("clip_id", F.concat_ws(",", F.transform(sequences.fitted_spans(F.col("s"), F.col("n")), lambda x: x.cast("string"))).alias("spans"))


@query("funnel_models", with_standins("s0 s1", "SELECT s1.clip_id, round(1 + 10 * sqrt((s1.aes_pq * s1.aes_pq + s1.snr_db * s1.snr_db) / 2), 3) AS score, (SELECT count(*) FROM s1 WHERE passed) AS n_scored FROM s1 WHERE s1.passed"))
def funnel_models(spark, sf_dir):
    """A model that sees only the clips that pass both gates, and the number of items that it was given."""
    seen = spark.sparkContext.accumulator(0)

    def counting():
        run = batching.MODELS["loudness"]()

        def model(items):
            seen.add(len(items))
            return run(items)

        return model

    rows = standin(spark, sf_dir, "s1").where("passed").select("clip_id", F.array(F.array(F.col("aes_pq"), F.col("snr_db"))).alias("items"))
    path = fresh_path(spark, "scores")
    batching.batched(rows, "items", "scores", T.DoubleType(), counting, size=64).write.parquet(path)
    return spark.read.parquet(path).select("clip_id", F.round(F.col("scores")[0], 3).alias("score"), F.lit(seen.value).cast("long").alias("n_scored"))


@query("label_cost_with_tasks", with_standins("s0 s4", """WITH j AS (SELECT s4_status = 'ok' AS ok, regexp_matches(lower(coalesce(error, '')), '429|throttl|rate limit|ratelimit|too many requests') AS lim FROM s4),
    t AS (SELECT count(*) FILTER (doc_id % 3 = 0) AS more FROM s4 WHERE doc_id % 17 = 0), a AS (SELECT count(*) FILTER (ok) AS k, count(*) FILTER (NOT ok) AS f, count(*) FILTER (NOT ok AND lim) AS l FROM j)
    SELECT k AS labels_ok, f AS labels_failed, l + more AS rate_limit_failures, round(CASE WHEN k + f > 0 THEN (l + more) / (k + f) ELSE 0 END, 4) AS rate_limit_rate FROM a, t"""))
def label_cost_with_tasks(spark, sf_dir):
    """Cost of labels where whole tasks have failed too."""
    s4 = standin(spark, sf_dir, "s4")
    failed = s4.where("doc_id % 17 = 0").select(F.when(F.col("doc_id") % 3 == 0, "Rate limit reached").otherwise("lost worker").alias("error"))
    return reports.label_cost(s4, standin(spark, sf_dir, "s0"), failed).select("labels_ok", "labels_failed", "rate_limit_failures", "rate_limit_rate")


@query("time_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events")
def time_stamps(spark, sf_dir):
    iso = text.iso_utc(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", iso.alias("iso"), text.file_stamp(iso).alias("stamp"))


@query("seeded_fractions", "SELECT doc_id, round(cast(concat('0x', left(md5(concat(doc_id, chr(31), 'pitch')), 8)) AS bigint) / 4294967296.0, 9) AS fraction FROM documents")
def seeded_fractions(spark, sf_dir):
    """A number for each document that depends on its id and a name alone."""
    return table(spark, sf_dir, "documents").select("doc_id", F.round(text.hash_fraction("doc_id", F.lit("pitch")), 9).alias("fraction"))
