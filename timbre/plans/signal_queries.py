"""Driver queries on sequences: frames of ``events`` by user, vectors of ``embeddings`` by label."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timbre.functions import signal
from timbre.operators import sequences
from timbre.plans.catalog import query
from timbre.plans.standins import table

BY = ["user_id"]
FRAMES = "frames AS (SELECT user_id, ts, value, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)"


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy(*BY).orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select("user_id", "ts", "value", "event_id").withColumn("i", (F.row_number().over(w) - 1).cast("long"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("label").orderBy("vec_id")
    return table(spark, sf_dir, "embeddings").withColumn("i", (F.row_number().over(w) - 1).cast("long"))


CELLS = "cells AS (SELECT label, vec_id, unnest(range(0, len(embedding))) AS d, cast(unnest(embedding) AS double) AS x FROM embeddings), means AS (SELECT label, d, avg(x) AS m FROM cells GROUP BY label, d)"


@query("window_cosine", f"WITH {CELLS} SELECT label, vec_id, round(sum(x * m) / ((sqrt(sum(x * x)) + 1e-8) * (sqrt(sum(m * m)) + 1e-8)), 6) AS cosine FROM cells JOIN means USING (label, d) GROUP BY label, vec_id")
def window_cosine(spark, sf_dir):
    out = sequences.window_cosines(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding")
    return out.select("label", "vec_id", F.round("cosine", 6).alias("cosine"))


@query("clip_centroid", f"WITH {CELLS} SELECT label, cast(d AS int) AS dim, round(m, 6) AS mean FROM means")
def clip_centroid(spark, sf_dir):
    return sequences.centroid(table(spark, sf_dir, "embeddings"), ["label"], "embedding").select("label", "dim", F.round("mean", 6).alias("mean"))


@query("embedding_pointer", "SELECT vec_id, concat('emb-', label, '.npy') AS emb_file, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS emb_row FROM embeddings")
def embedding_pointer(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("label"))
    return sequences.embedding_pointers(rows, "label", "vec_id").select("vec_id", "emb_file", "emb_row")


@query("embedding_cosine_stats", f"WITH {CELLS}, c AS (SELECT label, vec_id, sum(x * m) / ((sqrt(sum(x * x)) + 1e-8) * (sqrt(sum(m * m)) + 1e-8)) AS cosine FROM cells JOIN means USING (label, d) GROUP BY label, vec_id) SELECT label, count(*) AS n_windows, round(avg(cosine), 6) AS mean_win_cos, round(min(cosine), 6) AS min_win_cos FROM c GROUP BY label")
def embedding_cosine_stats(spark, sf_dir):
    cos = sequences.window_cosines(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding")
    return cos.groupBy("label").agg(F.count("*").alias("n_windows"), F.round(F.avg("cosine"), 6).alias("mean_win_cos"), F.round(F.min("cosine"), 6).alias("min_win_cos"))


SPANS = "spans AS (SELECT user_id, epoch_us(ts) / 1000000.0 AS a, epoch_us(ts) / 1000000.0 + 0.5 + event_id % 7 AS b FROM events)"


@query("pause_stats", f"WITH {SPANS}, g AS (SELECT *, lead(a) OVER (PARTITION BY user_id ORDER BY a, b) - b AS gap FROM spans) SELECT user_id, count(*) FILTER (gap >= 600) AS pause_count, round(coalesce(sum(CASE WHEN gap >= 600 THEN gap * 1000.0 END), 0), 3) AS pause_total_ms, round(sum(greatest(b - a, 0)), 3) AS speech_s FROM g GROUP BY user_id")
def pause_stats(spark, sf_dir):
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    spans = table(spark, sf_dir, "events").select("user_id", start.alias("a"), (start + 0.5 + F.col("event_id") % 7).alias("b"))
    out = sequences.pauses(spans, BY, "a", "b", 600.0)
    return out.select("user_id", "pause_count", F.round("pause_total_ms", 3).alias("pause_total_ms"), F.round("speech_s", 3).alias("speech_s"))


@query("rate_variation", f"WITH {FRAMES}, w AS (SELECT user_id, i // 8 AS k, sum(value) AS v FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM frames) WHERE (i // 8 + 1) * 8 <= n GROUP BY user_id, i // 8) SELECT user_id, count(v) AS n_windows, round(CASE WHEN count(v) < 2 OR avg(v) <= 0 THEN 0 ELSE stddev_pop(v) / avg(v) END, 6) AS rate_var_cv FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN w USING (user_id) GROUP BY user_id")
def rate_variation(spark, sf_dir):
    return sequences.rate_variation(frames(spark, sf_dir), BY, "i", "value", 8).withColumn("rate_var_cv", F.round("rate_var_cv", 6))


PEAKS = f"""{FRAMES}, n AS (SELECT user_id, count(*) AS n, quantile_cont(value, 0.5) AS least FROM frames GROUP BY user_id),
    w AS (SELECT user_id, i, value, least, i // 8 AS k FROM frames JOIN n USING (user_id) WHERE (i // 8 + 1) * 8 <= n),
    m AS (SELECT *, value >= least AND value >= coalesce(lag(value) OVER o, value) AND value >= coalesce(lead(value) OVER o, value) AS peak FROM w WINDOW o AS (PARTITION BY user_id, k ORDER BY i)),
    c AS (SELECT user_id, k, count(*) FILTER (peak) AS p FROM m GROUP BY user_id, k)"""


@query("peak_rate_variation", f"WITH {PEAKS} SELECT user_id, count(p) AS n_windows, round(CASE WHEN count(p) < 2 OR avg(p) <= 0 THEN 0 ELSE stddev_pop(p) / avg(p) END, 6) AS rate_var_cv FROM n LEFT JOIN c USING (user_id) GROUP BY user_id")
def peak_rate_variation(spark, sf_dir):
    return sequences.peak_rate_variation(frames(spark, sf_dir), BY, "i", "value", 8, 1).withColumn("rate_var_cv", F.round("rate_var_cv", 6))


PITCH = f"""{FRAMES}, f AS (SELECT user_id, i, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 60 + value END AS hz FROM frames),
    s AS (SELECT *, CASE WHEN hz > 0 THEN 12 * log2(hz / 55) END AS st, lag(hz) OVER (PARTITION BY user_id ORDER BY i) AS p FROM f),
    q AS (SELECT *, hz > 0 AND coalesce(p > 0, false) AS pair, abs(st - 12 * log2(greatest(p, 1e-9) / 55)) AS step FROM s)"""


@query("pitch_stats", f"""WITH {PITCH}, a AS (SELECT user_id, coalesce(avg(hz) FILTER (hz > 0), 0) AS m, coalesce(stddev_pop(st), 0) AS sd, coalesce(quantile_cont(st, 0.95) - quantile_cont(st, 0.05), 0) AS r, count(*) FILTER (hz > 0) / count(*) AS v, coalesce(count(*) FILTER (pair AND step > 6) / nullif(count(*) FILTER (pair), 0), 0) AS j FROM q GROUP BY user_id)
    SELECT user_id, round(m, 6) AS f0_mean_hz, round(sd, 6) AS f0_std_st, round(r, 6) AS f0_range_st, round(v, 6) AS voiced_ratio, round(j, 6) AS jump_rate, round(greatest(0, least(1, v * (1 - j))), 6) AS f0_tracker_confidence FROM a""")
def pitch_stats(spark, sf_dir):
    rows = frames(spark, sf_dir).withColumn("hz", F.when(F.col("event_id") % 4 == 0, 0.0).otherwise(60 + F.col("value")))
    out = sequences.pitch_stats(rows, BY, "i", "hz")
    return out.select("user_id", *(F.round(c, 6).alias(c) for c in ("f0_mean_hz", "f0_std_st", "f0_range_st", "voiced_ratio", "jump_rate", "f0_tracker_confidence")))


POWERS = f"{FRAMES}, p AS (SELECT user_id, i // 4 AS frame_no, avg(value * value) AS power FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM frames) WHERE (i // 4 + 1) * 4 <= n GROUP BY user_id, i // 4)"


@query("frame_power", f"WITH {POWERS} SELECT user_id, frame_no, round(power, 6) AS power FROM p")
def frame_power(spark, sf_dir):
    return sequences.framed_powers(frames(spark, sf_dir), BY, "i", "value", 4).withColumn("power", F.round("power", 6))


@query("frame_power_snr", f"WITH {POWERS}, q AS (SELECT user_id, quantile_cont(power, 0.1) AS a, quantile_cont(power, 0.95) AS b FROM p GROUP BY user_id) SELECT user_id, round(greatest(-20, least(100, 10 * log10(greatest((b - a) / greatest(a, 1e-10), 1e-10)))), 6) AS snr_db FROM q")
def frame_power_snr(spark, sf_dir):
    out = sequences.blind_snr(sequences.framed_powers(frames(spark, sf_dir), BY, "i", "value", 4), BY)
    return out.withColumn("snr_db", F.round("snr_db", 6))


@query("energy_std_db", "WITH m AS (SELECT user_id, abs(value) AS v, max(abs(value)) OVER (PARTITION BY user_id) AS peak FROM events), d AS (SELECT user_id, CASE WHEN v >= peak * 1e-3 THEN 20 * log10(v + 1e-12) END AS db FROM m) SELECT user_id, round(CASE WHEN count(db) < 2 THEN 0 ELSE stddev_pop(db) END, 6) AS energy_std_db FROM d GROUP BY user_id")
def energy_std_db(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.abs("value").alias("rms"))
    return sequences.energy_deviation(rows, BY, "rms").withColumn("energy_std_db", F.round("energy_std_db", 6))


def arrays(spark: SparkSession, sf_dir: str, scale: float) -> DataFrame:
    """Samples of each user in order, clipped to [-1, 1]."""
    rows = frames(spark, sf_dir)
    clip = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x["v"] / scale))
    return rows.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("i", F.col("value").alias("v")))).alias("a")).select("user_id", F.transform("a", clip).alias("samples"))


def clipped(scale: float) -> Column:
    """Values as samples in [-1, 1]."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("value") / scale))


@query("clipping_ratio", "SELECT user_id, round(avg(CASE WHEN abs(greatest(-1, least(1, value / 100))) >= 0.999 THEN 1.0 ELSE 0.0 END), 6) AS clipping_ratio FROM events GROUP BY user_id")
def clipping_ratio(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(signal.clipped_share(clipped(100.0)).alias("clipping_ratio"))
    return rows.withColumn("clipping_ratio", F.round("clipping_ratio", 6))


@query("peak_dbfs", "SELECT user_id, round(20 * log10(max(abs(greatest(-1, least(1, value / 1000)))) + 1e-12), 6) AS peak_dbfs FROM events GROUP BY user_id")
def peak_dbfs(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(signal.peak_level(clipped(1000.0)).alias("peak_dbfs"))
    return rows.withColumn("peak_dbfs", F.round("peak_dbfs", 6))


#: The greedy choice as jumps: the next peak is the first maximum far enough from the last one.
SPACED = f"""{FRAMES}, s AS (SELECT user_id, i, greatest(-1, least(1, value / 100)) AS v FROM frames), m AS (SELECT user_id, i FROM (SELECT *, lag(v) OVER o AS b, lead(v) OVER o AS a FROM s WINDOW o AS (PARTITION BY user_id ORDER BY i)) WHERE v >= coalesce(b, v) AND v >= coalesce(a, v) AND v >= 0.5),
    taken AS (SELECT user_id, min(i) AS i FROM m GROUP BY user_id UNION ALL SELECT user_id, i FROM (SELECT t.user_id, t.i AS last, min(m.i) AS i FROM taken t JOIN m ON m.user_id = t.user_id AND m.i >= t.i + 3 GROUP BY t.user_id, t.i))"""


@query("peak_count", f"WITH RECURSIVE {SPACED} SELECT u.user_id, cast(count(i) AS int) AS peaks FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN taken USING (user_id) GROUP BY u.user_id")
def peak_count(spark, sf_dir):
    return arrays(spark, sf_dir, 100.0).select("user_id", F.size(sequences.greedy_peaks(F.col("samples"), 0.5, 3)).alias("peaks"))


@query("spaced_peaks", f"WITH RECURSIVE {SPACED} SELECT u.user_id, count(i) AS peaks, coalesce(max(i), -1) AS last_peak, cast(coalesce(sum(i), 0) AS bigint) AS places FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN taken USING (user_id) GROUP BY u.user_id")
def spaced_peaks(spark, sf_dir):
    """Peaks three frames or more apart, in each user's samples."""
    rows = arrays(spark, sf_dir, 100.0).select("user_id", sequences.greedy_peaks(F.col("samples"), 0.5, 3).alias("p"))
    return rows.select("user_id", F.size("p").cast("long").alias("peaks"), F.coalesce(F.array_max("p"), F.lit(-1)).cast("long").alias("last_peak"), F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x).alias("places"))


@query("wav_features")
def wav_features(spark, sf_dir):
    """Features of a synthetic voice for each label of ``embeddings``, encoded and decoded as WAV."""
    @F.pandas_udf("binary")
    def voice(label: pd.Series) -> pd.Series:
        return label.map(lambda k: signal.encode_wav(signal.synthetic_voice(2.0, seed=int(k), pauses=((0.8, 1.2),)), 16000))

    rows = table(spark, sf_dir, "embeddings").select("label").distinct()
    out = rows.select("label", signal.features_udf()(voice(F.col("label"))).alias("f")).select("label", "f.*")
    return out.select("label", *(F.round(c, 3).alias(c) if c != "pause_count" else F.col(c) for c in out.columns[1:]))
