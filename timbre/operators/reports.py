"""Histograms, calibration, cost, progress and their text forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbre.functions.text import is_rate_limit
from timbre.operators.scoring import numbered, quantiles

# Quantile points of calibration; tokens and prices of a label.
QUANTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
AUDIO_TOKENS_PER_S, TEXT_TOKENS, OUTPUT_TOKENS = 25.0, 900.0, 220.0
USD_PER_1K_INPUT, USD_PER_1K_OUTPUT, DEFAULT_SECONDS = 0.0008, 0.0020, 8.0


def histogram(df: DataFrame, column: Column, where: Column | None = None) -> DataFrame:
    """(value, n) of the values that aren't null, the most frequent first, then by value."""
    rows = df.select(column.cast("string").alias("value"), *([where.alias("__w")] if where is not None else []))
    if where is not None:
        rows = rows.where("__w")
    return rows.where("value is not null").groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def metric_quantiles(df: DataFrame, metrics: Sequence[str], points: Sequence[float] = QUANTILES) -> DataFrame:
    """(metric, n, mean, q, value): exact interpolated quantiles of all metrics."""
    return quantiles(df, metrics, points)


def suggested_thresholds(df: DataFrame, metrics: Sequence[tuple[str, str]], survival: float, points: Sequence[float] = QUANTILES) -> DataFrame:
    """(metric, kind, suggested): threshold that lets ``survival`` of the rows pass, interpolated over the quantile points.

    A ``min`` gate wants the quantile 1 - survival, a ``max`` gate survival; ends are clamped.
    """
    table = metric_quantiles(df, [m for m, _ in metrics], points)
    kinds = F.create_map(*(F.lit(x) for pair in metrics for x in pair))
    rows = table.groupBy("metric").agg(F.sort_array(F.collect_list(F.struct("q", "value"))).alias("t"))  # a row for each point
    rows = rows.withColumn("kind", kinds[F.col("metric")]).withColumn("want", F.when(F.col("kind") == "min", F.lit(1.0 - survival)).otherwise(F.lit(survival)))
    low = F.element_at(F.filter("t", lambda x: x["q"] <= F.col("want")), -1)
    low = F.when(F.exists("t", lambda x: x["q"] <= F.col("want")), low)
    high = F.when(F.exists("t", lambda x: x["q"] >= F.col("want")), F.get(F.filter("t", lambda x: x["q"] >= F.col("want")), 0))
    rows = rows.withColumns({"lo": low, "hi": high})
    a, b = F.col("lo"), F.col("hi")
    value = F.when(a.isNull(), b["value"]).when(b.isNull(), a["value"]).when(b["q"] <= a["q"], a["value"])
    value = value.otherwise(a["value"] + (b["value"] - a["value"]) * (F.col("want") - a["q"]) / (b["q"] - a["q"]))
    return rows.select("metric", "kind", value.alias("suggested"))


def nearest_rank(df: DataFrame, score: str, fraction: float) -> DataFrame:
    """(n, cut): the value of rank min(n - 1, int(fraction * n)) in ascending order."""
    counts = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("v")).agg(F.count("*").alias("c"))  # rows of one score are one row
    placed = numbered(counts, [F.asc("v")], "r", weight=F.col("c")).crossJoin(F.broadcast(counts.agg(F.sum("c").alias("n"))))
    want = F.least(F.col("n") - 1, F.floor(F.lit(float(fraction)) * F.col("n")))
    return placed.where((F.col("r") <= want) & (want < F.col("r") + F.col("c"))).select("n", F.col("v").alias("cut"))


def survival(df: DataFrame, gate: Column) -> DataFrame:
    """(total, survived, ratio); the ratio of no rows is 0."""
    out = df.agg(F.count("*").alias("total"), F.count_if(gate).alias("survived"))
    return out.withColumn("ratio", F.col("survived") / F.greatest("total", F.lit(1)))


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """(n, r, mean_diff) over the pairs of which neither is null."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.agg(F.count("*").alias("n"), F.corr(a, b).alias("r"), F.avg(F.col(a) - F.col(b)).alias("mean_diff"))


def label_cost(labels: DataFrame, clips: DataFrame, failed_tasks: DataFrame | None = None) -> DataFrame:
    """One row of counts, tokens and cost; a missing or zero duration counts as the default."""
    rows = labels.join(clips.select("clip_id", "duration_s"), "clip_id", "left")
    ok = F.col("s4_status") == "ok"
    seconds = F.when(ok, F.coalesce(F.nullif("duration_s", F.lit(0.0)), F.lit(DEFAULT_SECONDS)))
    out = rows.agg(
        F.count_if(ok).alias("labels_ok"), F.count_if(~ok).alias("labels_failed"),
        F.count_if(~ok & is_rate_limit(F.col("error"))).alias("__limited"), F.coalesce(F.sum(seconds), F.lit(0.0)).alias("__s"),
    )
    if failed_tasks is not None:
        out = out.crossJoin(F.broadcast(failed_tasks.agg(F.count_if(is_rate_limit(F.col("error"))).alias("__more"))))
    else:
        out = out.withColumn("__more", F.lit(0))
    limited, n = F.col("__limited") + F.col("__more"), F.col("labels_ok") + F.col("labels_failed")
    tokens_in = F.col("__s") * AUDIO_TOKENS_PER_S + F.col("labels_ok") * TEXT_TOKENS
    tokens_out = F.col("labels_ok") * OUTPUT_TOKENS
    return out.select(
        "labels_ok", "labels_failed", limited.alias("rate_limit_failures"),
        F.round(F.when(n > 0, limited / n).otherwise(0.0), 4).alias("rate_limit_rate"),
        F.round(tokens_in, 1).alias("est_input_tokens"), F.round(tokens_out, 1).alias("est_output_tokens"),
        F.round(tokens_in / 1000.0 * USD_PER_1K_INPUT + tokens_out / 1000.0 * USD_PER_1K_OUTPUT, 4).alias("est_cost_usd"),
    )


def tier_counts(df: DataFrame, tiers: Sequence[str], column: str = "tier") -> DataFrame:
    """(tier, n) for every named tier, 0 where it has no row."""
    wanted = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, tiers))).alias("tier"))
    counts = df.groupBy(F.col(column).alias("__t")).agg(F.count("*").alias("n"))
    return wanted.join(counts, F.col("tier") == F.col("__t"), "left").select("tier", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def markdown_table(df: DataFrame, limit: int = 1000, digits: str = ".3g") -> str:
    """A small result as a Markdown table; it must have ``limit`` rows at most. ``digits`` is the format of numbers that aren't whole (``g`` for six digits)."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report has {limit} rows at most")
    show = lambda v: "" if v is None else f"{v:{digits}}" if isinstance(v, float) else str(v)
    lines = [df.columns, ["---"] * len(df.columns), *([show(v) for v in r] for r in rows)]
    return "\n".join("| " + " | ".join(x) + " |" for x in lines) + "\n"
