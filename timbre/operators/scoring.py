"""Population statistics as one-row aggregates joined back, scores and ranks.

A window over the whole table would send all rows to one task. The statistics
are a single row instead, of fixed size, which is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timbre.config import SelectionRule
from timbre.store import checkpointed

PREFIX = "__stat_"


def with_stats(df: DataFrame, stats: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """``df`` with the aggregates as columns: a broadcast row of all rows, or a row of the group, joined back.

    The aggregates are worked out once and stored: sums of doubles depend on the order in which
    partitions come, so a score made anew for another job could lie beside a cut made from the first.
    """
    named = [c.alias(PREFIX + n) for n, c in stats.items()]
    if not by:
        return df.crossJoin(F.broadcast(checkpointed(df.agg(*named))))  # a single row
    keys = [PREFIX + f"by{i}" for i in range(len(by))]
    groups = checkpointed(df.groupBy(*(F.col(b).alias(k) for b, k in zip(by, keys))).agg(*named))
    match = F.lit(True)
    for b, k in zip(by, keys):
        match = match & F.col(b).eqNullSafe(F.col(k))
    return df.join(groups, match).drop(*keys)


def without_stats(df: DataFrame) -> DataFrame:
    return df.select(*(c for c in df.columns if not c.startswith(PREFIX)))


def zscore_sum(df: DataFrame, weights: Sequence[tuple[str, float]], name: str = "prosody_dsp_score", by: Sequence[str] = ()) -> DataFrame:
    """Adds the weighted sum of z-scores; a constant or missing measure adds 0."""
    stats = {f"{a}_{m}": f(F.col(m)) for m, _ in weights for a, f in (("mean", F.avg), ("dev", F.stddev_pop))}
    out = with_stats(df, stats, by)
    terms = [F.lit(float(w)) * F.coalesce((F.col(m) - F.col(f"{PREFIX}mean_{m}")) / F.nullif(F.col(f"{PREFIX}dev_{m}"), F.lit(0.0)), F.lit(0.0)) for m, w in weights]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return without_stats(out.withColumn(name, total))


def minmax(df: DataFrame, columns: Mapping[str, str], constant: float, missing: float | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Adds (new name: source) scaled to [0, 1]; ``constant`` where all values are equal."""
    value = lambda s: F.col(s) if missing is None else F.coalesce(F.col(s), F.lit(missing))
    out = with_stats(df, {f"{a}_{s}": f(value(s)) for s in set(columns.values()) for a, f in (("min", F.min), ("max", F.max))}, by)
    scaled = {}
    for name, s in columns.items():
        low, high = F.col(f"{PREFIX}min_{s}"), F.col(f"{PREFIX}max_{s}")
        scaled[name] = F.when(high > low, (value(s) - low) / (high - low)).otherwise(F.lit(float(constant)))
    return without_stats(out.withColumns(scaled))


def quantiles(df: DataFrame, metrics: Sequence[str], points: Sequence[float]) -> DataFrame:
    """(metric, n, mean, q, value): exact interpolated quantiles of the values that aren't null.

    Values are counted first (partial sums before the exchange), then numbered in
    one range order of (metric, value); only the values at the wanted places go
    on, so no task holds all values of a metric. A metric without values has null
    quantiles.
    """
    spark = df.sparkSession
    cells = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics)))
    counted = df.select(cells.alias("c")).select("c.metric", "c.v").where("v is not null").groupBy("metric", "v").agg(F.count("*").alias("c"))
    placed = checkpointed(numbered(counted, [F.col("metric"), F.col("v")], "before", weight=F.col("c"), by=["metric"]))
    wanted = spark.createDataFrame([(m, float(p)) for m in metrics for p in points], "metric string, q double")
    sums = wanted.select("metric").distinct().join(placed.groupBy("metric").agg(F.sum("c").alias("n"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean")), "metric", "left")
    at = wanted.join(F.broadcast(sums), "metric").withColumn("at", F.col("q") * (F.coalesce("n", F.lit(0)) - 1))
    at = at.select("metric", "q", F.coalesce("n", F.lit(0)).alias("n"), "mean", "at", F.floor("at").alias("lo"), F.ceil("at").alias("hi"))
    hits = placed.join(F.broadcast(at.select(F.col("metric").alias("m"), "q", "lo", "hi")), (F.col("metric") == F.col("m")) & (F.col("before") <= F.col("hi")) & (F.col("before") + F.col("c") > F.col("lo")))
    low = F.max(F.when((F.col("before") <= F.col("lo")) & (F.col("before") + F.col("c") > F.col("lo")), F.col("v")))
    high = F.max(F.when((F.col("before") <= F.col("hi")) & (F.col("before") + F.col("c") > F.col("hi")), F.col("v")))
    ends = hits.groupBy(F.col("m"), F.col("q").alias("hq")).agg(low.alias("a"), high.alias("b"))
    out = at.join(ends, (F.col("metric") == F.col("m")) & (F.col("q") == F.col("hq")), "left")
    # between equal values this is that value to the last bit, so that rows tied at a cut aren't lost
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.col("lo")))
    return out.select("metric", "n", "mean", "q", value.alias("value"))


def quantile_cut(df: DataFrame, score: str, keep: float, among: Column | None = None, name: str = "score_cut") -> DataFrame:
    """Adds the interpolated quantile above which the fraction ``keep`` of ``among`` lies."""
    q = max(0.0, min(1.0, 1.0 - keep))
    rows = (df if among is None else df.where(among)).select(F.col(score).alias("score"))
    return df.crossJoin(F.broadcast(quantiles(rows, ["score"], [q]).select(F.col("value").alias(name))))


def top_fraction(df: DataFrame, score: str, keep: float) -> DataFrame:
    """Rows at or above the quantile cut."""
    return quantile_cut(df, score, keep, name=PREFIX + "cut").where(F.col(score) >= F.col(PREFIX + "cut")).drop(PREFIX + "cut")


def numbered(df: DataFrame, order: Sequence[Column], name: str, weight: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Adds the number of rows (or the sum of ``weight``) before each row in ``order``, which must be total.

    Rows are range-partitioned by the order once and stored with their place, so
    that the numbers inside the partitions and the partitions' own sizes are of
    the same split. With ``by``, the first columns of the order, numbers start
    anew in each group; a group may span partitions.
    """
    nth, part, own = PREFIX + "nth", PREFIX + "part", PREFIX + "own"
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(nth, F.monotonically_increasing_id())
    spread = checkpointed(spread.withColumn(own, F.lit(1) if weight is None else weight))
    spread = spread.withColumn(part, F.shiftright(nth, 33))
    # a row for each partition, and for each group that shares one
    sizes = spread.groupBy(part, *by).agg(F.sum(own).alias("n"), F.min(nth).alias("least"))
    groups = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = F.sum("n").over(groups.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    keys = [PREFIX + "k%d" % i for i in range(len(by))]
    sizes = sizes.select(F.col(part).alias(PREFIX + "p"), *(F.col(b).alias(k) for b, k in zip(by, keys)), F.coalesce(before, F.lit(0)).alias(PREFIX + "before"), F.col("least").alias(PREFIX + "least"))
    match = F.col(part) == F.col(PREFIX + "p")
    for b, k in zip(by, keys):
        match = match & F.col(b).eqNullSafe(F.col(k))
    out = spread.join(sizes, match)
    if weight is None:
        inside = F.col(nth) - F.col(PREFIX + "least")
    else:
        inside = F.coalesce(F.sum(own).over(Window.partitionBy(part, *by).orderBy(nth).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return without_stats(out.withColumn(name, (F.col(PREFIX + "before") + inside).cast("long")))


def ranked(df: DataFrame, order: Sequence[Column], name: str = "priority_rank") -> DataFrame:
    """Adds the 0-based rank by ``order``, which must be total."""
    return numbered(df, order, name)


def with_labels(df: DataFrame, labels: DataFrame | None, kind: T.StructType, key: str = "clip_id") -> DataFrame:
    """``df`` with the columns of ``labels`` by ``key``; nulls of the same types where there is no such table."""
    if labels is not None:
        return df.join(labels, key, "left")
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in kind.fields if f.name != key})


def expression_strength(expressiveness: Column, intensity: Column) -> Column:
    return F.coalesce(expressiveness * intensity, F.lit(0)).cast("double")


def selection_scores(df: DataFrame, rule: SelectionRule) -> DataFrame:
    """Adds selection_score: four measures scaled over the candidates and weighted."""
    out = df.withColumn("expr_intensity", expression_strength(F.col("prosody_expressiveness"), F.col("emotion_intensity")))
    names = {"n_pq": "aes_pq", "n_prosody": "prosody_dsp_score", "n_expr": "expr_intensity", "n_ce": "aes_ce"}
    out = minmax(out, names, constant=0.0, missing=0.0)
    score = F.lit(rule.w_quality) * F.col("n_pq") + F.lit(rule.w_prosody) * F.col("n_prosody") + F.lit(rule.w_expression) * F.col("n_expr") + F.lit(rule.w_enjoyment) * F.col("n_ce")
    return out.withColumn("selection_score", score).drop(*names)


def assign_tiers(df: DataFrame, rule: SelectionRule, key: str = "clip_id") -> DataFrame:
    """Adds tier: S for the top scores of strong emotion, B for plain ones, else A."""
    out = ranked(df, [F.desc("selection_score"), F.asc(key)], "__tier_rank")
    out = out.crossJoin(F.broadcast(df.agg(F.count("*").alias(PREFIX + "n"))))
    top = F.col("__tier_rank") < F.greatest(F.lit(1), F.ceil(F.col(PREFIX + "n") * F.lit(rule.top_fraction)))
    strong = ~F.coalesce("emotion_primary", F.lit("")).isin(*rule.plain_emotions) & (F.coalesce("emotion_intensity", F.lit(0)) >= rule.min_intensity)
    plain = F.coalesce("prosody_expressiveness", F.lit(0)) <= rule.max_plain_expressiveness
    return without_stats(out.withColumn("tier", F.when(top & strong, "S").when(plain, "B").otherwise("A"))).drop("__tier_rank")
