"""Statistics of arriving parts as state that merges: a part is read once, whatever arrives after it.

The state of a part and a metric is its count, mean, sum of squared deviations,
least and greatest value, the rows that a gate kills, and a sketch of its values.
All but the sketch merge without loss, in any order; so z-scores, min-max scales
and kill rates over any set of finished parts are those of all their rows. The
sketch (KLL, k values a level) merges too; a quantile's rank is off by less than
``RANK_ERROR`` with a probability of 99 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timbre.operators.gates import fails
from timbre.sources.tables import read_stage

SKETCH_K, RANK_ERROR = 400, 0.01
STATE = "part string, metric string, n bigint, mean double, m2 double, low double, high double, killed bigint, sketch binary"


def part_states(df: DataFrame, part: str, metrics: Sequence[str], limits: Sequence[tuple[str, str, float]] = ()) -> DataFrame:
    """A row for each part and metric; ``limits`` (column, sign, value) count what a gate on that metric kills. Nulls don't count."""
    gate = {name: fails(name, sign, value) for name, sign, value in limits}
    cells = []
    for m in metrics:
        v = F.col(m).cast("double")
        cells.append(F.struct(F.lit(m).alias("metric"), v.alias("v"), (gate[m] if m in gate else F.lit(False)).alias("killed")))
    rows = df.select(F.col(part).cast("string").alias("part"), F.explode(F.array(*cells)).alias("c")).select("part", "c.*")
    out = rows.groupBy("part", "metric").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.count_if("killed").alias("killed"), F.kll_sketch_agg_double("v", F.lit(SKETCH_K)).alias("sketch"),
    )
    return out


def add_parts(states: DataFrame, path: str) -> None:
    """Writes the states of their parts; a part that is written again replaces its state and no other."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_states(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The states of all parts, or of the named ones (those with a done marker, or a prefix of them)."""
    rows = spark.read.schema(STATE).parquet(path)
    return rows if parts is None else rows.where(F.col("part").isin(*parts))


def merged(states: DataFrame, by: Sequence[str] = ("metric",)) -> DataFrame:
    """(by, n, mean, m2, low, high, killed, sketch) of the states' rows together."""
    whole = states.groupBy(*by).agg(F.sum("n").alias("__n"), (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("__mean"))
    both = states.join(F.broadcast(whole), list(by))  # a row for each metric
    return both.groupBy(*by).agg(
        F.max("__n").alias("n"), F.max("__mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("__mean")) * (F.col("mean") - F.col("__mean"))).alias("m2"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("killed").alias("killed"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def prefixes(states: DataFrame) -> DataFrame:
    """(upto, metric, n, mean, std, low, high, killed) after each part in the order of their names: of all parts up to it.

    Counts and sums run over a row for each part and metric, so the rows of a
    part are never read again. Sums of squares are taken about the mean of all
    parts, which keeps them small.
    """
    center = states.groupBy("metric").agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("__c"))
    rows = states.join(F.broadcast(center), "metric")
    w = Window.partitionBy("metric").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    off = F.col("mean") - F.col("__c")
    rows = rows.withColumns({"__n": F.sum("n").over(w), "__s": F.sum(F.col("n") * off).over(w), "__q": F.sum(F.col("m2") + F.col("n") * off * off).over(w)})
    shift = F.col("__s") / F.nullif(F.col("__n"), F.lit(0))
    std = F.when(F.col("__n") > 0, F.sqrt(F.greatest(F.lit(0.0), F.col("__q") / F.col("__n") - shift * shift)))
    return rows.select(F.col("part").alias("upto"), "metric", F.col("__n").alias("n"), (F.col("__c") + shift).alias("mean"), std.alias("std"), F.min("low").over(w).alias("low"), F.max("high").over(w).alias("high"), F.sum("killed").over(w).alias("killed"))


def summary(whole: DataFrame, points: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """(metric, n, mean, std, low, high, killed, quantiles) of merged states."""
    std = F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0)))
    quantiles = F.when(F.col("n") > 0, F.array(*(F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in points)))
    return whole.select("metric", "n", "mean", std.alias("std"), "low", "high", "killed", quantiles.alias("quantiles"))


def scored(df: DataFrame, whole: DataFrame, weights: Sequence[tuple[str, float]], name: str = "score") -> DataFrame:
    """Adds the weighted sum of z-scores by the merged statistics: a constant or unknown metric and a null value count 0."""
    stats = {m: F.struct("n", "mean", F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0))).alias("std")) for m, _ in weights}
    one = whole.agg(*(F.max(F.when(F.col("metric") == m, s)).alias(f"__{m}") for m, s in stats.items()))
    z = lambda m: F.coalesce((F.col(m) - F.col(f"__{m}.mean")) / F.nullif(F.col(f"__{m}.std"), F.lit(0.0)), F.lit(0.0))
    total: Column = F.lit(0.0)
    for m, w in weights:
        total = total + F.lit(float(w)) * z(m)
    return df.crossJoin(F.broadcast(one)).withColumn(name, total).drop(*(f"__{m}" for m, _ in weights))


def pending_parts(spark: SparkSession, source: str, path: str, part: str) -> DataFrame:
    """(part) of the parts of a stage table that have no state yet."""
    have = read_states(spark, path).select("part").distinct()
    return read_stage(spark, source).select(F.col(part).cast("string").alias("part")).distinct().join(have, "part", "left_anti")
