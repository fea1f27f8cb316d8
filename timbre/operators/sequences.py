"""Operators on ordered sequences: runs, gaps, windows, peaks, cosines and the purity verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timbre.config import PurityRule


def runs(df: DataFrame, by: Sequence[str], index: str, hit: Column) -> DataFrame:
    """(by, run_start, run_end, run_len) of maximal runs of consecutive indexes where ``hit`` holds."""
    w = Window.partitionBy(*by).orderBy(index)
    islands = df.where(hit).withColumn("__island", F.col(index) - F.row_number().over(w))
    out = islands.groupBy(*by, "__island").agg(F.min(index).alias("run_start"), F.max(index).alias("run_end"))
    return out.drop("__island").withColumn("run_len", F.col("run_end") - F.col("run_start") + 1)


def longest_run(df: DataFrame, by: Sequence[str], index: str, hit: Column) -> DataFrame:
    """The longest run of each group, the first of several."""
    found = runs(df, by, index, hit)
    best = F.max_by(F.struct("run_start", "run_end", "run_len"), F.struct(F.col("run_len"), -F.col("run_start")))
    return found.groupBy(*by).agg(best.alias("r")).select(*by, "r.run_start", "r.run_end", "r.run_len")


def pauses(df: DataFrame, by: Sequence[str], start: str, end: str, least: float) -> DataFrame:
    """(by, pause_count, pause_total_ms, speech_s): gaps between consecutive spans of ``least`` seconds or more."""
    gap = F.lead(start).over(Window.partitionBy(*by).orderBy(start, end)) - F.col(end)
    held = F.col("__gap") >= least
    return df.withColumn("__gap", gap).groupBy(*by).agg(
        F.count_if(held).alias("pause_count"),
        F.coalesce(F.sum(F.when(held, F.col("__gap") * 1000.0)), F.lit(0.0)).alias("pause_total_ms"),
        F.sum(F.greatest(F.col(end) - F.col(start), F.lit(0.0))).alias("speech_s"),
    )


def semitones(hz: Column, reference: float = 55.0) -> Column:
    return F.lit(12.0) * F.log2(F.greatest(hz, F.lit(1e-9)) / F.lit(reference))


def pitch_stats(df: DataFrame, by: Sequence[str], index: str, hz: str, jump: float = 6.0) -> DataFrame:
    """(by, f0_mean_hz, f0_std_st, f0_range_st, voiced_ratio, jump_rate, f0_tracker_confidence); 0 is unvoiced.

    Jumps are counted over neighbouring frames that are both voiced.
    """
    f, voiced = F.col(hz), F.col(hz) > 0
    before = F.lag(hz).over(Window.partitionBy(*by).orderBy(index))
    out = df.withColumns({"__st": F.when(voiced, semitones(f)), "__pair": voiced & F.coalesce(before > 0, F.lit(False)), "__step": F.abs(semitones(f) - semitones(before))})
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = out.groupBy(*by).agg(
        zero(F.avg(F.when(voiced, f))).alias("f0_mean_hz"),
        zero(F.stddev_pop("__st")).alias("f0_std_st"),
        F.percentile("__st", F.array(F.lit(0.05), F.lit(0.95))).alias("__p"),
        (F.count_if(voiced) / F.count("*")).alias("voiced_ratio"),
        F.coalesce(F.count_if(F.col("__pair") & (F.col("__step") > jump)) / F.nullif(F.count_if("__pair"), F.lit(0)), F.lit(0.0)).alias("jump_rate"),
    )
    out = out.withColumn("f0_range_st", zero(F.col("__p")[1] - F.col("__p")[0])).drop("__p")
    return out.withColumn("f0_tracker_confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("voiced_ratio") * (1 - F.col("jump_rate")))))


def rate_variation(df: DataFrame, by: Sequence[str], index: str, value: str, width: int) -> DataFrame:
    """(by, n_windows, rate_var_cv): deviation over mean of sums of whole windows of ``width`` frames.

    Less than two windows, none included, give 0.
    """
    whole = df.groupBy(*by).agg(F.count("*").alias("__n"))
    framed = df.join(whole, list(by)).withColumn("__w", F.floor(F.col(index) / width)).where((F.col("__w") + 1) * width <= F.col("__n"))
    sums = framed.groupBy(*by, "__w").agg(F.sum(value).alias("__v"))
    return variation(whole.select(*by), sums, by)


def variation(groups: DataFrame, windows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, n_windows, rate_var_cv) of the windows' values ``__v``; groups without windows have 0."""
    out = windows.groupBy(*by).agg(F.count("*").alias("n_windows"), F.avg("__v").alias("__m"), F.stddev_pop("__v").alias("__s"))
    cv = F.when((F.col("n_windows") < 2) | (F.col("__m") <= 0), 0.0).otherwise(F.col("__s") / F.col("__m"))
    out = groups.join(out.withColumn("rate_var_cv", cv), list(by), "left")
    return out.select(*by, F.coalesce("n_windows", F.lit(0)).alias("n_windows"), F.coalesce("rate_var_cv", F.lit(0.0)).alias("rate_var_cv"))


def sliding_windows(df: DataFrame, duration: str, window: float, overlap: float) -> DataFrame:
    """A row per window: window_no, start_s, end_s. The last partial one stays if it has half a window; short ones have one."""
    hop = window * (1.0 - overlap)
    total = F.coalesce(F.col(duration), F.lit(0.0))
    last = F.greatest(F.lit(0), F.ceil(total / F.lit(hop)) - 1)
    out = df.withColumn("window_no", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    start = F.col("window_no") * F.lit(hop)
    out = out.withColumns({"start_s": start, "end_s": F.least(start + F.lit(window), total)})
    whole = F.col("end_s") - F.col("start_s") >= F.lit(window / 2)
    return out.where((F.col("window_no") == 0) | whole)


def framed_powers(df: DataFrame, by: Sequence[str], index: str, value: str, length: int) -> DataFrame:
    """(by, frame_no, power): mean square of whole frames that don't overlap."""
    n = F.count("*").over(Window.partitionBy(*by))
    frames = df.withColumns({"frame_no": F.floor(F.col(index) / length), "__n": n}).where((F.col("frame_no") + 1) * length <= F.col("__n"))
    return frames.groupBy(*by, "frame_no").agg(F.avg(F.col(value) * F.col(value)).alias("power"))


def overlapping_frames(df: DataFrame, by: Sequence[str], index: str, value: str, length: int, hop: int) -> DataFrame:
    """(by, frame_no, rms): effective value of whole frames of ``length`` every ``hop``; a group shorter than one is one frame.

    A row goes to each frame that covers it, ``length / hop`` of them at most.
    """
    whole = df.groupBy(*by).agg(F.count("*").alias("__n"))
    last = F.greatest(F.lit(0), F.floor((F.col("__n") - length) / hop))
    first = F.greatest(F.lit(0), F.floor((F.col(index) - length) / hop) + 1)
    rows = df.join(whole, list(by)).withColumns({"__a": first.cast("long"), "__b": F.least(last, F.floor(F.col(index) / hop)).cast("long")}).where(F.col("__a") <= F.col("__b"))
    frames = rows.withColumn("frame_no", F.explode(F.sequence("__a", "__b")))
    return frames.groupBy(*by, "frame_no").agg(F.sqrt(F.avg(F.col(value) * F.col(value)) + F.lit(1e-12)).alias("rms"))


def blind_snr(powers: DataFrame, by: Sequence[str], eps: float = 1e-10) -> DataFrame:
    """(by, snr_db): 10 log10 of (p95 - p10) / p10 of frame powers, between -20 and 100."""
    out = powers.groupBy(*by).agg(F.percentile("power", F.array(F.lit(0.10), F.lit(0.95))).alias("p"))
    noise = F.greatest(F.col("p")[0], F.lit(eps))
    ratio = F.greatest(F.col("p")[1] - noise, F.lit(eps)) / noise  # silence is noise as loud as the signal: 0 dB
    return out.select(*by, F.greatest(F.lit(-20.0), F.least(F.lit(100.0), 10 * F.log10(ratio))).alias("snr_db"))


def energy_deviation(df: DataFrame, by: Sequence[str], rms: str, floor: float = 1e-3) -> DataFrame:
    """(by, energy_std_db): deviation in dB of the frames above a share of the peak; 0 with less than two."""
    peak = F.max(rms).over(Window.partitionBy(*by))
    kept = df.withColumn("__peak", peak)
    db = F.when(F.col(rms) >= F.col("__peak") * F.lit(floor), 20 * F.log10(F.col(rms) + F.lit(1e-12)))
    return kept.groupBy(*by).agg(F.when(F.count(db) < 2, 0.0).otherwise(F.stddev_pop(db)).alias("energy_std_db"))


#: Places of an array that are folded together.
BLOCK = 1024


def greedy_peaks(values: Column, least: Column | float, apart: int) -> Column:
    """Indexes of local maxima of an array, ``least`` or more, each ``apart`` or more after the last one taken.

    What lies outside the array is below everything, so its ends can be maxima.
    The choice is stateful: a fold over the maxima, in blocks that pass on the last
    one taken, so that no step copies more than a block's choice.
    """
    beside = lambda i: F.coalesce(F.when(i >= 0, F.get(values, i)), F.lit(float("-inf")))
    fits = lambda i: (F.get(values, i) >= beside(i - 1)) & (F.get(values, i) >= beside(i + 1)) & (F.get(values, i) >= least)
    none = F.array().cast("array<int>")
    state = lambda last, kept: F.struct(last.alias("last"), kept.alias("kept"))
    take = lambda acc, i: F.when(i - acc["last"] >= apart, state(i, F.concat(acc["kept"], F.array(i)))).otherwise(acc)
    # blocks of places; the maxima in a block are those of its stretch of values
    cuts = F.sequence(F.lit(0), F.size(values) - 1, F.lit(BLOCK))
    inside = lambda at: F.filter(F.sequence(at, F.least(at + BLOCK, F.size(values)) - 1), fits)
    block = lambda last, at: F.aggregate(inside(at), state(last, none), take)

    def add(acc: Column, at: Column) -> Column:
        # the block is folded once: an array of its one outcome
        outcome = F.transform(F.array(block(acc["last"], at)), lambda o: F.struct(o["last"].alias("last"), F.concat(acc["kept"], F.array(o["kept"])).alias("kept")))
        return outcome[0]

    start = F.struct(F.lit(-apart).alias("last"), F.array().cast("array<array<int>>").alias("kept"))
    folded = F.flatten(F.aggregate(cuts, start, add)["kept"])
    return F.when(F.size(values) >= 1, folded).otherwise(none)


def peak_rate_variation(df: DataFrame, by: Sequence[str], index: str, value: str, width: int, apart: int) -> DataFrame:
    """(by, n_windows, rate_var_cv): deviation over mean of the peaks of whole windows of ``width`` frames.

    A peak is at or above the median of the group. Less than two windows, or no
    peak at all, give 0.
    """
    whole = df.groupBy(*by).agg(F.count("*").alias("__n"), F.percentile(value, F.lit(0.5)).alias("__least"))
    framed = df.join(whole, list(by)).withColumn("__w", F.floor(F.col(index) / width)).where((F.col("__w") + 1) * width <= F.col("__n"))
    windows = framed.groupBy(*by, "__w").agg(F.sort_array(F.collect_list(F.struct(index, value))).alias("__v"), F.first("__least").alias("__least"))  # ``width`` rows each
    windows = windows.withColumn("__v", F.transform("__v", lambda x: x[value]))
    peaks = windows.select(*by, F.size(greedy_peaks(F.col("__v"), F.col("__least"), apart)).alias("__p"))
    return variation(whole.select(*by), peaks.withColumnRenamed("__p", "__v"), by)


def window_cosines(df: DataFrame, by: Sequence[str], index: str, embedding: str) -> DataFrame:
    """(by, index, cosine) of each window's vector to its group's mean vector.

    Vectors stay arrays: only the means are worked out by dimension, with partial
    sums, and joined back as one vector for each group.
    """
    means = centroid(df, by, embedding).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("dim", "mean"))).alias("__m"))
    both = df.select(*by, index, F.transform(embedding, lambda x: x.cast("double")).alias("__x")).join(means, list(by)).withColumn("__m", F.transform("__m", lambda x: x["mean"]))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return both.select(*by, index, (dot("__x", "__m") / ((F.sqrt(dot("__x", "__x")) + 1e-8) * (F.sqrt(dot("__m", "__m")) + 1e-8))).alias("cosine"))


def centroid(df: DataFrame, by: Sequence[str], embedding: str) -> DataFrame:
    """(by, dim, mean) of each dimension."""
    cells = df.select(*by, F.posexplode(embedding).alias("dim", "x"))
    return cells.groupBy(*by, "dim").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def embedding_pointers(df: DataFrame, shard: str, order: str) -> DataFrame:
    """Adds emb_file and emb_row: the place of a clip's vector in its shard's file."""
    row = F.row_number().over(Window.partitionBy(shard).orderBy(order)) - 1
    return df.withColumns({"emb_file": F.concat(F.lit("emb-"), F.col(shard), F.lit(".npy")), "emb_row": row.cast("long")})


def fitted_spans(spans: Column, n: Column) -> Column:
    """A list of spans cut to ``n`` items, or its last one repeated."""
    more = F.greatest(n - F.size(spans), F.lit(0))
    return F.when(F.size(spans) == 0, spans).otherwise(F.concat(F.slice(spans, F.lit(1), F.greatest(n, F.lit(0))), F.array_repeat(F.element_at(spans, -1), more)))


def aggregate_windows(df: DataFrame) -> DataFrame:
    """What ``purity`` needs where there is no sequence of windows: a model's own count, mean and least cosine.

    A missing count is 1, a missing mean 1.0, a missing least cosine the mean;
    there are no runs, so nothing is trimmed.
    """
    mean = F.coalesce("mean_win_cos", F.lit(1.0))
    none = {c: F.lit(None).cast(k) for c, k in (("run_start_s", "double"), ("run_end_s", "double"), ("run_first", "long"), ("run_last", "long"))}
    return df.withColumns({"n_windows": F.coalesce("n_windows", F.lit(1)), "mean_win_cos": mean, "min_win_cos": F.coalesce("min_win_cos", mean)} | none)


def purity(df: DataFrame, rule: PurityRule) -> DataFrame:
    """Adds verdict, trimmed, trim_start_s, trim_end_s, trimmed_duration_s and intrusion_span_ms.

    Needs n_windows, mean_win_cos, min_win_cos, f0_tracker_confidence, duration_s
    and the longest low run as run_start_s, run_end_s, run_first, run_last (null
    where there is none or no window sequence).
    """
    low = (F.col("min_win_cos") < rule.min_cosine) & F.col("run_first").isNotNull()
    head, tail = F.col("run_first") == 0, F.col("run_last") == F.col("n_windows") - 1
    part = low & ~(head & tail)
    edge = part & (head | tail)
    begin = F.when(head, F.col("run_end_s")).otherwise(F.lit(0.0))
    end = F.when(head, F.col("duration_s")).otherwise(F.col("run_start_s"))
    enough = edge & (end - begin >= rule.min_residual_s)
    depressed = F.col("mean_win_cos") < rule.mean_cosine
    verdict = (
        F.when(F.col("n_windows") <= 1, "single")
        .when(enough, "intruded_trimmed")
        .when(part, "intruded_rejected")
        .when(depressed & (F.col("f0_tracker_confidence") < rule.poor_confidence), "overlap_rejected")
        .when(depressed | (F.col("min_win_cos") < rule.min_cosine), "degraded_pass")
        .otherwise("single")
    )
    cut = F.col("verdict") == "intruded_trimmed"
    out = df.withColumn("verdict", verdict)
    return out.withColumns({
        "trimmed": cut,
        "trim_start_s": F.when(cut, begin),
        "trim_end_s": F.when(cut, end),
        "trimmed_duration_s": F.when(cut, end - begin),
        "intrusion_span_ms": F.when((F.col("n_windows") > 1) & part, (F.col("run_end_s") - F.col("run_start_s")) * 1000.0),
    })
