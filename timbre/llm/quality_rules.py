"""Quality rules: word statistics and a hashed n-gram log-likelihood ratio.

Every document gets the mean log-likelihood ratio of its hashed n-grams (the last
three characters of each word, and pairs of words) between two multinomials, one
of trusted documents and one of the whole corpus. There are some ten thousand word
ends in a corpus of any size, so those of random strings stay rare, where whole
words would share their buckets with too many others to tell. Documents that fail the word rules, or whose ratio is below a fixed
threshold, aren't kept. All of it is built from DataFrame functions.

Edge cases: a null or empty text has no words and fails the word rules; a
repeated row is judged like any other; an empty table gives an empty result;
a null ``doc_id`` is judged but can't be trusted. Other columns never clash:
the row travels in one struct. Without any trusted document all weights are 0,
so only the word rules decide.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbre.llm.common import SPACE_CHARS, SPACE_CLASS


@dataclass(frozen=True)
class RatioRule:
    """Parameters of the ratio.

    buckets: hash buckets of word ends and of pairs of words.
    word_end: characters of a word's end; shorter words count whole.
    trusted_rows: bound on the labelled rows that the trusted multinomial is
        fitted on (those of the smallest id hash); corpus counts have no bound.
    smoothing: n-grams that each bucket of word ends and of pairs is taken to hold
        besides in the corpus, and as many at the corpus rate in the trusted
        texts. Most pairs are new in a small corpus, so theirs is greater.
    threshold: least mean log ratio per n-gram (nats) of a kept document.
    """

    buckets: tuple[int, int] = (1 << 16, 1 << 15)
    word_end: int = 3
    trusted_rows: int = 20000
    smoothing: tuple[float, float] = (1.0, 16.0)
    threshold: float = -0.2
    min_words: int = 50
    max_repeat_percent: int = 50


def words_of(text: Column) -> Column:
    """Words between ASCII white space; an empty array if there is none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))


def ngram_buckets(words: Column, count: Column, rule: RatioRule) -> Column:
    """Bucket of each word's end, then of each pair of words, which are behind those of ends."""
    buckets = rule.buckets
    # the remainder by a power of two is its lowest bits, which are cheaper
    fold = lambda n, *c: (F.xxhash64(*c).bitwiseAND(F.lit(n - 1)) if n & (n - 1) == 0 else F.pmod(F.xxhash64(*c), F.lit(n))).cast("int")
    empty = F.array().cast("array<int>")
    one = F.transform(words, lambda w: fold(buckets[0], F.substring(w, -rule.word_end, rule.word_end)))
    two = F.when(count > 1, F.transform(F.sequence(F.lit(1), count - 1), lambda i: fold(buckets[1], F.get(words, i - 1), F.get(words, i)) + F.lit(buckets[0])))
    return F.concat(one, F.coalesce(two, empty))


def trusted_ids(labels: DataFrame, rule: RatioRule) -> DataFrame:
    """At most ``rule.trusted_rows`` ids of documents that every label calls good."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("__q"))
    good = good.where("__q = 1").select("doc_id")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rule.trusted_rows)


def ratio_weights(docs: DataFrame, labels: DataFrame, rule: RatioRule) -> DataFrame:
    """One row, one array: the log ratio of each bucket in thousandths, in bucket order.

    Counts come from one pass over all documents; its aggregate has a row for
    each bucket at most, so its size doesn't grow with the corpus.
    """
    good = F.broadcast(trusted_ids(labels, rule).select(F.col("doc_id").alias("__good")))
    bags = docs.select(F.col("doc_id").alias("__id"), words_of(F.col("text")).alias("__w"))
    bags = bags.join(good, F.col("__id") == F.col("__good"), "left")
    bags = bags.select(F.explode(ngram_buckets(F.col("__w"), F.size("__w"), rule)).alias("b"), F.col("__good").isNotNull().cast("long").alias("t"))
    counts = bags.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("good"))
    cells = docs.sparkSession.range(sum(rule.buckets)).select(F.col("id").cast("int").alias("b"))
    cells = cells.join(counts, "b", "left").select("b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good"))
    word = F.col("b") < rule.buckets[0]  # else a pair
    total = lambda c, order: F.sum(F.when(order, F.col(c)))
    packed = cells.agg(
        F.sort_array(F.collect_list(F.struct("b", "raw", "good"))).alias("c"), F.sum("good").alias("n_good"),
        (total("raw", word) / total("good", word)).alias("scale1"), (total("raw", ~word) / total("good", ~word)).alias("scale2"),
    )
    # corpus: (raw + s) / (N + s * B); trusted: (good + s * n / N) / (n + s * B * n / N); n and N cancel but for the scale N / n
    one, two = (F.lit(x) for x in rule.smoothing)
    ratio = lambda x, scale, s: F.log((x["good"] * F.coalesce(scale, F.lit(0.0)) + s) / (x["raw"] + s))
    weight = F.transform("c", lambda x: F.when(x["b"] < rule.buckets[0], ratio(x, F.col("scale1"), one)).otherwise(ratio(x, F.col("scale2"), two)))
    # thousandths in 2 bytes a bucket: the array is copied for every document that it is joined with
    whole = F.transform(weight, lambda x: F.round(F.greatest(F.lit(-32.0), F.least(F.lit(32.0), x)) * 1000).cast("short"))
    return packed.select(F.when(F.col("n_good") > 0, whole).otherwise(F.array_repeat(F.lit(0).cast("short"), sum(rule.buckets))).alias("weights"))


def judged(docs: DataFrame, labels: DataFrame, rule: RatioRule = RatioRule()) -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct) with the statistics and the verdict."""
    weights = F.broadcast(ratio_weights(docs, labels, rule))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    out = out.select("row", words_of(F.col("row.text")).alias("w"))
    out = out.select("row", "w", F.size("w").alias("n"))
    w, n = F.col("w"), F.col("n")
    # (hash, position) of each 3-word window, only where some window repeats
    windows = F.when(n > 2, F.transform(F.sequence(F.lit(2), n - 1), lambda i: F.xxhash64(F.get(w, i - 2), F.get(w, i - 1), F.get(w, i))))
    out = out.select("row", "w", "n", windows.alias("h"))
    h = F.col("h")
    pairs = F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))))
    out = out.select("row", "w", "n", pairs.alias("pairs"))
    same = lambda x, i, d: F.get(F.col("pairs"), i + d)["h"] == x["h"]
    hits = F.filter("pairs", lambda x, i: F.coalesce(same(x, i, 1), F.lit(False)) | F.coalesce(F.when(i > 0, same(x, i, -1)), F.lit(False)))
    out = out.select("row", "w", "n", F.array_sort(F.transform(hits, lambda x: x["p"])).alias("hit"))
    hit = F.col("hit")
    covered = F.aggregate(F.transform(hit, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(hit, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    out = out.select(
        "row", "w", "n", F.coalesce(covered.cast("long"), F.lit(0).cast("long")).alias("n_repeat_words"),
        F.length(F.regexp_replace(text, f"{SPACE_CLASS}+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"), lines.alias("lines"),
    )
    grams = ngram_buckets(w, n, rule)
    out = out.select("row", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words", grams.alias("grams"))
    out = out.crossJoin(weights)  # one row of fixed size
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda a, b: a + F.get(F.col("weights"), b)) / 1000.0
    out = out.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (total / F.greatest(F.size("grams"), F.lit(1))).alias("mean_ratio"))
    failed = (F.col("n_words") < rule.min_words) | (100 * F.col("n_repeat_words") > rule.max_repeat_percent * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.round("mean_ratio", 9) >= rule.threshold))


def quality_report(docs: DataFrame, labels: DataFrame, rule: RatioRule = RatioRule()) -> DataFrame:
    """One row per document: the statistics, the ratio and the verdict."""
    return judged(docs, labels, rule).select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "mean_ratio")


def keep_good(docs: DataFrame, labels: DataFrame, rule: RatioRule = RatioRule()) -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep them, columns unchanged.

    The row number keeps the optimizer from moving the filter below the steps
    that work the verdict out, where each of them would be repeated in it.
    """
    return judged(docs, labels, rule).withColumn("nth", F.monotonically_increasing_id()).where("kept and nth >= 0").select("row.*")
