"""Mixing sources to target weights: Pfair windows, earliest deadline first.

Source i with weight w gets block j (0-based) a release floor(j / w) and a
deadline ceil((j + 1) / w), in slots of one block. Weights are rounded to
multiples of 1 / frame by largest remainder; the frame is the least power of two
of ``MixRule.frame`` or more in which the least weight is a slot, so a weight
moves by less than a slot of a frame, however many sources there are. The
earliest-deadline-first schedule repeats every frame; one frame of it is worked
out by a fold over its slots (sources times slots steps), and each block finds
its slot by its number. At every slot each source is less than one block off its
rounded weight, until the first source runs out; the others then go on in the
same order, and no document is dropped or repeated. All of it is built from
DataFrame functions.

A block is ``block_rows`` documents of one source, in the order of a hash of
their id. Ranks in a source are summed over hash ranges of bounded size, so that
a source of a third of all rows isn't ranked by one task.

Edge cases: a null source is the source ``''``; a null ``doc_id`` is hashed by
its whole row; rows alike in all columns are interchangeable and keep a slot
each; text may be anything and of any length, it isn't read; ties of hashes go
by id, then by the hash of the row; an empty table gives an empty result. Other
columns travel in a struct.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timbre.llm.common import checkpointed, spread_join

#: Rows of one hash range of a source, about.
RANGE_ROWS = 4_096
#: Rows of a table of sources or slots that is broadcast; a greater one is joined by an exchange.
SENT_ROWS = 1 << 20
#: Slots whose rows are ordered together; a power of two, as frames are.
LOT = 512
#: Slots of a frame that one step of the outer fold works out.
CHUNK = 256


@dataclass(frozen=True)
class MixRule:
    """frame: least slots after which the schedule repeats, the unit of weights.

    weights: source -> relative weight; None: the number of its documents to the
    power ``exponent``. A source that isn't named gets the least weight.
    """

    frame: int = 1024
    block_rows: int = 8
    exponent: float = 0.5
    weights: Mapping[str, float] | None = None


def weighted(counts: DataFrame, rule: MixRule) -> DataFrame:
    """(source, n, w): the relative weight of each source of ``counts`` (source, n)."""
    if rule.weights is None:
        return counts.select("source", "n", F.pow(F.col("n").cast("double"), F.lit(rule.exponent)).alias("w"))
    if not rule.weights:
        return counts.select("source", "n", F.lit(1.0).alias("w"))
    given = counts.sparkSession.createDataFrame([(str(k), float(v)) for k, v in rule.weights.items()], "named string, given double")
    return counts.join(given, F.col("source") == F.col("named"), "left").select("source", "n", F.coalesce("given", F.lit(min(map(float, rule.weights.values())))).alias("w"))


def frame_of(weights: DataFrame, rule: MixRule) -> int:
    """Slots of a frame: the least power of two of ``rule.frame`` or more in which every source has a slot."""
    least, total = weights.agg(F.min("w"), F.sum("w")).first()
    return 1 << math.ceil(math.log2(max(rule.frame, LOT, total / least * (1 - 1e-9)))) if total else max(rule.frame, LOT)


def shares(weights: DataFrame, frame: int) -> DataFrame:
    """(k, source, n, share): slots of each source in a frame, ``frame`` in sum, by largest remainder."""
    packed = weights.agg(F.sort_array(F.collect_list(F.struct("source", "n", "w"))).alias("s"), F.sum("w").alias("total"))
    rows = packed.select("total", F.posexplode("s").alias("k", "x")).select("k", "x.source", "x.n", (F.col("x.w") / F.col("total") * frame).alias("ideal"))
    rows = rows.select("k", "source", "n", F.greatest(F.floor("ideal"), F.lit(1)).alias("whole"), (F.col("ideal") - F.floor("ideal")).alias("part"))
    everything = Window.partitionBy(F.lit(0))  # a row for each source
    left = F.lit(frame) - F.sum("whole").over(everything)
    extra = (F.row_number().over(everything.orderBy(F.desc("part"), "k")) <= left).cast("long")
    return rows.select("k", "source", "n", (F.col("whole") + extra).cast("long").alias("share"))


def frame_schedule(share: DataFrame, frame: int) -> DataFrame:
    """(k, turn, at): the slot in the frame of each source's turn; ``frame`` rows.

    A fold over the slots: of the sources whose next block is released, the one
    of the earliest deadline gets the slot.
    """
    packed = share.agg(F.sort_array(F.collect_list(F.struct("k", "share"))).alias("p"))
    # the next block's release is floor(done * frame / share) and its deadline ceil((done + 1) * frame / share)
    slot = f"""transform(array(array_min(transform(p, (x, i) ->
                named_struct(
                    'late', (get(acc.done, i) * {frame}) div x.share > t,
                    'due', ((get(acc.done, i) + 1) * {frame} + x.share - 1) div x.share,
                    'k', i)))),
                b -> named_struct(
                    'done', transform(acc.done, (n, i) -> n + if(i = b.k, 1L, 0L)),
                    'out', concat(acc.out, array(named_struct('k', b.k, 'turn', get(acc.done, b.k))))))[0]"""
    turn = "array<struct<k: int, turn: bigint>>"
    chunk = f"aggregate(sequence(c * {CHUNK}, least({frame}, (c + 1) * {CHUNK}) - 1), named_struct('done', all.done, 'out', cast(array() as {turn})), (acc, t) -> {slot})"
    folded = packed.selectExpr(
        f"""aggregate(
            sequence(0, {-(-frame // CHUNK) - 1}),
            named_struct('done', transform(p, x -> 0L), 'chunks', cast(array() as array<{turn}>)),
            (all, c) -> transform(array({chunk}), r -> named_struct('done', r.done, 'chunks', concat(all.chunks, array(r.out))))[0],
            all -> flatten(all.chunks)) AS turns"""
    )
    return folded.select(F.posexplode("turns").alias("at", "x")).select("x.k", "x.turn", "at")


def mixed(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """``row`` (all columns as a struct), source, share, frame, block, slot, release, deadline, position and on_target.

    ``position`` numbers all rows from 0 without a gap; ``on_target`` tells the
    slots up to which no source has run out.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    # the hash of the id orders a source; the source's name and the id are all that counting reads
    order = F.when(F.col("row.doc_id").isNull(), F.xxhash64("row")).otherwise(F.xxhash64("row.doc_id"))
    rows = rows.select("row", F.coalesce(F.col("row.source").cast("string"), F.lit("")).alias("source"), order.alias("h"))
    # a row for each source: counted once, used by all that follows
    counts = checkpointed(docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).groupBy("source").agg(F.count("*").alias("n")))
    weights = checkpointed(weighted(counts, rule))
    frame = frame_of(weights, rule)
    share = checkpointed(shares(weights, frame))
    sources, total = share.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    first_out = share.agg(F.min(F.floor((F.floor(F.col("n") / rule.block_rows)) * frame / F.col("share"))).alias("first_out"))
    known = share.crossJoin(F.broadcast(first_out)).select("k", F.col("source").alias("named"), "n", "share", "first_out")
    if sources <= SENT_ROWS:
        rows = rows.join(F.broadcast(known), F.col("source") == F.col("named"))
    else:
        rows = spread_join(rows, known, "source", "named", "n", total, F.col("h"))
    rows = rows.drop("named")
    # hash ranges of about RANGE_ROWS rows; their sums give each range its first rank
    ranges = F.ceil(F.col("n") / RANGE_ROWS)
    unit = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 32)  # 0 to 2**32 - 1, in the hash's order
    rows = rows.withColumn("part", F.shiftright(unit * ranges, 32))
    sums = rows.groupBy("k", "part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("k").alias("sk"), F.col("part").alias("sp"), F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("k", "part").orderBy("h", "row.doc_id", F.xxhash64("row"))) - 1
    rows = rows.withColumn("rank_in_part", rank).join(sums, (F.col("k") == F.col("sk")) & (F.col("part") == F.col("sp")))
    rows = rows.withColumn("rank", F.col("before") + F.col("rank_in_part")).withColumn("block", F.expr(f"rank div {rule.block_rows}"))
    turns = checkpointed(frame_schedule(share, frame)).select(F.col("k").alias("tk"), F.col("turn"), "at")
    rows = rows.join(F.broadcast(turns) if frame <= SENT_ROWS else turns, (F.col("k") == F.col("tk")) & (F.expr("block % share") == F.col("turn")))
    rows = rows.withColumn("nth", F.expr("block div share")).withColumn("slot", F.col("nth") * frame + F.col("at"))
    # lots of slots keep a task's rows few and the tasks in the mix's order, whatever the frame
    rows = rows.withColumn("lot", F.expr(f"slot div {LOT}")).repartitionByRange("lot")
    inside = Window.partitionBy("lot")
    rows = rows.withColumn("place", F.row_number().over(inside.orderBy("slot", "rank")) - 1).withColumn("cut", F.col("lot") % (frame // LOT))
    cuts = lot_cuts(share, turns, frame)
    rows = rows.join(F.broadcast(cuts) if sources * (frame // LOT) <= SENT_ROWS else cuts, F.col("cut") == F.col("o"))
    # rows before a lot: of each source what its blocks up to there hold; worked out once a lot
    base = F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + F.least(x["n"], (F.col("f") * x["share"] + x["cum"]) * rule.block_rows))
    rows = rows.withColumn("f", F.expr(f"lot div {frame // LOT}")).withColumn("base", F.when(F.col("place") == 0, base)).drop("all").withColumn("base", F.max("base").over(inside))
    return rows.select(
        "row", "source", "share", F.lit(frame).cast("long").alias("frame"), "block", "slot",
        F.expr(f"(block * {frame}) div share").alias("release"),
        F.expr(f"((block + 1) * {frame} + share - 1) div share").alias("deadline"),
        (F.col("base") + F.col("place")).alias("position"), (F.col("slot") < F.col("first_out")).alias("on_target"),
    )


def lot_cuts(share: DataFrame, turns: DataFrame, frame: int) -> DataFrame:
    """(o, all): for each lot of a frame and each source its rows, its share and its turns before the lot."""
    grid = share.select("k", "n", "share").withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(frame // LOT - 1))))
    taken = turns.groupBy(F.col("tk"), F.expr(f"at div {LOT}").alias("to")).agg(F.count("*").alias("c"))
    grid = grid.join(taken, (F.col("k") == F.col("tk")) & (F.col("o") == F.col("to")), "left")
    cum = F.coalesce(F.sum("c").over(Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return grid.select("o", F.struct("n", "share", cum.alias("cum")).alias("x")).groupBy("o").agg(F.collect_list("x").alias("all"))


def mix_report(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """One row per document with its place in the mix; the text isn't read."""
    names = ("source", "share", "frame", "block", "slot", "release", "deadline", "position", "on_target")
    return mixed(docs.select("doc_id", "source"), rule).select(F.col("row.doc_id").alias("doc_id"), *names)


def mix_sources(docs: DataFrame, rule: MixRule = MixRule()) -> DataFrame:
    """The rows of ``docs`` in the order of the mix, columns unchanged: partitions hold ranges of it."""
    return mixed(docs, rule).sortWithinPartitions("position").select("row.*")
