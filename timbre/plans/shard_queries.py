"""Driver queries on shards: documents rolled over, packed as tars, scanned and fetched again; vectors kept in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timbre.operators import sequences
from timbre.operators.rolling import rollover
from timbre.plans.catalog import query
from timbre.plans.standins import table
from timbre.sources import shards, tar_writer, tars, vector_files
from timbre.store import fresh_path

#: Bytes at which a shard of documents is closed, and quantity at which one of line items is.
SHARD_BYTES, SHARD_QUANTITY = 60_000, 5_000

#: Documents as clips: the text is the audio (missing for some), the sidecar a small document; sizes as they are packed.
CLIPS = """clips AS (SELECT doc_id, coalesce(source, 'none') AS tier, concat('c', lpad(cast(doc_id AS varchar), 9, '0')) AS clip_id, CASE WHEN doc_id % 41 <> 0 THEN text END AS audio,
    concat('{"id":"', doc_id, '","spk":"', coalesce(source, 'none'), '","dur":', coalesce(n_chars, 0), '}') AS sidecar FROM documents),
    sized AS (SELECT *, coalesce(strlen(audio), 0) + strlen(sidecar) AS bytes FROM clips), summed AS (SELECT *, sum(bytes) OVER (PARTITION BY tier ORDER BY doc_id) AS upto FROM sized)"""
#: The roll-over as jumps from shard to shard: the next one begins after the first row that brings the shard to its size.
PACKED = f"""{CLIPS}, jumps AS (SELECT DISTINCT tier, cast(0 AS bigint) AS shard_no, cast(0 AS hugeint) AS begins FROM summed
        UNION ALL SELECT tier, shard_no + 1, begins FROM (SELECT j.tier, j.shard_no, min(s.upto) AS begins FROM jumps j JOIN summed s ON s.tier = j.tier AND s.upto >= j.begins + {SHARD_BYTES} GROUP BY j.tier, j.shard_no)),
    placed AS (SELECT s.*, concat(s.tier, '/shard-', lpad(cast(j.shard_no AS varchar), 5, '0')) AS shard FROM summed s ASOF JOIN jumps j ON s.tier = j.tier AND s.upto - s.bytes >= j.begins),
    packed AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS place FROM placed)"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tier = table(spark, sf_dir, "documents"), F.coalesce("source", F.lit("none"))
    sidecar = F.concat(F.lit('{"id":"'), "doc_id", F.lit('","spk":"'), tier, F.lit('","dur":'), F.coalesce("n_chars", F.lit(0)), F.lit("}"))
    rows = docs.select("doc_id", tier.alias("tier"), F.concat(F.lit("c"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("clip_id"), F.when(F.col("doc_id") % 41 != 0, F.col("text")).cast("binary").alias("audio"), sidecar.alias("sidecar"))
    return rows.withColumn("bytes", F.coalesce(F.octet_length("audio"), F.lit(0)) + F.octet_length("sidecar"))


def packed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Where the documents are packed as shards, and their manifest."""
    rows = clips(spark, sf_dir)
    numbers = rollover(rows.select("doc_id", "tier", "bytes"), ["tier"], ["doc_id"], "bytes", SHARD_BYTES)
    rows = rows.join(numbers.select("doc_id", "shard_no"), "doc_id").select("doc_id", "clip_id", tar_writer.shard_name("tier", "shard_no").alias("shard"), F.col("doc_id").alias("position"), F.lit("flac").alias("audio_ext"), "audio", "sidecar")
    path = fresh_path(spark, "shards")
    return path, tar_writer.write_shards(rows, path)


@query("packing_manifest", f"WITH RECURSIVE {PACKED} SELECT doc_id, shard, place AS \"offset\", clip_id, CASE WHEN audio IS NOT NULL THEN concat(clip_id, '.flac') END AS member, audio IS NOT NULL AS has_audio, coalesce(strlen(audio), 0) AS audio_bytes, strlen(sidecar) AS sidecar_bytes FROM packed")
def packing_manifest(spark, sf_dir):
    """The manifest that the tar writer's tasks have written."""
    _, manifest = packed(spark, sf_dir)
    return manifest.select("doc_id", "shard", "offset", "clip_id", "member", "has_audio", "audio_bytes", "sidecar_bytes")


@query("scanned_clips", f"""WITH RECURSIVE {PACKED}, members AS (SELECT *, sum(CASE WHEN audio IS NULL THEN 1 ELSE 2 END) OVER (PARTITION BY shard ORDER BY place) - 2 AS nth FROM packed)
    SELECT regexp_extract(shard, '([^/]*)$', 1) AS shard, clip_id, cast(nth AS bigint) AS position, strlen(audio) AS n_bytes, md5(audio) AS digest, tier AS speaker, cast(coalesce(strlen(regexp_extract(sidecar, '"dur":([0-9]+)', 1)), 0) AS bigint) AS dur_digits FROM members WHERE audio IS NOT NULL""")
def scanned_clips(spark, sf_dir):
    """All clips that have audio, by a scan of the packed shards: headers, pairs of members, ranges."""
    path, _ = packed(spark, sf_dir)
    rows = shards.resolved(tars.read_clips(spark, path))
    digits = F.length(F.regexp_extract("sidecar", r'"dur":([0-9]+)', 1)).cast("long")
    return rows.select("shard", "clip_id", "position", F.octet_length("audio").cast("long").alias("n_bytes"), F.md5("audio").alias("digest"), F.col("original_speaker").alias("speaker"), digits.alias("dur_digits"))


@query("attached_audio", f"""WITH {CLIPS} SELECT l.doc_id, coalesce(c.audio IS NOT NULL, false) AS has_audio, CASE WHEN c.audio IS NOT NULL THEN 'flac' END AS audio_ext, strlen(c.audio) AS n_bytes, md5(c.audio) AS digest
    FROM (SELECT doc_id FROM labels UNION ALL SELECT -1) l LEFT JOIN clips c USING (doc_id)""")
def attached_audio(spark, sf_dir):
    """The labelled clips, and one that no shard has, with the audio of their shards; others aren't read."""
    path, manifest = packed(spark, sf_dir)
    places = manifest.select("doc_id", "clip_id", F.regexp_extract("shard", "([^/]*)$", 1).alias("source_shard"))
    asked = table(spark, sf_dir, "labels").select("doc_id").unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("doc_id")))
    # tiers have shards of the same names, so a clip is known by both
    index = tars.member_index(spark, path)
    rows = tars.attached(asked.join(places, "doc_id", "left"), index)
    return rows.select("doc_id", "has_audio", "audio_ext", F.octet_length("audio").cast("long").alias("n_bytes"), F.md5("audio").alias("digest"))


#: Line items have repeated keys; these columns order them totally.
LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query("lineitem_rollover", f"""WITH RECURSIVE s AS (SELECT {LINES}, cast(l_quantity AS bigint) AS q, sum(cast(l_quantity AS bigint)) OVER (ORDER BY {LINES}) AS upto FROM lineitem),
    jumps AS (SELECT cast(0 AS bigint) AS shard_no, cast(0 AS hugeint) AS begins UNION ALL SELECT shard_no + 1, begins FROM (SELECT j.shard_no, min(s.upto) AS begins FROM jumps j JOIN s ON s.upto >= j.begins + {SHARD_QUANTITY} GROUP BY j.shard_no))
    SELECT {LINES}, j.shard_no FROM s ASOF JOIN jumps j ON s.upto - s.q >= j.begins""")
def lineitem_rollover(spark, sf_dir):
    """All line items as one group."""
    rows = table(spark, sf_dir, "lineitem").select(*LINES.split(", "), F.lit(0).alias("one"), "l_quantity")
    return rollover(rows, ["one"], LINES.split(", "), "l_quantity", SHARD_QUANTITY).select(*LINES.split(", "), "shard_no")


#: A number as half precision has it: a multiple of its unit, ties to even.
HALF = "CASE WHEN x = 0 THEN x ELSE round_even(x / u, 0) * u END"


@query("vector_rows", f"""WITH p AS (SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS r FROM embeddings), c AS (SELECT vec_id, unnest(range(len(embedding))) AS d, cast(unnest(embedding) AS double) AS x FROM p),
    h AS (SELECT vec_id, d, {HALF} AS h FROM (SELECT *, pow(2, greatest(floor(log2(abs(nullif(x, 0)))), -14) - 10) AS u FROM c))
    SELECT p.vec_id, concat('emb-', label, '.npy') AS emb_file, r AS emb_row, count(*) AS dims, round(sum(h), 6) AS total, round(sum(h * h), 6) AS square, round(sum(h * d), 6) AS slope FROM p JOIN h USING (vec_id) GROUP BY ALL""")
def vector_rows(spark, sf_dir):
    """Vectors written as half-precision files by label and read back by their pointers."""
    rows = sequences.embedding_pointers(table(spark, sf_dir, "embeddings").withColumn("label", F.col("label").cast("string")), "label", "vec_id")
    path = fresh_path(spark, "vectors")
    vector_files.write_vectors(rows, path)
    back = vector_files.read_vectors(rows.select("vec_id", "emb_file", "emb_row"), path)
    total = lambda f: F.round(F.aggregate(F.transform("vector", lambda x, d: f(x.cast("double"), d)), F.lit(0.0), lambda a, x: a + x), 6)
    return back.select("vec_id", "emb_file", "emb_row", F.size("vector").cast("long").alias("dims"), total(lambda x, d: x).alias("total"), total(lambda x, d: x * x).alias("square"), total(lambda x, d: x * d).alias("slope"))
