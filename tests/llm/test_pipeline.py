"""The pipeline: stage by stage on a small table."""

from __future__ import annotations

import random

import corpus_pipeline
from timbre.llm import source_mix


def test_stages_keep_columns_and_feed_each_other(spark, tmp_path):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80)), "en", f"s{i % 3}", 0, i) for i in range(40)]
    rows += [(100 + k, rows[0][1], "en", "s0", 0, 1) for k in range(5)] + [(200, None, None, None, None, None), (None, rows[3][1], "en", "s1", 0, 2), (201, "few words", "en", "s1", 0, 2)]
    rows = [(i, t, a, b, len(t or ""), x) for i, t, a, b, _, x in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
        at = after
        seen.append(at.count())
    assert seen[1] == seen[0] and seen[3] == seen[2] <= seen[1] and seen[4] >= seen[3]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in at.select("doc_id").distinct().collect()}
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert 200 not in kept and 201 not in kept


def test_mix_decides_the_sequences(spark, tmp_path):
    """Shares of the sources in every prefix of sequences are those of the mix, whose order packing reads from the files."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randint(0, 900)}" for _ in range(60)), "en", "a" if i % 10 else "b", 0) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    corpus_pipeline.mix_stage(spark, docs, "").write.parquet(f"{tmp_path}/mix")
    mix = spark.read.parquet(f"{tmp_path}/mix")
    placed = sorted(corpus_pipeline.in_written_order(mix, "place").collect(), key=lambda r: r.place)
    assert [r.place for r in placed] == list(range(4000))
    source, at = {r.doc_id: r.source for r in placed}, {r.doc_id: r.place for r in placed}
    want = {r.doc_id: r.position for r in source_mix.mix_report(docs).collect()}
    assert at == want
    out = sorted(corpus_pipeline.pack_stage(spark, mix, "").collect(), key=lambda r: (r.sequence_id, r.offset))
    firsts = list(dict.fromkeys(r.doc_id for r in out))
    for n in (1024,):  # a whole shard of the mix, before a source runs out
        assert set(firsts[:n]) == {r.doc_id for r in placed[:n]}
        assert abs(sum(source[i] == "b" for i in firsts[:n]) / n - 0.25) < 0.02


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
