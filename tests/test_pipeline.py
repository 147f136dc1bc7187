import importlib
import importlib.util
import re

import pytest
from pyspark.sql import functions as F

from loamline.functions.chunking import ChunkConfig
from loamline.functions.quality import QualityConfig
from loamline.plans import pipeline as pl
from loamline import streaming as st


def test_copy_of_a_rejected_chunk_is_a_duplicate(spark):
    bad = "same " * 60
    chunks = spark.createDataFrame([(1, 0, "a", bad), (2, 0, "b", bad), (3, 0, "c", "tiny"), (4, 0, "d", " ".join(f"w{i} good" for i in range(60)))], "doc_id long, chunk_index int, chunk_id string, text string")
    out = {r.doc_id: r.reason for r in pl.gate_chunks(chunks, pl.PipelineConfig(quality=QualityConfig.strict())).collect()}
    assert out == {1: "low_unique_ratio", 2: "exact_duplicate", 3: "too_short", 4: None}


def test_every_document_and_last_group_has_a_row(spark):
    line = " ".join(f"w{i}" for i in range(30))
    texts = ["", None, "tiny", "a few words that make up more than fifty characters of text", f"{line}. {line} a. {line} b. end of it", " ".join("....." for _ in range(60)) + " ", f"more {line} {line}"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(7, f"{line} {line}", "de")], "doc_id long, text string, lang string")
    config = pl.PipelineConfig.of({"clean": {"languages": ["en"]}, "chunk": {"method": "sentence", "min_words": 50, "max_words": 70}})
    rows = pl.prepare(docs, config).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.stage, r.reason))
        assert (r.chunk_id is None) == (r.stage in ("cleaning", "chunking"))
    assert got[0] == got[1] == [("cleaning", "empty_text")] and got[2] == [("cleaning", "too_short")] and got[7] == [("cleaning", "language")]
    assert got[3] == [("chunking", "too_few_words")] and sorted(got[4], key=str) == [("chunking", "short_last_group"), (None, None)]
    assert set(got) == set(range(8))


def test_rejected_document_keeps_its_reason(spark):
    word = "mail me at someone@example.com " * 20
    docs = spark.createDataFrame([(1, word, "en"), (2, " ".join(f"v{i}" for i in range(80)), "en")], "doc_id long, text string, lang string")
    config = pl.FilterConfig(("mail me",), "reject")
    out = {r.doc_id: (r.stage, r.reason) for r in pl.prepare(docs, pl.PipelineConfig(filter=config)).collect()}
    assert out == {1: ("cleaning", "filter_rejected"), 2: (None, None)}


def test_filter_stages(spark):
    """Cleaning: after URLs are gone. Chunking: rejected or emptied chunks stay with a reason."""
    long = " ".join(f"v{i}" for i in range(80))
    rows = [(1, f"{long} http://secret.example.org/x", "en"), (2, f"{long} secret words here", "en"), (3, long, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def reasons(action, *stages, context=500):
        config = pl.PipelineConfig(filter=pl.FilterConfig(("secret",), action, context, stages=stages), lsh=None)
        return {r.doc_id: (r.stage, r.reason, r.word_count) for r in pl.prepare(docs, config).collect()}

    got = reasons("reject", "cleaning")
    assert got[1][:2] == (None, None) and got[2][:2] == ("cleaning", "filter_rejected")
    got = reasons("reject", "chunking")
    assert got[1][:2] == (None, None) and got[2][:2] == ("chunking", "filter_rejected")
    assert reasons("remove", "chunking")[2][:2] == ("chunking", "too_short_after_filter")
    got = reasons("remove", "chunking", context=10)
    assert got[2][:2] == (None, None) and 60 < got[2][2] < 83


def test_rows_are_kept_or_have_a_reason(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pl.prepare(docs, pl.PipelineConfig(chunk=ChunkConfig("fixed", 50, 200, 0)))
    assert rows.select("doc_id").distinct().count() == docs.count()
    assert rows.where("(stage IS NULL) <> (reason IS NULL)").count() == 0
    assert sum(r.n for r in pl.removal_report(rows).collect()) == rows.count()


def test_extraction_filter(spark):
    from loamline.sources import extract as ex

    files = spark.createDataFrame([("/in/a.txt", bytearray(b"a secret")), ("/in/b.txt", bytearray(b"open"))], "path string, content binary")
    out = {r.filename: (r.text, r.success, r.filter_action) for r in ex.extract_files(files, guard=pl.FilterConfig(("secret",), "reject")).collect()}
    assert out == {"a.txt": (None, False, "rejected"), "b.txt": ("open", True, "none")}


def test_overlap_of_a_whole_table(spark):
    from loamline.operators import profile as pr

    tail = "the end of the one is the head of the next"
    rows = [(0, f"first text {tail}"), (1, f"{tail} second"), (2, "third"), (3, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: (r.overlap_chars, r.overlap_words) for r in pr.consecutive_overlap(df, ["id"], []).collect()}
    assert got == {0: (len(tail), 11), 1: (0, 0)}
    one = pr.overlap_summary(df, "id").first()
    assert (one.has_overlap, one.total_compared, one.overlapping_pairs, one.overlap_rate, one.avg_overlap_words) == (True, 2, 1, 0.5, 11.0)
    assert pr.overlap_summary(df.limit(0), "id").first().total_compared == 0


def test_options_reach_the_gate(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(1, 0, "a", " ".join(base)), (2, 0, "b", " ".join(base[:40] + [f"v{i}" for i in range(20)])), (3, 0, "c", "Incomprehensibility institutionalisation " * 30), (4, 0, "d", "The cat sat. The dog ran. " * 12)]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_index int, chunk_id string, text string")
    lsh = {"bands": 128, "rows": 1}
    reasons = lambda **sections: {r.doc_id: r.reason for r in pl.gate_chunks(chunks, pl.PipelineConfig.of(sections)).collect()}
    assert reasons(lsh=lsh) == {1: None, 2: "near_duplicate", 3: None, 4: None}
    assert reasons(lsh=lsh | {"verify": True}, quality={"min_readability": 0.0}) == {1: None, 2: None, 3: "low_readability", 4: None}


def test_run_writes_everything(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    config = pl.PipelineConfig.of({"chunk": {"method": "sentence", "min_words": 50, "max_words": 150}, "shards": {"max_rows": 40}})
    out = pl.run(docs, str(tmp_path), config)
    report = {(r.stage, r.reason): r.n for r in out["report"].collect()}
    kept = report["kept", "kept"]
    assert spark.read.parquet(str(tmp_path / "shards")).count() == kept == out["shards"].first().total_chunks
    assert spark.read.json(str(tmp_path / "shards_metadata")).first().total_chunks == kept == spark.read.json(str(tmp_path / "export_metadata")).first().total_chunks
    assert sum(r.n for r in out["categories"].collect()) == kept == spark.read.json(str(tmp_path / "annotations")).count()


def test_config_errors():
    with pytest.raises(ValueError):
        pl.PipelineConfig.of({"chunk": {"sizes": 3}})
    with pytest.raises(ValueError):
        pl.PipelineConfig.of({"nothing": {}})


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "word " * 60, "en"), (2, "word " * 60, "en")], "doc_id long, text string, lang string").withColumn("ts", F.lit("2024-01-01").cast("timestamp")).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    for name, frame in (("c", st.chunk_stream(stream, ChunkConfig())), ("q", st.quality_stream(st.clean_stream(stream))), ("d", st.dedup_stream(stream, "ts", "1 hour"))):
        q = frame.writeStream.format("memory").queryName(f"s_{name}").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert spark.table("s_c").count() == 2 and spark.table("s_q").count() == 2 and spark.table("s_d").count() == 1


def test_entry(spark, monkeypatch):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("loamline.llm", "corpus_pipeline") else find(name, *a))
    bare = importlib.reload(e)
    assert not any(k.startswith("op1_") or k == "pipeline" for k in bare.queries())
    monkeypatch.undo()
    importlib.reload(e)


def test_gate_against_the_sequential_rule(spark):
    """Copies and near copies among chunks that fail early, as one walk in the pipeline's order gives them; all rows come back."""
    import random

    from loamline.operators import dedup as de

    random.seed(12)
    base = [" ".join(f"w{g}x{j}" for j in range(60)) for g in range(6)]
    texts = [random.choice(base) + random.choice(["", f" own{i}", f" own{i} " + " ".join(f"o{i}y{j}" for j in range(30))]) for i in range(150)] + ["tiny"] * 5
    random.shuffle(texts)
    rows = [(i // 3, i % 3, f"c{i:03}", t) for i, t in enumerate(texts)]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_index int, chunk_id string, text string").repartition(3)
    lsh = de.LshConfig(permutations=32, bands=8, rows=4)
    buckets = {}
    for r in de.lsh_members(de.minhash(chunks, 32, "chunk_id"), 8, 4, "chunk_id").collect():
        buckets.setdefault(r.chunk_id, set()).add((r.band, r.bucket))
    seen, taken, want = set(), set(), {}
    for _, _, key, text in rows:
        if text == "tiny":
            want[key] = "too_short"
        elif text in seen:
            want[key] = "exact_duplicate"
        else:
            seen.add(text)
            want[key] = "near_duplicate" if buckets[key] & taken else None
            taken |= set() if want[key] else buckets[key]
    got = {r.chunk_id: r.reason for r in pl.gate_chunks(chunks, pl.PipelineConfig(lsh=lsh)).collect()}
    assert got == want and {"near_duplicate", "exact_duplicate", None} <= set(got.values())


def test_report_reads_no_text_after_the_chunks_are_written(spark):
    """Metrics and hashes are written with the chunks, so what decides copies and counts reasons moves no texts between tasks."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(80)), "en") for i in range(5)], "doc_id long, text string, lang string")
    report = pl.removal_report(pl.prepare(docs))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "text_sha256#" in plan or "__at#" in plan
    assert not re.search(r"(?<!\w)text#\d+", plan)
    assert {tuple(r) for r in report.collect()} == {("kept", "kept", 5)}
