import corpus_pipeline as cp
from pyspark.sql import functions as F

from loamline.llm import queries


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    sizes = []
    for name, stage in cp.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.join(before, docs.columns, "left_anti").count() == 0
        sizes.append(docs.count())
        if name == "toxicity":
            left = {r.doc_id for r in docs.select("doc_id").collect()}
            toxic = [i in left for i, r in labels.items() if r.toxic == 1]
            clean = [i in left for i, r in labels.items() if r.toxic == 0]
            # 40 toxic rows to learn from at this size
            assert sum(toxic) / len(toxic) < 0.35 and sum(clean) / len(clean) > 0.98
        if name == "near_duplicates":
            ids = {r.doc_id for r in queries.minhash.near_duplicates(before, queries.minhash.Settings(shingle=5)).where("kept").collect()}
            assert {r.doc_id for r in docs.select("doc_id").collect()} == ids
        if name == "mixing":
            tokens = lambda d: d.agg(F.sum(queries.mixing.token_count(F.col("text")))).first()[0]
            assert abs(tokens(docs) / tokens(before) - cp.SHARE) < 0.06
    assert sizes == sorted(sizes, reverse=True)
    out = cp.STAGES[-1][1](spark, docs, sf)
    assert out.count() == sizes[-1] and out.where("n_tokens * 4 <> octet_length(ids)").count() == 0


def test_odd_rows(spark, odd, none, sf):
    for docs in (odd.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")), none.select("doc_id", "text", "lang", "source", F.lit(0).cast("long").alias("n_chars"))):
        n = docs.count()
        for _, stage in cp.STAGES:
            assert stage(spark, docs, sf).count() <= n


def test_run(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
