import zlib

import corpus
from pyspark.sql import functions as F

import corpus_pipeline
from basketflow.llm.jaccard_join import jaccard_components


def test_stages_take_effect(spark, docs, tmp_path):
    secret = "token = 0123456789abcdef0123456789"
    extra = [(3000 + i, corpus.rows(7, 40)[i][1] + " " + secret, "en", "src1", 0) for i in range(20)]
    kept = docs.unionByName(spark.createDataFrame(extra, corpus.SCHEMA))
    names, counts = [name for name, _ in corpus_pipeline.STAGES], {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        stage(spark, before, "").write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        counts[name] = kept.count()
        if name != names[-1]:
            assert kept.columns == docs.columns
        if name == "language":
            gone = before.select("doc_id").exceptAll(kept.select("doc_id"))
            assert {1000, 1001, 1002, 1007} <= {r.doc_id for r in gone.collect()}
            assert before.where("n_chars > 100").count() == kept.where("n_chars > 100").count()
        if name == "near_copies":
            first = {r.component_id for r in jaccard_components(before).collect()}
            assert {r.doc_id for r in kept.collect()} == first
            left = jaccard_components(kept.where("doc_id is not null"))
            assert left.where(F.col("doc_id") != F.col("component_id")).isEmpty()
        if name == "secrets":
            assert kept.where(F.col("text").contains("0123456789abcdef")).isEmpty()
            assert kept.where("text like '%[assign]%' and n_chars <> length(text)").isEmpty()
            assert counts[name] == counts["near_copies"]
        if name == "mix":
            assert kept.select("doc_id", "text").distinct().exceptAll(before.select("doc_id", "text")).isEmpty()
    tokens = kept.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("each"))
    assert tokens.where(F.col("n") % F.col("each") != 0).isEmpty()


def test_empty_corpus(spark, no_docs):
    kept = no_docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, "")
    assert kept.count() == 0


def test_last_stage_gives_the_ids(spark, docs):
    rows = dict(corpus_pipeline.STAGES)["pack"](spark, docs, "").collect()
    assert rows and all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


def test_clashing_columns_come_back(spark, docs):
    names = ("score", "spans", "kept", "size", "part", "key", "_id", "node", "_size", "_rows", "redacted", "nth")
    kept = docs.where("n_chars > 100").withColumns({c: F.concat(F.lit(c), "doc_id") for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, "")
        assert kept.columns == [*docs.columns, *names], name
        assert kept.where(" or ".join(f"`{c}` <> concat('{c}', doc_id)" for c in names)).isEmpty()
        assert kept.count() > 0
    assert dict(corpus_pipeline.STAGES)["pack"](spark, kept.select(*docs.columns), "").count() > 0
