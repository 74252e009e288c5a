"""The pipeline's stages and the entry's guard."""

import corpus_pipeline
from sonara.llm import minhash, packing, quality


def test_stages_on_edge_rows(spark, edge_dir, edge_rows):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, edge_dir)
        assert out.columns == docs.columns
        docs = out
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True)
    texts = [r["text"] for r in docs.select("text").collect()]
    assert len(texts) == len(set(texts))  # repeated rows and copies went, one of each stays
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {4, 13} <= ids and not ids & {1, 2, 3, 5, 6, 14, 15, 17}


def test_run_packs_what_the_stages_keep(spark):
    folder = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, folder)
    assert {r[0] for r in got.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}
    # clean documents stay: all that the quality rules' own labels call good and that are no near copies
    good = quality.score_quality(docs).where("__q.kept").join(docs, "doc_id")
    single = minhash.near_duplicates(good.select("doc_id", "text")).where("kept").count()
    assert kept.count() >= 0.98 * single
    total = packing.pack(kept).agg({"length": "sum"}).first()[0]
    assert got.agg({"length": "sum"}).first()[0] == total


def test_empty(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
