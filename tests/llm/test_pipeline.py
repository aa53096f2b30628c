"""The stages one after the other, and what each of them leaves."""

from edge import ODD, none, odd

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import exact_dedup, jaccard_join, pieces, toxicity
from millrace.llm.toxicity import train_rows

SMALL = "/root/testdata/sf0.01"


def test_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = toxicity.with_toxicity(docs, docs, labels, train_rows())
    clean = scored.where("toxicity < 0.7").drop("toxicity")
    alone = exact_dedup.exact_groups(clean).where("kept").select("doc_id")
    first = jaccard_join.similar_groups(clean.join(alone, "doc_id"), 5, 80).where("doc_id = component_id")
    want = {r["doc_id"] for r in first.collect()}
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == [*docs.columns, "position", "ids"]
    rows = got.collect()
    assert {r["doc_id"] for r in rows} == want and len(rows) == len(want) < docs.count()
    codec = pieces.Codec(pieces.vocabulary())
    for r in rows[:50]:
        assert codec.decode(__import__("numpy").array(r["ids"])).decode() == r["text"]


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, odd(spark), SMALL)
        assert kept.columns == odd(spark).columns + ["position", "ids"] * (number == 4)
        assert 0 < kept.count() <= len(ODD)
        assert stage(spark, none(spark), SMALL).count() == 0


def test_all_operators_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


def test_texts_reach_python_in_small_batches(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "repeat('word ', 100000) AS text").coalesce(1)

    @corpus_pipeline.stage
    def measured(spark, docs, sf_dir):
        return docs.mapInArrow(lambda batches: (b.select(["doc_id"]) for b in batches if b.nbytes < 2 * corpus_pipeline.BATCH), "doc_id long")

    kept = spark.conf.get(corpus_pipeline.BATCH_BYTES, None)
    spark.conf.unset(corpus_pipeline.BATCH_BYTES)
    assert measured(spark, docs, SMALL).count() == 40
    if kept is not None:
        spark.conf.set(corpus_pipeline.BATCH_BYTES, kept)
