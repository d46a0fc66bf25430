"""The stages one after the other, each held against what its operator says of its own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from kasane.llm import quality, simhash, winnow


def test_stages(spark, docs, rows, tmp_path):
    root = f"file://{tmp_path}"
    own = docs.withColumn("n_chars", F.length("text").cast("long"))
    own.write.parquet(f"{root}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(64, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, rows[0][1]), (2, "the"), (3, None)], "item_id long, text string").where("item_id <> 2").write.parquet(f"{root}/benchmark.parquet")
    columns = own.columns
    now = spark.read.parquet(f"{root}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, root)
        out.write.parquet(f"{root}/{k}")
        out = spark.read.parquet(f"{root}/{k}")
        if k < 4:
            assert out.columns == columns
        if name == "quality_rules":
            want = quality.judged(now, labels.where("quality = 1")).where("kept").count()
            assert out.count() == want < now.count()
        if name == "line_dedup":
            assert out.count() == now.count() and out.where("n_chars <> length(text)").count() == 0
        if name == "near_dedup":
            assert out.count() == simhash.near_duplicates(now).select("component_id").distinct().count()
        if name == "decontamination":
            bench = spark.read.parquet(f"{root}/benchmark.parquet")
            assert out.count() == winnow.contaminated_spans(now, bench).where("n_hit = 0").count() < now.count()
        if name == "encoding":
            assert out.count() == now.count() and out.where("not exact").count() == 0
        now = out
    assert corpus_pipeline.run(spark, root).count() == now.count()


def test_stages_of_an_empty_table(spark, empty, tmp_path):
    root = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    empty.write.parquet(f"{root}/documents.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0
