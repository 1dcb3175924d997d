"""Accuracy of the language model on the rows it was not trained on."""

from pyspark.sql import functions as F

from headway.llm import queries


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op5_subword_language(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    rows = found.join(docs, "doc_id").where("held_out AND lang IS NOT NULL AND text IS NOT NULL").collect()
    right = sum(r.lang_pred == r.lang for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == docs.count() and found.where(F.col("lang_pred").isNull()).count() == 0
