"""Rows reach a worker in small batches; what it no longer needs goes back to the system."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import common
from headway.llm.packing import pieces_of
from headway.llm.queries import word_vocabulary

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_slices_give_free_memory_back_once_all_parts_are_read(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(True))
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 100] * 50})
    parts = common.slices(batch, 10, 1000)
    first = next(parts)
    assert not given and 0 < first.num_rows < 50
    assert first.num_rows + sum(p.num_rows for p in parts) == 50 and given == [True]


def test_give_back_runs_here():
    common.give_back()


def batch_sizes(spark):
    """Bytes of each batch of 2,000 texts of 10 kB in one partition."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})

    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("ten bytes "), 1000).alias("text"))
    return texts.mapInArrow(sizes, "rows long, size long").collect()


@pytest.mark.parametrize("step", ["language", "near_copies", "pack"])
def test_stages_with_python_send_rows_in_small_batches(spark, step):
    docs = spark.createDataFrame([(1, "one two three", "en", "a", 13)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.unset(BATCH_BYTES)
    try:
        dict(corpus_pipeline.STAGES)[step](spark, docs, "")
        found = batch_sizes(spark)
    finally:
        spark.conf.unset(BATCH_BYTES)
    assert sum(r["rows"] for r in found) == 2000
    assert max(r["size"] for r in found) < 5 << 20


def test_ids_do_not_depend_on_the_batches(spark):
    texts = [(k, "word%d, other words " % k * (k % 7) * 200) for k in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    made = []
    for size in ("64m", "10k"):
        spark.conf.set(BATCH_BYTES, size)
        try:
            pieces = common.stored(pieces_of(docs, word_vocabulary(), 1, 2048), "test")
            made.append(sorted(map(tuple, pieces.collect())))
        finally:
            spark.conf.unset(BATCH_BYTES)
    assert made[0] == made[1] and len(made[0]) >= 300
