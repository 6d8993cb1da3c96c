"""A Python task holds a bounded part of a hub."""

from pyspark.sql import functions as F

from tidegate.operators import batching


def test_a_python_task_holds_a_bounded_chunk(spark, monkeypatch):
    real = batching._chunk_summary

    def bounded(*args):
        def checked(rows):
            if len(rows) > 250_000:
                raise ValueError(f"{len(rows)} messages in a task")
            return inner(rows)
        inner = real(*args)
        return checked

    monkeypatch.setattr(batching, "_chunk_summary", bounded)
    rows = spark.range(600_000).select(
        F.lit("h").alias("eventhub"), F.col("id").alias("arrival"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("enqueued_time"))
    out = batching.assign_batches(rows, 300, 120)
    assert out.select(F.max("batch_id"), F.count_distinct("batch_id")).first() == (
        (600_000 - 1 - 1) // 120, (600_000 - 2) // 120 + 1)
