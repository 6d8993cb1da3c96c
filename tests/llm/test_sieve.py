"""Rows without a partner are not exchanged, and none with one is lost."""

from data import documents
from pyspark.sql import functions as F

from tidegate.llm import line_dedup, sieve


def test_a_sieve_loses_no_key(spark):
    rows = spark.range(-5000, 5000).select("id", F.xxhash64("id").alias("h"))
    keys = rows.where("id % 10 = 0").select(F.col("h").alias("key"))
    some, rest = sieve.split(rows, F.col("h"), keys)
    some, rest = ({r.id for r in part.collect()} for part in (some, rest))
    assert {i for i in some | rest} == set(range(-5000, 5000)) and not some & rest
    assert {i for i in some if i % 10 == 0} == set(range(-5000, 5000, 10)) and len(some) < 1100
    some, rest = sieve.split(rows, F.col("h"), keys.limit(0))
    assert some.count() == 0 and rest.count() == 10_000


def test_texts_that_lose_no_line_are_not_exchanged(spark):
    docs = documents(spark).select("doc_id", "text")
    gone = line_dedup.deleted_lines(line_dedup.keyed(docs, "doc_id", "text"))
    out = line_dedup.without_deleted(docs, gone)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
    rows = {(r.row.doc_id, r.row.text): (r.kept, r.n_lines, r.n_deleted) for r in out.collect()}
    assert rows[2, None] == ("", 1, 0) and rows[3, ""] == ("", 1, 0)
    assert rows[11, "a"] == ("a", 1, 0) and sum(n > 0 for _, _, n in rows.values()) == 2
