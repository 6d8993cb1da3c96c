import pytest
from builders import START
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.operators import failures, stats


def errors(spark, *rows):
    return spark.createDataFrame([(START, "m", kind, text, 1, 1) for kind, text in rows],
                                 schema.ERROR_LOG)


RETRIED = ["Connection timed out", "connect timeout", "503 Service Unavailable", "HTTP 429",
           "row is locked", "server busy", "Transient failure", "rate limit hit",
           "DNS failure", "connection pool exhausted", "Temporary network issue"]
STOPPED = ["401", "403 Forbidden", "Authentication failed", "schema mismatch",
           "constraint violated", "Invalid data format", "type error", "quota exceeded",
           "404", "syntax error", "configuration missing", "400 Bad Request",
           "data validation failed", "nobody knows", ""]


def test_decisions(spark):
    df = errors(spark, *[("X", t) for t in RETRIED + STOPPED])
    got = {r.error: r.should_retry for r in failures.classify_failures(df).collect()}
    assert got == {**dict.fromkeys(RETRIED, True), **dict.fromkeys(STOPPED, False)}


def test_fatal_wording_wins(spark):
    row = failures.classify_failures(errors(spark, ("X", "401 after connection timeout"))).first()
    assert (row.category, row.should_retry) == ("auth", False)


def test_receive_errors(spark):
    df = errors(spark, ("X", "DefaultAzureCredential failed: 401"), ("X", "Not authorized"),
                ("X", "status 403"), ("X", "reset by peer"))
    assert [r.error_class for r in failures.classify_receive_errors(df).collect()] == [
        "credential", "rbac", "rbac", "other"]


def test_one_decision_per_signature(spark):
    long = "x" * 100
    df = errors(spark, ("A", long + " timeout"), ("A", long + " 401"), ("B", long))
    df = df.withColumn("ts", F.expr("timestampadd(SECOND, length(error), ts)"))
    got = {r.signature: r.failures for r in failures.failure_signatures(df).collect()}
    assert got == {"A:" + long: 2, "B:" + long: 1}
    shared = failures.share_decisions(df).where("error_type = 'A'").collect()
    assert len({r.category for r in shared}) == 1 and len(shared) == 2


def test_backoff(spark):
    def waits(**kw):
        got = failures.backoff_schedule(errors(spark, ("X", "t")), **kw)
        return [r.wait_seconds for r in got.orderBy("retry_attempt").collect()]
    assert waits() == [1.0, 2.0]
    assert waits(max_attempts=6) == [1.0, 2.0, 4.0, 8.0, 10.0]
    assert waits(max_attempts=6, lo=2, hi=30) == [2.0, 2.0, 4.0, 8.0, 16.0]
    assert waits(max_attempts=1) == []
    with pytest.raises(ValueError):
        waits(max_attempts=11)


def test_decision_bounds(spark):
    df = spark.createDataFrame([(1, 0.0), (60, 1.0), (0, 0.5), (61, 0.5), (5, 1.1), (None, 0.5)],
                               "suggested_wait_seconds int, confidence double")
    assert [r.in_bounds for r in failures.check_decisions(df).collect()] == [
        True, True, False, False, False, False]


def batch_log(spark, *rows):
    df = spark.createDataFrame([(m, b, n, ok, START, START) for m, b, n, ok in rows],
                               "mapping_key string, batch_id bigint, message_count bigint, "
                               "success boolean, started_at timestamp_ntz, finished_at "
                               "timestamp_ntz")
    return df.withColumn("finished_at", F.expr("timestampadd(SECOND, batch_id, finished_at)"))


def test_two_batches_of_fifteen_messages(spark):
    row = stats.mapping_stats(batch_log(spark, ("m", 0, 10, True), ("m", 5, 5, True))).first()
    assert (row.messages_processed, row.batches_processed, row.errors) == (15, 2, 0)
    assert (row.runtime_seconds, row.messages_per_second) == (5.0, 3.0)


def test_failed_batches_do_not_count(spark):
    row = stats.mapping_stats(batch_log(spark, ("m", 0, 10, False))).first()
    assert (row.messages_processed, row.errors, row.messages_per_second) == (0, 1, None)


def test_rollup_has_detail_and_total(spark):
    log = batch_log(spark, ("a", 0, 10, True), ("b", 0, 5, True), ("b", 1, 7, False))
    got = {r.mapping_key: (r.is_total, r.messages_processed)
           for r in stats.pipeline_rollup(log).collect()}
    assert got == {"a": (0, 10), "b": (0, 5), None: (1, 15)}


def test_health_isolates_mappings(spark):
    log = batch_log(spark, ("a", 0, 10, True), ("b", 0, 5, False))
    failed = errors(spark, ("X", "t")).withColumn("mapping_key", F.lit("b"))
    got = {r.mapping_key: (r.healthy, r.errors)
           for r in stats.health_rollup(log, failed).collect()}
    assert got == {"a": (True, 0), "b": (False, 1), None: (False, 1)}


def test_sink_rate_is_zero_without_runtime(spark):
    log = batch_log(spark, ("m", 0, 10, True)).withColumn("target_table", F.lit("T"))
    lanes = spark.createDataFrame([("T", "l0"), ("T", "l1"), ("T", "l0")],
                                  "target_table string, channel string")
    row = stats.sink_stats(log, lanes).first()
    assert (row.messages_per_second, row.channels_created, row.total_messages_sent) == (0.0, 2, 10)


def test_error_summary(spark):
    df = errors(spark, ("X", "a"), ("X", "a"), ("X", "b"))
    got = {r.error: (r.failures, r.messages) for r in stats.error_summary(df).collect()}
    assert got == {"a": (2, 2), "b": (1, 1)}
