import json
from datetime import UTC, datetime

from builders import frame, message
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.functions import labels
from tidegate.functions.text import (clean_list_map, clean_map, clean_text, iso_timestamp,
                                     micros, properties_json, utc_now)
from tidegate.operators import envelope
from tidegate.sources.tables import event_messages

SF = "/root/testdata/sf0.001"


def test_broken_bytes_become_replacement_characters(spark):
    row = spark.sql("SELECT X'FFFE41' AS b").select(clean_text("b").alias("s")).first()
    assert row.s == b"\xff\xfe\x41".decode("utf-8", errors="replace")


def test_bytes_in_maps_and_lists(spark):
    df = spark.sql("SELECT map(X'6B', X'76FF') AS m, map(X'6B', array(X'61', X'FF')) AS l")
    row = df.select(clean_map("m").alias("m"), clean_list_map("l").alias("l")).first()
    assert row.m == {"k": "v�"}
    assert row.l == {"k": ["a", "�"]}


def test_absent_and_empty_properties_are_null(spark):
    df = frame(spark, [message(properties=None), message(properties={}),
                       message(properties={"a": "1", "b": None})])
    got = [r.p for r in df.select(properties_json("properties").alias("p")).collect()]
    assert got[:2] == [None, None]
    assert json.loads(got[2]) == {"a": "1", "b": None}


def test_malformed_properties(spark):
    bad = b"v\xff\xe2\x82x"
    df = spark.createDataFrame([({b"k": bad},)], "properties map<binary,binary>").select(
        "*", F.lit(b"").alias("body"), F.lit("0").alias("partition_id"),
        F.lit(1).alias("sequence_number"), F.lit(None).cast("timestamp_ntz").alias("enqueued_time"),
        F.transform_values(F.transform_keys("properties", lambda k, _: k.cast("string")),
                           lambda _, v: v.cast("string")).alias("system_properties"))
    row = envelope.to_landed(df).first()
    expected = {"k": bad.decode("utf-8", errors="replace")}
    assert json.loads(row.properties) == json.loads(row.system_properties) == expected


def test_iso_text_matches_python(spark):
    times = [datetime(2024, 2, 29, 1, 2, 3), datetime(2024, 2, 29, 1, 2, 3, 40), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = [r.s for r in df.select(iso_timestamp("t").alias("s")).collect()]
    assert got == [t and t.isoformat() + "+00:00" for t in times]


def test_envelope_columns_and_nulls(spark):
    df = envelope.to_envelope(frame(spark, [message(body=b"test body", seconds=None)]))
    assert df.columns == schema.ENVELOPE.names
    row = df.first()
    assert (row.event_body, row.enqueued_time, row.properties) == ("test body", None, None)
    assert row.ingestion_timestamp.endswith("+00:00")


def test_landing_directly_equals_landing_the_envelope(spark):
    messages = event_messages(spark, SF)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    long_way = envelope.land(envelope.to_envelope(messages), stamp)
    direct = envelope.to_landed(messages, stamp=stamp)
    assert long_way.dtypes == direct.dtypes
    assert long_way.exceptAll(direct).isEmpty() and direct.exceptAll(long_way).isEmpty()


def test_staged_text_that_is_not_json_is_kept_as_it_is(spark):
    staged = spark.createDataFrame(
        [('{"event_body": "x", "sequence_number": 7}',), ("test body",), ("[1]",), (None,)],
        "staged string")
    rows = envelope.land_staged(staged).collect()
    assert [(r.event_body, r.sequence_number) for r in rows] == [("x", 7)]
    left = envelope.rejected_staged(staged).collect()
    assert [(r.staged, r.reason) for r in left] == [
        ("test body", "no_json"), ("[1]", "no_object"), (None, "no_text")]


def test_keys_that_decode_alike_keep_the_last_value(spark):
    row = spark.sql("SELECT map(X'FF', X'61', X'FE', X'62', X'6B', X'63') AS m").select(
        clean_map("m").alias("m")).first()
    assert row.m == {"\ufffd": "b", "k": "c"}


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    times = [datetime(2024, 3, 10, 2, 30, 0, 5), datetime(2024, 7, 1, 12)]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
        got = df.select(iso_timestamp("t").alias("s"), micros("t").alias("m")).collect()
        now = spark.range(1).select(utc_now().alias("n")).first().n
        stamp = envelope.to_envelope(frame(spark, [message()])).first().ingestion_timestamp
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.s for r in got] == [t.isoformat() + "+00:00" for t in times]
    assert [r.m for r in got] == [int(t.replace(tzinfo=UTC).timestamp() * 1_000_000 + 0.5)
                                  for t in times]
    assert abs((datetime.now(UTC).replace(tzinfo=None) - now).total_seconds()) < 60
    assert stamp[:16] <= datetime.now(UTC).isoformat()[:16] and stamp.endswith("+00:00")


def test_guard_drops_missing_sequence(spark):
    df = frame(spark, [message(sequence=1), message(sequence=None, offset="x")])
    assert envelope.guarded(df).count() == 1
    assert envelope.guard_report(df, ["eventhub"]).first()[1:] == (1, 1)


def test_row_id(spark):
    df = frame(spark, [message(partition="partition_5", sequence=100)])
    assert envelope.with_row_id(df).first().row_id == "partition_5_100"
    no_sequence = frame(spark, [message(sequence=None, offset="x")])
    assert no_sequence.select(labels.row_id(index=F.lit(3))).first()[0] == "0_3"


def test_channel_and_target_names(spark):
    df = spark.createDataFrame([("hub1", "D", "S", ""), ("hub1", "D", "S", None)],
                               "eventhub string, target_db string, target_schema string, "
                               "target_table string")
    rows = df.select(labels.channel_name("production", "us-east", "client123").alias("c"),
                     labels.target_name().alias("t"),
                     labels.control_name(F.lit("C"), F.lit(None), F.lit(None)).alias("k"))
    assert set(rows.collect()) == {("hub1-production-us-east-client123", "D.S.events",
                                    "C.S.INGESTION_STATUS")}
