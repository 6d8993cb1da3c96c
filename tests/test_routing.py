import pytest
from builders import frame, mapping, message
from pyspark.sql import functions as F

from tidegate.functions import names
from tidegate.operators import quality, routing


def tables(spark):
    hubs = spark.createDataFrame(
        [(1, "HUB_1", "ns", "hub1", "g"), (2, "HUB_2", "ns", "hub2", "g")],
        "n int, hub_key string, eventhub_namespace string, eventhub string, "
        "consumer_group string")
    targets = spark.createDataFrame(
        [(1, "TARGET_1", "DB1", "S1", "T1", 10), (3, "TARGET_3", "DB3", "S3", "T3", 10)],
        "n int, target_key string, target_db string, target_schema string, target_table string, "
        "batch_size int")
    return hubs, targets


def test_pairs_by_number(spark):
    got = routing.auto_mapping(*tables(spark)).collect()
    assert [r.mapping_key for r in got] == ["HUB_1->TARGET_1"]


def test_pairs_by_name(spark):
    hubs, targets = tables(spark)
    pairs = spark.createDataFrame([("HUB_2", "TARGET_1"), ("HUB_9", "TARGET_8")],
                                  "hub_key string, target_key string")
    got = routing.explicit_mapping(pairs, hubs, targets).collect()
    assert [r.mapping_key for r in got] == ["HUB_2->TARGET_1"]
    broken = routing.dangling_pairs(pairs, hubs, targets).collect()
    assert broken == [("HUB_9", "TARGET_8", "hub,target")]


def test_routes_and_reports(spark):
    df = frame(spark, [message(hub="a"), message(hub="a", sequence=1), message(hub="b")])
    pairs = mapping(spark, "a", "idle")
    assert {r.target_table for r in routing.route(df, pairs).collect()} == {"T_a"}
    assert [r.eventhub for r in routing.unroutable(df, pairs).collect()] == ["b"]
    found = {(r.finding, r.eventhub, r.messages)
             for r in routing.unmapped_report(df, pairs).collect()}
    assert found == {("unmapped_hub", "b", 1), ("idle_mapping", "idle", 0)}
    report = {r.eventhub: (r.routed, r.unroutable, r.valid)
              for r in routing.mapping_report(df, pairs).collect()}
    assert report == {"a": (2, 0, True), "b": (0, 1, False), "idle": (0, 0, True)}


def test_one_hub_may_feed_two_targets(spark):
    df = frame(spark, [message(hub="a")])
    both = mapping(spark, "a").unionByName(
        mapping(spark, "a").withColumn("target_table", F.lit("SECOND")))
    assert sorted(r.target_table for r in routing.route(df, both).collect()) == ["SECOND", "T_a"]


def test_plan_counts_full_batches(spark):
    df = frame(spark, [message(hub="a", sequence=i) for i in range(11)])
    pairs = mapping(spark, "a", "idle").withColumn("batch_size", F.lit(5))
    got = {r.mapping_key: (r.pending_messages, r.expected_batches)
           for r in routing.processing_plan(df, pairs).collect()}
    assert got == {"HUB_1->TARGET_1": (11, 3), "HUB_2->TARGET_2": (0, 0)}


ACCEPTED = [
    (names.is_namespace, "x.servicebus.windows.net", True), (names.is_namespace, "x.net", False),
    *[(names.is_hub_name, n, True) for n in ("test-hub", "hub123", "my_hub", "hub.name", "hub-1")],
    *[(names.is_hub_name, n, False) for n in ("@invalid", "", "-hub", "h", "hub@x")],
    *[(names.is_target_identifier, n, True) for n in ("DB$NAME", "db-name", "DB_1", "Tablé")],
    *[(names.is_target_identifier, n, False) for n in ("TEST@DB", "", "  ", "a b", "_$-")],
    *[(names.is_sql_identifier, n, False) for n in ("db-name", "x; DROP TABLE y", "Tablé", "")],
    (names.is_sql_identifier, "DB$NAME_1", True),
    (names.is_mapping_key, "TEST_123", True),
    *[(names.is_mapping_key, n, False) for n in ("lowercase", "INVALID-KEY", "")],
    (names.is_account, "org-acct.region_1", True), (names.is_account, "a b", False),
    (names.is_not_blank, " ", False)]


@pytest.mark.parametrize("rule", {r for r, _, _ in ACCEPTED}, ids=lambda r: r.__name__)
def test_names(spark, rule):
    cases = [(n, ok) for r, n, ok in ACCEPTED if r is rule]
    df = spark.createDataFrame(cases, "name string, ok boolean")
    assert df.where(rule(F.col("name")) != F.col("ok")).collect() == []


def test_quarantine_splits_whole_input(spark):
    df = spark.createDataFrame([("x.servicebus.windows.net", "hub1"), ("bad", "@"), (None, "hub1")],
                               "eventhub_namespace string, eventhub string")
    good, bad = quality.quarantine(df)
    assert good.count() == 1 and good.columns == df.columns
    assert sorted(r.reasons for r in bad.collect()) == [["namespace"], ["namespace", "eventhub"]]
