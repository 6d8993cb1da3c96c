import json

import pytest
from builders import NS, checkpoint, frame, log, message, target
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.operators import checkpoints, replays
from tidegate.sources import hub


def rows_of(spark, messages):
    df = target(frame(spark, messages)).withColumn("batch_id", F.lit(0).cast("bigint"))
    return checkpoints.batch_checkpoints(df, run_id="r", arrival="sequence_number",
                                         consumer_group="g")


def test_offset_becomes_the_waterlevel(spark):
    row = rows_of(spark, [message("0", 100, offset="12345")]).first()
    assert row.waterlevel == 12345
    meta = json.loads(row.metadata)
    assert meta == {"sequence_number": 100, "offset_string": "12345",
                    "fully_qualified_namespace": NS, "eventhub_name": "test-hub",
                    "consumer_group": "g", "waterlevel_kind": "offset"}


@pytest.mark.parametrize("offset,level", [("invalid", 100), ("12.5", 100), (" 12 ", 12),
                                          ("+5", 5), ("", 100)])
def test_offsets_that_are_not_numbers(spark, offset, level):
    assert rows_of(spark, [message("0", 100, offset=offset)]).first().waterlevel == level


def test_one_row_per_partition_with_the_highest_sequence(spark):
    got = rows_of(spark, [message(str(i % 3), 100 + i) for i in range(10)])
    assert {r.partition_id: r.waterlevel for r in got.collect()} == {"0": 109, "1": 107, "2": 108}
    assert set(got.columns) == set(schema.CHECKPOINT_LOG.names)


def test_first_message_wins_a_tie(spark):
    df = frame(spark, [message("0", 7, offset="1"), message("0", 7, offset="2")])
    df = df.withColumn("arrival", F.col("offset").cast("bigint"))
    assert checkpoints.highest_messages(df, ["partition_id"]).first().offset == "1"


def test_newest_row_wins_even_when_lower(spark):
    df = log(spark, [checkpoint("0", 50, 1), checkpoint("0", 40, 2), checkpoint("1", 9, 1),
                     checkpoint(None, 99, 3)])
    newest = {r.partition_id: r.waterlevel for r in checkpoints.latest_checkpoints(df).collect()}
    assert newest == {"0": 40, "1": 9}
    top = checkpoints.latest_checkpoints(df, monotone=True).where("partition_id = '0'").first()
    assert top.waterlevel == 50


def test_lookup_of_one_hub_and_target(spark):
    df = log(spark, [checkpoint("0", 1), checkpoint("0", 2, hub="other"),
                     checkpoint("0", 3, table="OTHER")])
    got = checkpoints.latest_checkpoints(df, NS, "test-hub", ("TEST_DB", "TEST_SCHEMA",
                                                              "TEST_TABLE"))
    assert [r.waterlevel for r in got.collect()] == [1]
    assert checkpoints.latest_checkpoints(df, NS, "missing").isEmpty()


def test_lookup_is_pushed_to_the_scan(spark, tmp_path):
    log(spark, [checkpoint("0", 1)]).write.parquet(str(tmp_path / "log"))
    df = checkpoints.latest_checkpoints(
        checkpoints.read_control_table(spark, str(tmp_path / "log")), NS, "test-hub")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "IsNotNull(partition_id)" in pushed and "EqualTo(eventhub_na" in pushed


def test_upsert(spark):
    current = log(spark, [checkpoint("0", 50, 1), checkpoint("1", 60, 1)])
    updates = log(spark, [checkpoint("0", 40, 0), checkpoint("2", 70, 2)])
    got = checkpoints.upsert_checkpoints(current, updates)
    assert {r.partition_id: r.waterlevel for r in got.collect()} == {"0": 40, "1": 60, "2": 70}
    kept = checkpoints.upsert_checkpoints(current, updates, monotone=True)
    assert {r.partition_id: r.waterlevel for r in kept.collect()} == {"0": 50, "1": 60, "2": 70}


def test_resume(spark):
    df = frame(spark, [message(p, s, offset=str(s * 10)) for p in "01" for s in range(5)])
    latest = checkpoints.latest_checkpoints(log(spark, [checkpoint("0", 20)]))
    early = checkpoints.resume_messages(df, latest, start="earliest")
    assert sorted((r.partition_id, r.sequence_number) for r in early.collect()) == [
        ("0", 3), ("0", 4), ("1", 0), ("1", 1), ("1", 2), ("1", 3), ("1", 4)]
    assert checkpoints.resume_messages(df, latest).count() == 2
    with pytest.raises(ValueError):
        checkpoints.resume_messages(df, latest, start="somewhere")


def test_resume_by_sequence_when_the_offset_was_no_number(spark):
    df = frame(spark, [message("0", s, offset=str(s * 10)) for s in range(5)])
    stored = checkpoint("0", 2, metadata='{"sequence_number": 2, "waterlevel_kind": "sequence"}')
    got = checkpoints.resume_messages(df, checkpoints.latest_checkpoints(log(spark, [stored])))
    assert sorted(r.sequence_number for r in got.collect()) == [3, 4]


def test_resume_with_offsets_that_are_no_numbers(spark):
    df = frame(spark, [message("0", s, offset="x" if s == 4 else str(s * 100)) for s in range(6)])
    known = checkpoint("0", 200, metadata='{"sequence_number": 2, "waterlevel_kind": "offset"}')
    for stored, want in ((known, [3, 4, 5]), (checkpoint("0", 300), [4, 5])):
        got = checkpoints.resume_messages(df, checkpoints.latest_checkpoints(log(spark, [stored])))
        assert sorted(r.sequence_number for r in got.collect()) == want


def test_resume_of_two_targets_on_different_scales(spark):
    df = frame(spark, [message("0", s, offset=str(1000 + s)) for s in range(200)])
    stored = [checkpoint("0", 1120, table="A",
                         metadata='{"sequence_number": 120, "waterlevel_kind": "offset"}'),
              checkpoint("0", 5, table="B",
                         metadata='{"sequence_number": 5, "waterlevel_kind": "sequence"}')]
    latest = checkpoints.latest_checkpoints(log(spark, stored))
    assert checkpoints.resume_messages(df, latest).count() == 194
    assert hub.start_positions(latest, replays.lanes(df)).first().position == 6
    lag = {r.target_table: r.lag for r in checkpoints.checkpoint_lag(df, latest).collect()}
    assert lag == {"A": 79, "B": 194}


def test_compaction_survives_the_next_append(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    checkpoints.append_checkpoints(log(spark, [checkpoint(str(p), p, batch=p, run="a:b")
                                               for p in range(3)]), old)
    checkpoints.compact_checkpoints(spark, old, new)
    checkpoints.append_checkpoints(log(spark, [checkpoint("0", 9, 5, batch=7)]), new)
    got = checkpoints.latest_checkpoints(checkpoints.read_control_table(spark, new)).collect()
    assert {r.partition_id: r.waterlevel for r in got} == {"0": 9, "1": 1, "2": 2}


def test_listing(spark):
    latest = checkpoints.latest_checkpoints(log(spark, [
        checkpoint("0", 900, metadata='{"sequence_number": 9, "consumer_group": "g"}'),
        checkpoint("1", 5)]))
    got = {r.partition_id: (r.offset, r.sequence_number, r.consumer_group)
           for r in checkpoints.resume_listing(latest).collect()}
    assert got == {"0": ("900", 9, "g"), "1": ("5", 5, None)}


def test_lag(spark):
    df = frame(spark, [message(p, s) for p in "01" for s in range(5)])
    latest = checkpoints.latest_checkpoints(log(spark, [checkpoint("0", 2)]))
    got = {r.partition_id: r.lag for r in checkpoints.checkpoint_lag(df, latest).collect()}
    assert got == {"0": 2, "1": 5}


def test_control_table(spark, tmp_path):
    path = str(tmp_path / "control")
    assert checkpoints.ensure_control_table(spark, path) is True
    assert checkpoints.read_control_table(spark, path).isEmpty()
    assert checkpoints.ensure_control_table(spark, path) is False
    spark.range(1).write.parquet(str(tmp_path / "else"))
    with pytest.raises(ValueError):
        checkpoints.ensure_control_table(spark, str(tmp_path / "else"))


def test_append_to_a_table_created_empty(spark, tmp_path):
    path = str(tmp_path / "control")
    checkpoints.ensure_control_table(spark, path)
    checkpoints.append_checkpoints(log(spark, [checkpoint("0", 10, 1, batch=4)]), path)
    got = checkpoints.read_control_table(spark, path).collect()
    assert [(r.waterlevel, r.run_id, r.batch_id) for r in got] == [(10, "r", 4)]
    assert checkpoints.ensure_control_table(spark, path) is False


def test_append_is_repeatable_and_compacts(spark, tmp_path):
    path, compacted = str(tmp_path / "control"), str(tmp_path / "compacted")
    first = log(spark, [checkpoint("0", 10, 1), checkpoint("1", 11, 1)])
    second = log(spark, [checkpoint("0", 20, 2, batch=1)])
    for rows in (first, second, second):
        checkpoints.append_checkpoints(rows, path)
    assert checkpoints.read_control_table(spark, path).count() == 3
    checkpoints.compact_checkpoints(spark, path, compacted)
    got = checkpoints.read_control_table(spark, compacted).collect()
    assert {r.partition_id: r.waterlevel for r in got} == {"0": 20, "1": 11}


def test_replays_keep_the_first_delivery(spark):
    df = frame(spark, [message("0", 1, body=b"a"), message("0", 1, body=b"b"),
                       message("1", 1, body=b"c")])
    df = df.withColumn("n", F.col("body").cast("string"))
    got = replays.drop_replays(df, "n")
    assert sorted(r.n for r in got.collect()) == ["a", "c"] and got.columns == df.columns


def test_only_new_rows_remain(spark):
    rows = frame(spark, [message("0", s) for s in range(4)] + [message("1", 0)])
    landed = frame(spark, [message("0", s) for s in range(2)])
    got = replays.not_yet_landed(rows, landed)
    assert sorted((r.partition_id, r.sequence_number) for r in got.collect()) == [
        ("0", 2), ("0", 3), ("1", 0)]


def test_starting_offsets(spark):
    lanes = frame(spark, [message("0"), message("1"), message("0", hub="b")])
    latest = checkpoints.latest_checkpoints(log(spark, [checkpoint("0", 41)]))
    late, early = (hub.starting_offsets(hub.start_positions(latest, lanes, s))
                   for s in ("latest", "earliest"))
    assert json.loads(late) == {"test-hub": {"0": 42, "1": -1}, "b": {"0": -1}}
    assert json.loads(early) == {"test-hub": {"0": 42, "1": -2}, "b": {"0": -2}}
