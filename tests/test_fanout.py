"""One read for all mappings: what fails is parked and delivered later, what lands is not doubled."""

from datetime import datetime, timedelta

import pytest
from builders import frame, mapping, message

from tidegate.streaming import fanout
from tidegate.streaming.sink import prepare, read_target

NOW = datetime(2024, 5, 1)


def made(tmp_path, probe=None, run_id="r"):
    sink = fanout.FanOutSink(f"{tmp_path}/target", f"{tmp_path}/control", f"{tmp_path}/ledger",
                             f"{tmp_path}/parked", run_id, now=lambda: NOW)
    if probe:
        sink.probe = probe
    return sink


def prepared(spark, low=0, n=12):
    rows = [message(str(i % 3), low + i, hub=h, seconds=i) for i in range(n)
            for h in ("aa", "bb", "cc")]
    return prepare(frame(spark, rows), mapping(spark, "aa", "bb"))


def landed(spark, tmp_path):
    rows = read_target(spark, f"{tmp_path}/target")
    return {r.eventhub: r["count"] for r in rows.groupBy("eventhub").count().collect()}




@pytest.fixture
def broken(spark):
    keys = {r.eventhub: r.mapping_key for r in prepared(spark).where("mapping_key is not null")
            .select("eventhub", "mapping_key").distinct().collect()}
    return keys["bb"]


def test_one_broken_mapping_leaves_the_others_and_comes_later(spark, tmp_path, broken):
    def probe(key, batch_id, attempt):
        if key == broken and attempt <= 2:
            raise ConnectionError("connection reset")

    sink = made(tmp_path, probe)
    for batch_id in range(2):
        sink(prepared(spark, 100 * batch_id), batch_id)
    assert landed(spark, tmp_path) == {"aa": 24}
    assert sink.retry(spark) == 0                       # not due yet
    sink.now = lambda: NOW + timedelta(seconds=5)
    assert sink.retry(spark) == 0                       # fails once more, due a little later
    last = {(r.mapping_key, r.batch_id): (r.state, r.attempt)
            for r in fanout.state(spark, f"{tmp_path}/ledger").collect()}
    assert last[broken, 0] == ("parked", 2)
    sink.now = lambda: NOW + timedelta(seconds=60)
    assert sink.retry(spark) == 2 and sink.retry(spark) == 0
    assert landed(spark, tmp_path) == {"aa": 24, "bb": 24}


def test_fatal_failures_stay_parked(spark, tmp_path, broken):
    def probe(key, batch_id, attempt):
        if key == broken:
            raise RuntimeError("403 forbidden")

    sink = made(tmp_path, probe)
    sink(prepared(spark), 0)
    sink.now = lambda: NOW + timedelta(days=9)
    assert sink.retry(spark) == 0 and landed(spark, tmp_path) == {"aa": 12}
    row = fanout.state(spark, f"{tmp_path}/ledger").where("state = 'parked'").first()
    assert (row.category, row.due, row.attempt, row.messages) == ("auth", None, 1, 12)


def test_a_replay_skips_what_is_settled_and_doubles_nothing(spark, tmp_path, broken):
    class PowerCut(BaseException):
        pass

    def probe(key, batch_id, attempt):
        if key == broken:
            raise PowerCut

    with pytest.raises(PowerCut):
        made(tmp_path, probe)(prepared(spark), 0)
    for _ in range(2):                                  # after a restart, twice
        made(tmp_path)(prepared(spark), 0)
    assert landed(spark, tmp_path) == {"aa": 12, "bb": 12}
    entries = fanout.read_ledger(spark, f"{tmp_path}/ledger")
    assert entries.count() == entries.select("mapping_key", "batch_id").distinct().count()


def test_runs_do_not_settle_each_other(spark, tmp_path):
    made(tmp_path, run_id="one")(prepared(spark), 0)
    made(tmp_path, run_id="two")(prepared(spark, 500), 0)
    assert landed(spark, tmp_path) == {"aa": 24, "bb": 24}


def test_empty_micro_batch(spark, tmp_path):
    sink = made(tmp_path)
    sink(prepared(spark).limit(0), 0)
    assert sink._own_ledger(spark, 0) == []
