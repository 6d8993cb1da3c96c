"""Mappings of a micro-batch are delivered side by side."""

import threading

from builders import frame, mapping, message

from tidegate.streaming import fanout
from tidegate.streaming.sink import prepare, read_target


def test_mappings_are_delivered_side_by_side(spark, tmp_path):
    meeting = threading.Barrier(3)
    sink = fanout.FanOutSink(f"{tmp_path}/target", f"{tmp_path}/control", f"{tmp_path}/ledger",
                             f"{tmp_path}/parked", probe=lambda *a: meeting.wait(60))
    rows = [message("0", i, hub=h, seconds=i) for i in range(5) for h in ("aa", "bb", "cc")]
    sink(prepare(frame(spark, rows), mapping(spark, "aa", "bb", "cc")), 0)
    landed = read_target(spark, f"{tmp_path}/target").groupBy("eventhub").count().collect()
    assert sorted(tuple(r) for r in landed) == [("aa", 5), ("bb", 5), ("cc", 5)]
    assert fanout.read_ledger(spark, f"{tmp_path}/ledger").where("state = 'landed'").count() == 3
