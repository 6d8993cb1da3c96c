import os
import time

import pytest
from builders import frame, message

from tidegate.sources import hub, stored
from tidegate.streaming import closing


def rows(low, high, name="aa"):
    return [message(str(n % 2), n, hub=name, seconds=n) for n in range(low, high)]


def until(spark, path, messages, query, seconds=120):
    deadline = time.monotonic() + seconds
    while time.monotonic() < deadline:
        if query.exception():
            raise query.exception()
        if os.path.isdir(path) and closing.closed_messages(spark, path) >= messages:
            return
        time.sleep(0.3)
    raise TimeoutError(f"{messages} messages did not close")


def closed(spark, path):
    return sorted((r.eventhub, r.batch_id, r.reason, r.messages, r.first, r.last)
                  for r in closing.read_closed(spark, path).collect())


def test_silent_hub_closes_by_timer_and_restart(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("hub", "out", "cp"))
    stored.store_hub(frame(spark, rows(0, 25) + rows(0, 3, "bb")), source)

    def start(wait):
        return closing.start_closing(
            closing.closed_batches(stored.stored_hub(spark, source), 10, wait), out, cp,
            {"processingTime": "200 milliseconds"})

    query = start(8)
    try:
        until(spark, out, 20, query)
        time.sleep(0.5)
        assert [r[2] for r in closed(spark, out)] == ["size", "size"]
    finally:
        query.stop()
    query = start(8)        # no message arrives any more: the timers outlive the restart
    try:
        until(spark, out, 28, query)
        assert closed(spark, out) == [
            ("aa", 0, "size", 10, 0, 9), ("aa", 1, "size", 10, 10, 19),
            ("aa", 2, "age", 5, 20, 24), ("bb", 0, "age", 3, 0, 2)]
        ages = [(r.closed_at - r.created_at).total_seconds()
                for r in closing.read_closed(spark, out).where("reason = 'age'").collect()]
        assert all(age >= 8 for age in ages)
        stored.store_hub(frame(spark, rows(25, 29)), source)
        until(spark, out, 32, query)
    finally:
        query.stop()
    assert closed(spark, out)[3] == ("aa", 3, "age", 4, 25, 28)


def test_null_hub_and_bounds(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("hub", "out", "cp"))
    hub.write_hub(frame(spark, rows(0, 4, None) + rows(0, 2)), source)
    query = closing.start_closing(
        closing.closed_batches(hub.file_hub(spark, source), 2, 60), out, cp,
        {"processingTime": "200 milliseconds"})
    try:
        until(spark, out, 6, query)
    finally:
        query.stop()
    got = {(r.eventhub, r.batch_id): r.messages for r in closing.read_closed(spark, out).collect()}
    assert got == {(None, 0): 2, (None, 1): 2, ("aa", 0): 2}
    with pytest.raises(ValueError):
        closing.closed_batches(hub.file_hub(spark, source), 0)
