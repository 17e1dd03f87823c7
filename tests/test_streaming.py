"""Streams over landed arrivals: lateness, restarts, bounded state, and the same as in batch."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import temporal
from tillroll.plans import timed
from tillroll.sources.wholesale import Wholesale
from tillroll.streaming.landing import Landing, Sink
from tillroll.streaming.windows import session_totals, window_totals

START = datetime.datetime(2024, 3, 1)
SCHEMA = "id int, user_id int, ts timestamp"


def events(spark, rows):
    return spark.createDataFrame(
        [(i, u, None if t is None else START + datetime.timedelta(minutes=t)) for i, u, t in rows], SCHEMA
    )


def arrivals(seed=4):
    """Four arrivals of about 100 minutes each, some rows from long before, some without a time."""
    rng, out, number = random.Random(seed), [], 0
    for part in range(4):
        rows = []
        for _ in range(120):
            minute = part * 100 + rng.randrange(100)
            if rng.random() < 0.1:
                minute -= rng.choice([5, 40, 150])
            rows.append((number, rng.choice([1, 1, 2, 3, None]), minute if rng.random() < 0.97 else None))
            number += 1
        out.append(rows)
    return out


def judged(parts, delay=30):
    """(rows in time, late ids, watermark) by the rule of the landing."""
    in_time, late, newest = [], [], None
    for rows in parts:
        for row in rows:
            if row[2] is not None and newest is not None and row[2] <= newest - delay:
                late.append(row[0])
            else:
                in_time.append(row)
        newest = max([r[2] for r in rows if r[2] is not None] + ([] if newest is None else [newest]))
    return in_time, late, newest - delay


@pytest.fixture
def land(spark, tmp_path):
    def run(parts, build, each=True):
        """The table after all arrivals, processed one by one or all at the end."""
        root = tmp_path / f"{random.random()}"
        landing, sink = Landing(spark, f"{root}/in", "ts", "30 MINUTES"), Sink(spark, f"{root}/out")
        for number, rows in enumerate(parts):
            landing.add(events(spark, rows), number)
            if each or number == len(parts) - 1:
                # a new object each time, as after a restart
                landing = Landing(spark, f"{root}/in", "ts", "30 MINUTES", landing.schema)
                sink = Sink(spark, f"{root}/out")
                stream = build(landing)
                sink.advance(stream)
        sink.advance(build(landing))  # nothing new: nothing changes
        return sink.table(stream.schema)

    return run


def totals():
    return {"n": F.count("*"), "ids": F.sort_array(F.collect_list("id"))}


@pytest.mark.parametrize("each", [True, False])
def test_windows_hold_rows_in_time_once(land, each):
    parts = arrivals()
    in_time, _, closed = judged(parts)
    table = land(parts, lambda l: window_totals(l.in_time(), "ts", "20 minutes", ["user_id"], totals()), each)
    want = {}
    for i, user, t in in_time:
        if t is not None:
            start = t // 20 * 20
            if start + 20 <= closed:
                want.setdefault((start, user), []).append(i)
    got = {
        (int((r.window_start - START).total_seconds()) // 60, r.user_id): r.ids for r in table.collect()
    }
    assert got == want and table.count() == len(want)


def test_late_rows_are_kept_apart(land):
    parts = arrivals(5)
    _, late, _ = judged(parts)
    assert late
    assert sorted(r.id for r in land(parts, lambda l: l.late()).collect()) == late


def test_streamed_sessions_equal_batch_sessions(spark, land):
    parts = arrivals(6)
    in_time, _, closed = judged(parts)
    table = land(parts, lambda l: session_totals(l.in_time(), "ts", "7 minutes", ["user_id"], totals()))
    batch = temporal.sessions(events(spark, in_time), ["user_id"], "ts", 420, totals())
    end = START + datetime.timedelta(minutes=closed)
    want = {tuple(map(str, r)) for r in batch.collect() if r.session_end <= end}
    assert {tuple(map(str, r)) for r in table.collect()} == want


def test_an_arrival_lands_once(spark, tmp_path):
    landing = Landing(spark, str(tmp_path), "ts", "1 HOUR")
    landing.add(events(spark, [(1, 1, 1)]), 0)
    with pytest.raises(ValueError, match="has landed"):
        landing.add(events(spark, [(2, 1, 1)]), 0)
    landing.add(events(spark, []), 1)
    landing.add(events(spark, [(3, 1, 500)]), 2)
    assert landing._log().count() == 3


def test_an_arrival_that_was_broken_off_can_be_added_again(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "in"), "ts", "1 HOUR")
    landing.add(events(spark, [(1, 1, 100)]), 0)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("tillroll.streaming.landing.move_path", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            landing.add(events(spark, [(2, 1, 20), (3, 1, 900)]), 1)
    landing.add(events(spark, [(2, 1, 20), (3, 1, 900)]), 1)
    sink = Sink(spark, str(tmp_path / "late"))
    sink.advance(landing.late())
    assert [r.id for r in sink.table(landing.late().schema).collect()] == [2]
    assert landing._log().count() == 2


def test_join_state_stays_small(spark):
    """Rows leave the state once no partner can come: far fewer are held than were read."""
    w = Wholesale(spark, "/root/testdata/sf0.001")
    table, sink = timed.order_shipments(w)
    read = w.source("orders").count() + w.source("lineitem").count()
    assert table.filter("line_no IS NULL").count() > 0
    assert sink.state_rows and sink.state_rows[-1] < read / 10
