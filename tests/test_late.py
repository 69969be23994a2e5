"""Grace rule: batch replay per record (D4) and the streaming watermark (D3)."""

from learner_scoring.operators.enrich import valid_events
from learner_scoring.operators.windows import assign_window, drop_late, late_records

from tests.helpers import quiz, topics


def _kept(spark, rows):
    q, s = topics(spark, rows)
    ev = assign_window(valid_events(q, s))
    return sorted(r.kafka_offset for r in drop_late(ev).collect())


def test_inside_grace_is_kept(spark):
    # stream time 64,999 ms, then a record for window [0, 60 s)
    rows = [quiz(1, 64999, True), quiz(2, 30000, True)]
    assert _kept(spark, rows) == [1, 2]


def test_at_grace_end_is_dropped(spark):
    rows = [quiz(1, 65000, True), quiz(2, 31000, True)]
    assert _kept(spark, rows) == [1]


def test_stream_time_is_per_partition_and_offset_ordered(spark):
    # partition 1 is far ahead; partition 0 is not affected by it
    rows = [quiz(1, 200000, True, partition=1, student="s2"), quiz(2, 30000, True), quiz(3, 31000, True)]
    assert _kept(spark, rows) == [1, 2, 3]
    # an earlier offset with a later time closes the window for later offsets only
    rows = [quiz(1, 30000, True), quiz(2, 70000, True), quiz(3, 31000, True)]
    assert _kept(spark, rows) == [1, 2]


def test_distributed_running_max_matches_plain(spark):
    rows = [quiz(i, (i * 7919) % 200000, True) for i in range(1, 200)]
    q, s = topics(spark, rows)
    ev = assign_window(valid_events(q, s))
    small = {r.kafka_offset for r in late_records(ev, bucket_width=3).collect()}
    big = {r.kafka_offset for r in late_records(ev, bucket_width=1 << 20).collect()}
    # plain python replay
    mx, late = -1, set()
    for i in range(1, 200):
        t = (i * 7919) % 200000
        mx = max(mx, t)
        if (t - t % 60000 + 60000) <= mx - 5000:
            late.add(i)
    assert small == big == late
