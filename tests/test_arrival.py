"""Arrival order over both topics: offsets count per (topic, partition)."""

import json
from datetime import datetime, timezone

import pytest

from learner_scoring.operators.changelog import score_changelog
from learner_scoring.operators.enrich import valid_events
from learner_scoring.operators.fold import window_state, window_state_lists
from learner_scoring.operators.windows import assign_window, late_records
from learner_scoring.schemas import QUIZ_ANSWER, SESSION_EVENT
from learner_scoring.sources import decode
from learner_scoring.sources.kafka import QUIZ_TOPIC, SESSION_TOPIC

RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"


def _record(topic, partition, offset, second, session, **fields):
    at = datetime.fromtimestamp(second, timezone.utc)
    kind = "quiz.answered" if topic == QUIZ_TOPIC else "session.started"
    envelope = {"id": f"{topic}-{partition}-{offset}", "type": kind, "timestamp": at.isoformat(), "studentId": "s1", "sessionId": session}
    value = json.dumps({"envelope": envelope, **fields}).encode()
    return (b"k", value, topic, partition, offset, at, 0)


def _events(spark, rows):
    records = spark.createDataFrame(rows, RECORD)
    quiz = decode.decode_json(records.filter(records.topic == QUIZ_TOPIC), QUIZ_ANSWER)
    session = decode.decode_json(records.filter(records.topic == SESSION_TOPIC), SESSION_EVENT)
    return assign_window(valid_events(decode.split_decoded(quiz)[0], decode.split_decoded(session)[0]))


ROWS = [
    _record(SESSION_TOPIC, 0, 900, 1, "SB", eventType="STARTED"),
    _record(QUIZ_TOPIC, 1, 7, 10, "SA", isCorrect=False),
    _record(QUIZ_TOPIC, 0, 0, 30, "SA", isCorrect=True),
]


@pytest.mark.parametrize("width", [1, 1 << 16])
def test_order_is_time_first_in_all_forms(spark, width):
    ev = _events(spark, ROWS)
    for state in (window_state(ev, windowed=True, seq_bucket=width), window_state_lists(ev)):
        r = state.collect()
        assert [(x.session_id, x.consecutive_incorrect, x.total_answers) for x in r] == [("SB", 0, 2)]
    steps = sorted(score_changelog(ev, seq_bucket=width).collect(), key=lambda x: x.arrival_seq)
    assert [(x.total_answers, x.consecutive_incorrect, x.state_session_id) for x in steps] == [(0, 0, "SB"), (1, 1, "SB"), (2, 0, "SB")]


def test_equal_times_and_offsets_have_one_order(spark):
    rows = [
        _record(QUIZ_TOPIC, 1, 5, 10, "S1", isCorrect=True),
        _record(QUIZ_TOPIC, 0, 5, 10, "S0", isCorrect=False),
        _record(SESSION_TOPIC, 0, 5, 10, "S2", eventType="STARTED"),
    ]
    for order in (rows, rows[::-1]):
        ev = _events(spark, order)
        for state in (window_state(ev, windowed=True), window_state_lists(ev)):
            assert [(x.session_id, x.consecutive_incorrect) for x in state.collect()] == [("S0", 0)]


def test_stream_time_keeps_topics_apart(spark):
    # the quiz partition is far ahead; the session partition of the same number is not late by it
    rows = [_record(QUIZ_TOPIC, 0, 1, 300, "S", isCorrect=True), _record(SESSION_TOPIC, 0, 2, 10, "S", eventType="STARTED")]
    assert late_records(_events(spark, rows)).count() == 0
