"""Fold cases as event rows; both fold plans and the changelog must agree."""

from pyspark.sql import functions as F

from learner_scoring.operators.changelog import score_changelog
from learner_scoring.operators.enrich import valid_events
from learner_scoring.operators.fold import window_state, window_state_lists
from learner_scoring.operators.windows import assign_window
from learner_scoring.plans.pipeline import build_scores

from tests.helpers import ev, quiz, sess, topics

FIELDS = [
    "session_id",
    "total_answers",
    "correct_answers",
    "incorrect_answers",
    "consecutive_incorrect",
    "rapid_submissions",
    "n_time_values",
    "total_time_spent",
    "navigation_events",
    "pause_events",
    "resume_events",
    "total_dwell_time",
    "pages_visited",
    "first_event_ms",
    "last_event_ms",
    "total_hints_used",
]


def fold_both(spark, rows, bucket=1 << 16):
    q, s = topics(spark, rows)
    events = assign_window(valid_events(q, s))
    a = {(r.student_id, r.window_start_ms): r.asDict() for r in window_state(events, windowed=True, with_skills=True, seq_bucket=bucket).collect()}
    b = {(r.student_id, r.window_start_ms): r.asDict() for r in window_state_lists(events).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for f in FIELDS + ["skill_tag_attempts", "unique_skills_attempted", "window_end_ms"]:
            assert a[k][f] == b[k][f], (k, f, a[k][f], b[k][f])
    # the changelog's last row per window equals the final state
    ch = score_changelog(events).collect()
    last = {}
    for r in ch:
        key = (r.student_id, r.window_start_ms)
        if key not in last or r.arrival_seq > last[key].arrival_seq:
            last[key] = r
    for k, r in last.items():
        for f in ["total_answers", "correct_answers", "consecutive_incorrect", "rapid_submissions", "first_event_ms", "last_event_ms"]:
            assert r[f] == a[k][f], (k, f)
    return b


def only(state):
    assert len(state) == 1
    return next(iter(state.values()))


def test_streak(spark):
    st = only(fold_both(spark, [quiz(1, 1000, True), quiz(2, 2000, False), quiz(3, 3000, None), quiz(4, 4000, False)]))
    assert (st["correct_answers"], st["incorrect_answers"], st["consecutive_incorrect"]) == (1, 3, 3)


def test_streak_reset(spark):
    st = only(fold_both(spark, [quiz(1, 1000, False), quiz(2, 2000, False), quiz(3, 3000, True)]))
    assert st["consecutive_incorrect"] == 0


def test_rapid_counts_negative_gaps(spark):
    rows = [quiz(1, 0, True), quiz(2, 4999, True), quiz(3, 9999, True), quiz(4, 9000, True)]
    st = only(fold_both(spark, rows))
    assert st["rapid_submissions"] == 2
    assert st["answer_timestamps"] == [0, 4999, 9999, 9000]


def test_rapid_and_streak_across_buckets(spark):
    # bucket width 2: every pair of offsets is its own bucket, so gaps and the
    # streak must be stitched across bucket boundaries
    rows = [quiz(i, i * 1000, i in (2, 5), 1000) for i in range(1, 10)]
    st = only(fold_both(spark, rows, bucket=2))
    assert st["rapid_submissions"] == 8
    assert st["consecutive_incorrect"] == 4


def test_one_answer(spark):
    st = only(fold_both(spark, [quiz(1, 0, True, 8500)]))
    assert st["rapid_submissions"] == 0 and st["first_event_ms"] == st["last_event_ms"] == 0


def test_pages(spark):
    rows = [
        sess(1, "NAVIGATION", 10, page="p1"),
        sess(2, "NAVIGATION", 20, page="p1"),
        sess(3, "NAVIGATION", 30),
        sess(4, "DWELL", 40, page="p2", dwell=500),
    ]
    st = only(fold_both(spark, rows))
    assert st["navigation_events"] == 3 and st["pages_visited"] == ["p1"] and st["total_dwell_time"] == 500


def test_started_and_unknown_session_type(spark):
    for stype in ["STARTED", "FOCUS_LOST"]:
        st = only(fold_both(spark, [sess(1, stype, 1234)]))
        assert st["navigation_events"] == st["pause_events"] == st["resume_events"] == 0
        assert st["first_event_ms"] == st["last_event_ms"] == 1234


def test_heartbeat_only_window_still_scored(spark):
    rows = [ev(1, "system.heartbeat", 1000)]
    q, s = topics(spark, rows)
    out = build_scores(q, s, late="keep").collect()
    assert len(out) == 1
    r = out[0]
    assert r.first_event_ms is None and r.score == 0.6000000238418579 and r.trend == "STABLE"


def test_first_session_is_first_arrival_any_type(spark):
    rows = [ev(1, "system.heartbeat", 5000, session="A"), quiz(2, 1000, True, session="B")]
    st = only(fold_both(spark, rows))
    assert st["session_id"] == "A"


def test_first_session_null_is_kept(spark):
    rows = [ev(1, "system.heartbeat", 5000, session=None), quiz(2, 1000, True, session="B")]
    st = only(fold_both(spark, rows))
    assert st["session_id"] is None


def test_skills_and_hints(spark):
    rows = [
        quiz(1, 0, True, skill="a", hints=2),
        quiz(2, 10, True, skill="a"),
        quiz(3, 20, False, skill="b", hints=1),
        quiz(4, 30, False),
    ]
    st = only(fold_both(spark, rows))
    assert st["skill_tag_attempts"] == {"a": 2, "b": 1} and st["unique_skills_attempted"] == 2
    assert st["total_hints_used"] == 3


def test_windows_split_on_record_time_not_event_time(spark):
    # event time inside the first minute, record time in the second
    rows = [quiz(1, 59000, True, record_ms=61000), quiz(2, 1000, True, record_ms=1000)]
    st = fold_both(spark, rows)
    assert sorted(k[1] for k in st) == [0, 60000]


def test_null_student_is_dropped(spark):
    rows = [quiz(1, 0, True, student=None), quiz(2, 0, True)]
    q, s = topics(spark, rows)
    out = build_scores(q, s, late="keep").collect()
    assert [r.student_id for r in out] == ["s1"]
