"""Permutation property: input row order never matters (arrival_seq does)."""


from hypothesis import given, settings
from hypothesis import strategies as st

from learner_scoring.plans.pipeline import build_scores

from tests.helpers import quiz, sess, topics

KINDS = ["NAVIGATION", "PAUSED", "RESUMED", "DWELL", "STARTED"]


def _rows(spec):
    rows = []
    for i, (kind, t, ok, tm) in enumerate(spec, start=1):
        if kind == "Q":
            rows.append(quiz(i, t, ok, tm, skill=f"k{i % 3}"))
        else:
            rows.append(sess(i, kind, t, page=f"p{i % 4}", dwell=tm))
    return rows


def _scores(spark, rows):
    q, s = topics(spark, rows)
    cols = ["student_id", "window_start_ms", "session_id", "total_answers", "consecutive_incorrect",
            "rapid_submissions", "first_event_ms", "last_event_ms", "score", "trend"]
    return sorted(tuple(r) for r in build_scores(q, s, late="keep").select(*cols).collect())


event = st.tuples(
    st.sampled_from(["Q", "Q", "Q"] + KINDS),
    st.integers(min_value=0, max_value=150000),
    st.sampled_from([True, False, None]),
    st.one_of(st.none(), st.integers(min_value=0, max_value=30000)),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(event, min_size=1, max_size=25), st.randoms(use_true_random=False))
def test_row_order_does_not_matter(spark, spec, rnd):
    rows = _rows(spec)
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    assert _scores(spark, rows) == _scores(spark, shuffled)
