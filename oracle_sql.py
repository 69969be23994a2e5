"""DuckDB oracle SQL for every registered query (views: the parquet tables).

Written independently of the Spark code: plain window functions over the
whole group where the engine uses bucketed scans, running sums where the
engine uses higher-order functions, and the float32 widening spelled as
``CAST(CAST(x AS FLOAT) AS DOUBLE)``.
"""

from __future__ import annotations

# Fixed values of the score, spelled here and not taken from the engine, so that a
# wrong default of the engine shows.
DEFAULT = {
    "accuracy": 0.4, "dwell": 0.3, "pacing": 0.3,
    "alert": 0.4, "yellow": 0.4, "green": 0.7,
    "struggling_ms": 15000, "rushing_ms": 5000,
    "expected_questions_per_minute": 0.5, "tolerance_percent": 0.2,
}
TUNED = DEFAULT | {"yellow": 0.7, "expected_questions_per_minute": 4.0, "tolerance_percent": 0.5}

# The events fixture (compressed clock, derived quiz/session fields, offsets).
FIXTURE = """
b AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         (epoch_us(ts) - 1704067200000000) // 3600000 AS rel_ms
  FROM events),
c AS (
  SELECT event_id, event_id % 4 AS kafka_partition,
         1704067200000 + rel_ms AS record_ms,
         1704067200000 + rel_ms - (k % 3) * 700 AS event_ms,
         rel_ms + CASE k % 10 WHEN 0 THEN 12000 WHEN 1 THEN 4000 ELSE 0 END AS arrival_ms,
         'student-' || CAST(user_id AS VARCHAR) AS student_id,
         'session-' || CAST(user_id AS VARCHAR) || '-' || CAST(rel_ms // 45000 AS VARCHAR) AS session_id,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'quiz.answered'
              WHEN event_type = 'error' AND k % 5 = 0 THEN 'system.heartbeat'
              WHEN event_type = 'view' THEN 'session.navigation'
              WHEN event_type = 'signup' THEN 'session.dwell'
              WHEN k % 2 = 0 THEN 'session.paused'
              WHEN k % 3 = 0 THEN 'session.started'
              ELSE 'session.resumed' END AS event_type,
         k, value
  FROM b),
fx AS (
  SELECT event_id, kafka_partition,
         CASE WHEN event_type = 'quiz.answered' THEN 'quiz.answers' ELSE 'session.events' END AS topic,
         row_number() OVER (PARTITION BY event_type = 'quiz.answered', kafka_partition
                            ORDER BY arrival_ms, event_id) AS kafka_offset,
         record_ms, event_ms, student_id, session_id, event_type,
         CASE WHEN event_type = 'quiz.answered' THEN 'q-' || CAST(k AS VARCHAR) END AS question_id,
         CASE WHEN event_type = 'quiz.answered' AND k % 11 <> 0 THEN k % 3 <> 0 END AS is_correct,
         CASE WHEN event_type = 'quiz.answered' AND k % 13 <> 0 THEN CAST(round(value * 200) AS BIGINT) END AS time_spent_ms,
         CASE WHEN event_type = 'quiz.answered' AND k % 7 <> 0 THEN CAST(k % 4 AS BIGINT) END AS hints_used,
         CASE WHEN event_type = 'quiz.answered' AND k % 17 <> 0 THEN 'skill-' || CAST(k % 7 AS VARCHAR) END AS skill_tag,
         CASE WHEN event_type = 'quiz.answered' THEN CAST(1 + k % 5 AS BIGINT) END AS difficulty_level,
         CASE WHEN event_type LIKE 'session.%' THEN upper(substr(event_type, 9)) END AS session_event_type,
         CASE WHEN event_type = 'session.navigation' AND k % 6 <> 0 THEN 'page-' || CAST(k % 12 AS VARCHAR) END AS page_id,
         CASE WHEN event_type = 'session.dwell' AND k % 8 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS dwell_time_ms
  FROM c),
ev AS (
  SELECT *, record_ms - record_ms % 60000 AS window_start_ms,
         record_ms - record_ms % 60000 + 60000 AS window_end_ms,
         event_type = 'quiz.answered' AS is_quiz,
         event_type LIKE 'session.%' AS is_session,
         coalesce(is_correct, false) AS ok,
         -- place in the arrival order: record time, topic, partition, offset
         row_number() OVER (ORDER BY record_ms, topic, kafka_partition, kafka_offset) AS seq
  FROM fx)"""

# Stream time per record and the events that survive the 5 s grace.
LATE = """
lt AS (
  SELECT *, max(record_ms) OVER (PARTITION BY topic, kafka_partition ORDER BY kafka_offset
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_time_ms
  FROM ev),
ev_on_time AS (SELECT * FROM lt WHERE window_end_ms > stream_time_ms - 5000)"""

DEFECTS = """
d AS (
  SELECT *, CASE WHEN event_id % 19 = 0 THEN 'truncated'
                 WHEN event_id % 41 = 0 THEN 'empty'
                 WHEN event_id % 23 = 0 THEN 'null_type'
                 WHEN event_id % 29 = 0 AND (event_type = 'quiz.answered' OR event_type LIKE 'session.%') THEN 'null_time'
                 WHEN event_id % 31 = 0 AND event_type LIKE 'session.%' THEN 'null_session_type'
                 WHEN event_id % 37 = 0 THEN 'null_student' END AS defect
  FROM fx)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _state(src: str) -> str:
    """Final window state from event CTE ``src`` (CTEs st_*, named by src)."""
    return f"""
{src}_ans AS (
  SELECT student_id, window_start_ms, seq, ok,
         event_ms - lag(event_ms) OVER (PARTITION BY student_id, window_start_ms ORDER BY seq) AS gap
  FROM {src} WHERE is_quiz),
{src}_lastok AS (
  SELECT student_id, window_start_ms, max(CASE WHEN ok THEN seq END) AS last_ok
  FROM {src}_ans GROUP BY student_id, window_start_ms),
{src}_ord AS (
  SELECT a.student_id, a.window_start_ms,
         sum(CASE WHEN a.gap < 5000 THEN 1 ELSE 0 END) AS rapid,
         sum(CASE WHEN NOT a.ok AND (l.last_ok IS NULL OR a.seq > l.last_ok) THEN 1 ELSE 0 END) AS streak
  FROM {src}_ans a JOIN {src}_lastok l ON a.student_id = l.student_id AND a.window_start_ms = l.window_start_ms
  GROUP BY a.student_id, a.window_start_ms),
{src}_first AS (
  SELECT student_id, window_start_ms, session_id FROM (
    SELECT student_id, window_start_ms, session_id,
           row_number() OVER (PARTITION BY student_id, window_start_ms ORDER BY seq) AS rn
    FROM {src}) WHERE rn = 1),
{src}_agg AS (
  SELECT student_id, window_start_ms, window_end_ms,
         sum(CASE WHEN is_quiz THEN 1 ELSE 0 END) AS total,
         sum(CASE WHEN is_quiz AND ok THEN 1 ELSE 0 END) AS correct,
         sum(CASE WHEN is_quiz AND time_spent_ms IS NOT NULL THEN 1 ELSE 0 END) AS nt,
         sum(CASE WHEN is_quiz THEN coalesce(time_spent_ms, 0) ELSE 0 END) AS tt,
         min(CASE WHEN is_quiz OR is_session THEN event_ms END) AS f,
         max(CASE WHEN is_quiz OR is_session THEN event_ms END) AS l
  FROM {src} GROUP BY student_id, window_start_ms, window_end_ms),
{src}_st AS (
  SELECT g.*, s.session_id, coalesce(o.rapid, 0) AS rapid, coalesce(o.streak, 0) AS streak,
         CASE WHEN g.total = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(g.correct AS DOUBLE) / CAST(g.total AS DOUBLE) END AS rate,
         CASE WHEN g.nt = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(g.tt AS DOUBLE) / CAST(g.nt AS DOUBLE) END AS avg_t,
         CASE WHEN g.f IS NULL OR g.l = g.f THEN CAST(0 AS DOUBLE)
              ELSE CAST(g.total AS DOUBLE) / (CAST(g.l - g.f AS DOUBLE) / CAST(60000 AS DOUBLE)) END AS qpm
  FROM {src}_agg g
  JOIN {src}_first s ON g.student_id = s.student_id AND g.window_start_ms = s.window_start_ms
  LEFT JOIN {src}_ord o ON g.student_id = o.student_id AND g.window_start_ms = o.window_start_ms)"""


def _f(x: float) -> str:
    return f"CAST(CAST({x!r} AS FLOAT) AS DOUBLE)"


def _score(state: str, v: dict, name: str) -> str:
    """Components, score, trend, alert on top of a state CTE."""
    lo = f"({_f(v['expected_questions_per_minute'])} * (1 - {_f(v['tolerance_percent'])}))"
    hi = f"({_f(v['expected_questions_per_minute'])} * (1 + {_f(v['tolerance_percent'])}))"
    return f"""
{name}_c AS (
  SELECT *,
         CASE WHEN total = 0 THEN CAST(0 AS DOUBLE) ELSE rate END AS accuracy_score,
         CASE WHEN total = 0 THEN CAST(1 AS DOUBLE)
              WHEN avg_t > {v['struggling_ms']} THEN CAST(0.3 AS DOUBLE)
              WHEN avg_t < {v['rushing_ms']} THEN CAST(0.5 AS DOUBLE)
              ELSE CAST(1 AS DOUBLE) END AS dwell_score,
         CASE WHEN total = 0 THEN CAST(1 AS DOUBLE)
              WHEN qpm >= {lo} AND qpm <= {hi} THEN CAST(1 AS DOUBLE)
              ELSE CAST(0.7 AS DOUBLE) END AS pacing_score
  FROM {state}),
{name}_s AS (
  SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE),
           accuracy_score * {_f(v['accuracy'])} + dwell_score * {_f(v['dwell'])} + pacing_score * {_f(v['pacing'])})) AS score
  FROM {name}_c),
{name} AS (
  SELECT *,
         CASE WHEN score < {_f(v['alert'])} THEN 'CRITICAL'
              WHEN score < {_f(v['yellow'])} THEN 'DECLINING'
              WHEN rate > CAST(0.7 AS DOUBLE) AND avg_t >= {v['rushing_ms']} AND avg_t <= {v['struggling_ms']}
                   AND score >= CAST(0.8 AS DOUBLE) THEN 'RISING'
              ELSE 'STABLE' END AS trend,
         score < {_f(v['alert'])} AS alert_threshold_crossed,
         CASE WHEN score >= {_f(v['green'])} THEN 'GREEN' WHEN score >= {_f(v['yellow'])} THEN 'YELLOW' ELSE 'ALERT' END AS zone
  FROM {name}_s)"""


SCORE_COLS = """student_id, session_id, window_start_ms, window_end_ms, CAST(total AS BIGINT) AS total_answers,
       accuracy_score, dwell_score, pacing_score, score, trend, alert_threshold_crossed"""


def _scores_sql(v: dict = DEFAULT, late: bool = False) -> str:
    src = "ev_on_time" if late else "ev"
    parts = [FIXTURE] + ([LATE] if late else []) + [_state(src), _score(f"{src}_st", v, "sc")]
    return _with(*parts)


def oracle_sql() -> dict[str, str]:
    scores = _scores_sql()
    q: dict[str, str] = {}

    q["decode_json_skip_bad"] = _with(FIXTURE, DEFECTS) + """
SELECT CAST(event_id AS VARCHAR) AS event_id, topic,
       CASE WHEN defect = 'null_student' THEN NULL ELSE student_id END AS student_id,
       session_id,
       CASE WHEN defect = 'null_type' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN defect = 'null_time' THEN NULL ELSE event_ms END AS event_ms,
       question_id, is_correct, time_spent_ms, hints_used, difficulty_level, skill_tag,
       CASE WHEN defect = 'null_session_type' THEN NULL ELSE session_event_type END AS session_event_type,
       page_id, dwell_time_ms, kafka_partition, kafka_offset, record_ms
FROM d WHERE defect IS NULL OR defect NOT IN ('truncated', 'empty')"""

    q["malformed_split"] = _with(FIXTURE, DEFECTS) + """
SELECT event_id, topic, kafka_partition, kafka_offset,
       CASE defect WHEN 'truncated' THEN 'corrupt_payload' WHEN 'empty' THEN 'empty_payload'
                   WHEN 'null_type' THEN 'null_event_type' WHEN 'null_time' THEN 'null_event_time'
                   WHEN 'null_session_type' THEN 'null_session_type'
                   WHEN 'null_student' THEN 'null_student_id' END AS reason
FROM d WHERE defect IS NOT NULL"""

    q["enrich_quiz"] = _with(FIXTURE) + """
SELECT CAST(event_id AS VARCHAR) AS event_id, student_id, session_id, event_ms, event_type, question_id,
       is_correct, time_spent_ms, hints_used, difficulty_level, skill_tag, 'events-fixture' AS source,
       record_ms, kafka_partition, kafka_offset
FROM fx WHERE event_type = 'quiz.answered'"""

    q["enrich_session"] = _with(FIXTURE) + """
SELECT CAST(event_id AS VARCHAR) AS event_id, student_id, session_id, event_ms, event_type, session_event_type,
       page_id, dwell_time_ms, 'events-fixture' AS source, record_ms, kafka_partition, kafka_offset
FROM fx WHERE event_type <> 'quiz.answered'"""

    q["merge_streams"] = _with(FIXTURE) + """
SELECT CAST(event_id AS VARCHAR) AS event_id, student_id, event_type, event_ms, record_ms, kafka_offset,
       event_type = 'quiz.answered' AS is_quiz, event_type LIKE 'session.%' AS is_session
FROM fx"""

    q["event_routing"] = _with(FIXTURE) + """
SELECT event_type,
       CASE WHEN is_quiz THEN 'quiz' WHEN is_session THEN 'session' ELSE 'none' END AS route,
       count(*) AS events,
       count(DISTINCT student_id || '@' || CAST(window_start_ms AS VARCHAR)) AS windows
FROM ev GROUP BY 1, 2"""

    q["window_counts"] = _with(FIXTURE) + """
SELECT student_id, window_start_ms, window_end_ms,
       count(*) FILTER (WHERE is_quiz) AS total_answers,
       count(*) FILTER (WHERE is_quiz AND ok) AS correct_answers,
       count(*) FILTER (WHERE is_quiz AND NOT ok) AS incorrect_answers,
       count(*) FILTER (WHERE is_session AND session_event_type = 'NAVIGATION') AS navigation_events,
       count(*) FILTER (WHERE is_session AND session_event_type = 'PAUSED') AS pause_events,
       count(*) FILTER (WHERE is_session AND session_event_type = 'RESUMED') AS resume_events
FROM ev GROUP BY student_id, window_start_ms, window_end_ms"""

    q["window_sums"] = _with(FIXTURE) + """
SELECT student_id, window_start_ms,
       count(time_spent_ms) FILTER (WHERE is_quiz) AS n_time_values,
       CAST(coalesce(sum(time_spent_ms) FILTER (WHERE is_quiz), 0) AS BIGINT) AS total_time_spent,
       CAST(coalesce(sum(hints_used) FILTER (WHERE is_quiz), 0) AS BIGINT) AS total_hints_used,
       CAST(coalesce(sum(dwell_time_ms) FILTER (WHERE is_session AND session_event_type = 'DWELL'), 0) AS BIGINT)
         AS total_dwell_time
FROM ev GROUP BY student_id, window_start_ms"""

    q["window_first_session"] = _with(FIXTURE) + """
SELECT student_id, window_start_ms, session_id FROM (
  SELECT student_id, window_start_ms, session_id,
         row_number() OVER (PARTITION BY student_id, window_start_ms ORDER BY seq) AS rn
  FROM ev) WHERE rn = 1"""

    q["window_time_bounds"] = _with(FIXTURE) + """
SELECT student_id, window_start_ms,
       min(event_ms) FILTER (WHERE is_quiz OR is_session) AS first_event_ms,
       max(event_ms) FILTER (WHERE is_quiz OR is_session) AS last_event_ms,
       coalesce(max(event_ms) FILTER (WHERE is_quiz OR is_session)
                - min(event_ms) FILTER (WHERE is_quiz OR is_session), 0) AS active_time_ms
FROM ev GROUP BY student_id, window_start_ms"""

    q["answer_lists"] = _with(FIXTURE) + """
SELECT student_id, window_start_ms,
       row_number() OVER (PARTITION BY student_id, window_start_ms ORDER BY seq) AS position,
       event_ms, time_spent_ms
FROM ev WHERE is_quiz"""

    q["incorrect_streak"] = _with(FIXTURE, _state("ev")) + """
SELECT student_id, window_start_ms, CAST(total AS BIGINT) AS total_answers,
       CAST(streak AS BIGINT) AS consecutive_incorrect
FROM ev_st WHERE total > 0"""

    q["rapid_submissions"] = _with(FIXTURE) + """,
g AS (SELECT student_id, window_start_ms,
             event_ms - lag(event_ms) OVER (PARTITION BY student_id, window_start_ms ORDER BY seq) AS gap
      FROM ev WHERE is_quiz)
SELECT student_id, window_start_ms, count(*) AS total_answers,
       count(*) FILTER (WHERE gap < 5000) AS rapid_submissions
FROM g GROUP BY student_id, window_start_ms"""

    q["skill_attempts"] = _with(FIXTURE) + """,
t AS (SELECT student_id, window_start_ms, skill_tag, count(*) AS n
      FROM ev WHERE is_quiz AND skill_tag IS NOT NULL GROUP BY 1, 2, 3)
SELECT student_id, window_start_ms, count(*) AS unique_skills_attempted,
       string_agg(skill_tag || ':' || CAST(n AS VARCHAR), ',' ORDER BY skill_tag) AS skill_tag_attempts
FROM t GROUP BY student_id, window_start_ms"""

    q["pages_visited"] = _with(FIXTURE) + """,
nav AS (SELECT student_id, window_start_ms, page_id FROM ev WHERE is_session AND session_event_type = 'NAVIGATION'),
p AS (SELECT DISTINCT student_id, window_start_ms, page_id FROM nav WHERE page_id IS NOT NULL),
pa AS (SELECT student_id, window_start_ms, count(*) AS n_pages, string_agg(page_id, ',' ORDER BY page_id) AS pages
       FROM p GROUP BY 1, 2),
n AS (SELECT student_id, window_start_ms, count(*) AS navigation_events FROM nav GROUP BY 1, 2)
SELECT n.student_id, n.window_start_ms, n.navigation_events, coalesce(pa.n_pages, 0) AS n_pages,
       coalesce(pa.pages, '') AS pages_visited
FROM n LEFT JOIN pa ON n.student_id = pa.student_id AND n.window_start_ms = pa.window_start_ms"""

    q["window_state"] = _with(FIXTURE, _state("ev")) + """,
t AS (SELECT student_id, window_start_ms, skill_tag, count(*) AS n
      FROM ev WHERE is_quiz AND skill_tag IS NOT NULL GROUP BY 1, 2, 3),
sk AS (SELECT student_id, window_start_ms, count(*) AS u,
              string_agg(skill_tag || ':' || CAST(n AS VARCHAR), ',' ORDER BY skill_tag) AS m FROM t GROUP BY 1, 2),
p AS (SELECT DISTINCT student_id, window_start_ms, page_id FROM ev
      WHERE is_session AND session_event_type = 'NAVIGATION' AND page_id IS NOT NULL),
pa AS (SELECT student_id, window_start_ms, string_agg(page_id, ',' ORDER BY page_id) AS pages FROM p GROUP BY 1, 2),
cnt AS (
  SELECT student_id, window_start_ms,
         count(*) FILTER (WHERE is_quiz AND NOT ok) AS incorrect_answers,
         CAST(coalesce(sum(hints_used) FILTER (WHERE is_quiz), 0) AS BIGINT) AS total_hints_used,
         count(*) FILTER (WHERE is_session AND session_event_type = 'NAVIGATION') AS navigation_events,
         count(*) FILTER (WHERE is_session AND session_event_type = 'PAUSED') AS pause_events,
         count(*) FILTER (WHERE is_session AND session_event_type = 'RESUMED') AS resume_events,
         CAST(coalesce(sum(dwell_time_ms) FILTER (WHERE is_session AND session_event_type = 'DWELL'), 0) AS BIGINT)
           AS total_dwell_time
  FROM ev GROUP BY 1, 2)
SELECT s.student_id, s.session_id, s.window_start_ms, s.window_end_ms,
       CAST(s.total AS BIGINT) AS total_answers, CAST(s.correct AS BIGINT) AS correct_answers,
       c.incorrect_answers, CAST(s.streak AS BIGINT) AS consecutive_incorrect, CAST(s.rapid AS BIGINT) AS rapid_submissions,
       CAST(s.nt AS BIGINT) AS n_time_values, CAST(s.tt AS BIGINT) AS total_time_spent, c.total_hints_used,
       c.navigation_events, c.pause_events, c.resume_events, c.total_dwell_time,
       s.f AS first_event_ms, s.l AS last_event_ms, coalesce(s.l - s.f, 0) AS active_time_ms,
       coalesce(sk.u, 0) AS unique_skills_attempted, coalesce(sk.m, '') AS skill_tag_attempts,
       coalesce(pa.pages, '') AS pages_visited
FROM ev_st s
JOIN cnt c ON s.student_id = c.student_id AND s.window_start_ms = c.window_start_ms
LEFT JOIN sk ON s.student_id = sk.student_id AND s.window_start_ms = sk.window_start_ms
LEFT JOIN pa ON s.student_id = pa.student_id AND s.window_start_ms = pa.window_start_ms"""

    q["window_metrics"] = _with(FIXTURE, _state("ev")) + """
SELECT student_id, window_start_ms, rate AS correctness_rate, avg_t AS average_time_spent,
       qpm AS questions_per_minute
FROM ev_st"""

    q["pattern_flags"] = _with(FIXTURE, _state("ev")) + """
SELECT student_id, window_start_ms, CAST(streak AS BIGINT) AS consecutive_incorrect,
       CAST(rapid AS BIGINT) AS rapid_submissions,
       streak >= 3 AND rapid >= 2 AS rapid_incorrect_pattern,
       avg_t > 20000 AND rate < 0.5 AS struggling_pattern
FROM ev_st"""

    q["score_components"] = scores + """
SELECT student_id, window_start_ms, accuracy_score, dwell_score, pacing_score,
       CAST(NULL AS DOUBLE) AS attention_score
FROM sc"""

    q["engagement_scores"] = scores + f"\nSELECT {SCORE_COLS} FROM sc"
    q["engagement_scores_tuned"] = _scores_sql(TUNED) + f"\nSELECT {SCORE_COLS} FROM sc"
    q["late_filtered_scores"] = _scores_sql(late=True) + f"\nSELECT {SCORE_COLS} FROM sc"

    q["late_records"] = _with(FIXTURE, LATE) + """
SELECT CAST(event_id AS VARCHAR) AS event_id, kafka_partition, kafka_offset, record_ms, window_end_ms, stream_time_ms
FROM lt WHERE window_end_ms <= stream_time_ms - 5000"""

    q["score_changelog"] = _with(FIXTURE) + """,
gaps AS (
  SELECT event_id,
         event_ms - lag(event_ms) OVER (PARTITION BY student_id, window_start_ms ORDER BY seq) AS gap
  FROM ev WHERE is_quiz),
e2 AS (SELECT ev.*, coalesce(gaps.gap < 5000, false) AS rapid_flag FROM ev LEFT JOIN gaps USING (event_id)),
r AS (
  SELECT *,
    sum(CASE WHEN is_quiz THEN 1 ELSE 0 END) OVER w AS total,
    sum(CASE WHEN is_quiz AND ok THEN 1 ELSE 0 END) OVER w AS correct,
    sum(CASE WHEN is_quiz AND NOT ok THEN 1 ELSE 0 END) OVER w AS wrong_run,
    sum(CASE WHEN is_quiz AND time_spent_ms IS NOT NULL THEN 1 ELSE 0 END) OVER w AS nt,
    sum(CASE WHEN is_quiz THEN coalesce(time_spent_ms, 0) ELSE 0 END) OVER w AS tt,
    min(CASE WHEN is_quiz OR is_session THEN event_ms END) OVER w AS f,
    max(CASE WHEN is_quiz OR is_session THEN event_ms END) OVER w AS l,
    sum(CASE WHEN rapid_flag THEN 1 ELSE 0 END) OVER w AS rapid
  FROM e2
  WINDOW w AS (PARTITION BY student_id, window_start_ms ORDER BY seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
r2 AS (
  SELECT *, wrong_run - coalesce(max(CASE WHEN is_quiz AND ok THEN wrong_run END) OVER (
              PARTITION BY student_id, window_start_ms ORDER BY seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS streak
  FROM r),
st AS (
  SELECT *,
    CASE WHEN total = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(correct AS DOUBLE) / CAST(total AS DOUBLE) END AS rate,
    CASE WHEN nt = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(tt AS DOUBLE) / CAST(nt AS DOUBLE) END AS avg_t,
    CASE WHEN f IS NULL OR l = f THEN CAST(0 AS DOUBLE)
         ELSE CAST(total AS DOUBLE) / (CAST(l - f AS DOUBLE) / CAST(60000 AS DOUBLE)) END AS qpm
  FROM r2),""" + _score("st", DEFAULT, "sc") + """
SELECT CAST(event_id AS VARCHAR) AS event_id, student_id, window_start_ms, kafka_offset,
       CAST(total AS BIGINT) AS total_answers, CAST(correct AS BIGINT) AS correct_answers,
       CAST(streak AS BIGINT) AS consecutive_incorrect, CAST(rapid AS BIGINT) AS rapid_submissions,
       score, trend, alert_threshold_crossed
FROM sc"""

    q["alerts"] = scores + """
SELECT student_id, window_start_ms, score, trend, CAST(total AS BIGINT) AS total_answers
FROM sc WHERE alert_threshold_crossed"""

    q["score_zones"] = scores + "\nSELECT student_id, window_start_ms, score, zone FROM sc"

    q["score_monitor"] = scores + """
SELECT window_start_ms, count(*) AS scores_produced,
       count(*) FILTER (WHERE alert_threshold_crossed) AS alerts_triggered,
       min(score) AS min_score, max(score) AS max_score, round(avg(score), 9) AS avg_score,
       count(*) FILTER (WHERE trend = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE trend = 'DECLINING') AS declining,
       count(*) FILTER (WHERE trend = 'STABLE') AS stable,
       count(*) FILTER (WHERE trend = 'RISING') AS rising
FROM sc GROUP BY window_start_ms"""

    q["score_histogram"] = scores + """
SELECT CAST(least(floor(score * 10), 9) AS BIGINT) AS bucket, count(*) AS scores
FROM sc GROUP BY 1"""

    q["score_messages"] = scores + """
SELECT student_id AS key, window_start_ms,
       sha256(student_id || ':' || CAST(window_start_ms AS VARCHAR)) AS envelope_id,
       'engagement.scored' AS envelope_type, 'learner-scoring' AS envelope_source, '1.0' AS specversion,
       session_id, score, accuracy_score, CAST(NULL AS DOUBLE) AS attention_score, trend, alert_threshold_crossed
FROM sc"""

    q["streaming_scores"] = q["engagement_scores"]
    q["decode_by_schema_id"] = _with(FIXTURE, DEFECTS) + """,
g AS (SELECT *, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 99 ELSE 1 + event_id % 2 END AS schema_id FROM d),
h AS (SELECT *, CASE WHEN schema_id IS NULL THEN 'no_frame' WHEN schema_id = 99 THEN 'unknown_schema_id'
                     WHEN defect IN ('truncated', 'empty') THEN 'corrupt_payload' END AS reason FROM g)
SELECT event_id, topic, CAST(schema_id AS BIGINT) AS schema_id, reason,
       CASE WHEN reason IS NULL AND coalesce(defect, '') <> 'null_student' THEN student_id END AS student_id,
       CASE WHEN reason IS NULL AND schema_id = 1 THEN CASE WHEN topic = 'quiz.answers' THEN skill_tag ELSE page_id END END AS newest
FROM h"""
    q["window_state_merged"] = q["window_state"]
    q["streaming_late_scores"] = q["late_filtered_scores"]
    q["streaming_late_records"] = q["late_records"]
    q["streaming_changelog"] = q["score_changelog"]
    q["backfill_then_stream"] = q["engagement_scores"]
    q["committed_scores"] = q["engagement_scores"]
    # a window ends when all clocks have passed its end and the grace period
    q["open_windows"] = f"""
SELECT * FROM ({q["window_counts"]}) w
WHERE window_end_ms > (SELECT max((epoch_us(ts) - 1704067200000000) // 3600000 + 1704067200000) FROM events) - 5000"""
    # sketches of 4,096 entries hold so few scores exactly
    q["score_quantiles"] = scores + """
SELECT window_start_ms // 300000 * 300000 AS span_start_ms, count(*) AS scores,
       quantile_disc(score, 0.1) AS p10, quantile_disc(score, 0.5) AS p50, quantile_disc(score, 0.9) AS p90
FROM sc GROUP BY 1"""
    return q
