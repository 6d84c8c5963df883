"""The registered queries as SQL, for checking.

History is written as joins of a key's rows with themselves (quadratic, fit for small tables only),
so that it shares nothing with the window frames it checks.
"""

from __future__ import annotations

from playthrough.schemas import FEATURE_COLUMNS

AS_OF = "2025-01-01"

_RAW = """
base AS (
  SELECT event_id AS i, user_id, value, event_type AS kind,
         epoch_us(ts) // 1000 - 1704067200000 AS t,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
shaped AS (
  SELECT i, CAST(i AS VARCHAR) AS event_id,
         1704067200000 + (t // 518400000) * 1296000000 + ((t % 518400000) // 3000000) * 60000 AS event_ts,
         CAST(user_id AS VARCHAR) AS user_id, CAST(k % 5 AS VARCHAR) AS content_id,
         CASE kind WHEN 'view' THEN 'play' WHEN 'click' THEN 'pause' WHEN 'purchase' THEN 'complete'
                   WHEN 'signup' THEN 'stop' ELSE CASE WHEN i % 2 = 0 THEN 'seek' ELSE 'error' END
         END AS event_type,
         CASE WHEN i % 97 = 0 THEN -1 ELSE CAST(floor(value * 60) AS INT) END AS playback_position,
         CASE WHEN i % 53 = 0 THEN NULL WHEN i % 59 = 0 THEN ''
              ELSE ['mobile', 'tv', 'web', 'tablet'][CAST(i % 4 AS INT) + 1] END AS device
  FROM base),
raw AS (
  SELECT * EXCLUDE (i) FROM shaped
  UNION ALL
  SELECT * EXCLUDE (i) REPLACE (event_ts + 60000 AS event_ts) FROM shaped WHERE i % 50 = 0)"""

_CHECKED = """
checked AS (
  SELECT *, CASE
      WHEN event_ts IS NULL OR playback_position IS NULL OR coalesce(event_id, '') = ''
        OR coalesce(user_id, '') = '' OR coalesce(content_id, '') = ''
        OR coalesce(event_type, '') = '' OR coalesce(device, '') = '' THEN 'missing_field'
      WHEN NOT list_contains(['play', 'pause', 'stop', 'complete', 'seek'], event_type)
        THEN 'invalid_event_type'
      WHEN playback_position < 0 THEN 'negative_position' END AS reject_reason
  FROM {source})"""

_CLEAN = (
    _CHECKED.format(source="raw")
    + """,
clean AS (
  SELECT * EXCLUDE (reject_reason) FROM checked WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts) = 1)"""
)

_DIMS = """
viewers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, concat('user', c_custkey, '@example.com') AS email,
         c_mktsegment AS plan_tier,
         CAST(DATE '2023-01-01' + CAST((c_custkey * 7) % 700 AS INT) AS TIMESTAMP) AS signup_date
  FROM customer),
titles AS (
  SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_type AS genre, p_size * 120 AS runtime,
         CAST(1990 + p_partkey % 35 AS INT) AS release_year,
         ['G', 'PG', 'PG-13', 'R'][CAST(p_partkey % 4 AS INT) + 1] AS maturity_rating
  FROM part)"""

# nano: the playback ratio in units of 1e-9, whose sums are exact.
def _enriched_with(genre: str = "genre", release_year: str = "release_year") -> str:
    return f"""
enriched AS (
  SELECT event_id, event_ts, user_id, email, plan_tier, signup_date, content_id, {genre} AS genre, runtime,
         {release_year} AS release_year, maturity_rating, event_type, playback_position, device
  FROM clean NATURAL JOIN viewers NATURAL JOIN titles),
ev AS (
  SELECT *, (playback_position::BIGINT * 1000000000 + runtime // 2) // nullif(runtime, 0) AS nano
  FROM enriched)"""


_ENRICHED = _enriched_with()
# Titles that were renamed after some of their events, and titles without a year.
_RENAMED = _enriched_with(genre="CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 'renamed' ELSE genre END")
_UNKNOWN_YEARS = _enriched_with(release_year="CASE WHEN content_id <> '3' THEN release_year END")

_PREV = """
prev AS (
  SELECT *, coalesce(lag(event_ts) OVER (PARTITION BY user_id, content_id ORDER BY event_ts, event_id), 0)
         AS prev_ts
  FROM ev),
sess AS (
  SELECT *, CASE WHEN prev_ts = 0 OR event_ts - prev_ts > 1800000 THEN event_ts ELSE prev_ts END
         AS session_start_ts
  FROM prev)"""

_COMPLETION = """
completion AS (
  SELECT user_id, content_id, session_start_ts, max(event_ts) AS session_end_ts,
         CAST(bool_or(event_type = 'complete') AS INT) AS is_completed_event,
         CAST(bool_or(event_type = 'stop'
              AND coalesce(playback_position::DOUBLE / nullif(runtime, 0) >= 0.95, false)) AS INT) AS stopped_near_end,
         count(DISTINCT event_type) AS num_unique_events
  FROM sess GROUP BY user_id, content_id, session_start_ts)"""

_RECENT = """
recent AS (
  SELECT a.event_id, a.user_id, a.event_ts, b.event_id AS past_id, b.nano, b.genre
  FROM ev a LEFT JOIN ev b ON b.user_id = a.user_id
   AND b.event_ts BETWEEN a.event_ts - 2592000000 AND a.event_ts - 1)"""

_ACTIVITY = """
activity AS (
  SELECT event_id, user_id, event_ts, count(past_id) AS user_activity_level
  FROM recent GROUP BY 1, 2, 3)"""

_ENGAGEMENT = """
engagement AS (
  SELECT event_id, user_id, event_ts,
         CAST(sum(nano) AS DOUBLE) / 1000000000 / count(nano) AS user_content_engagement
  FROM recent WHERE past_id IS NOT NULL GROUP BY 1, 2, 3)"""

_GENRE = """
genre_counts AS (
  SELECT event_id, user_id, event_ts, genre, count(past_id) AS n FROM recent GROUP BY 1, 2, 3, 4),
genre_best AS (
  SELECT event_id, user_id, event_ts, genre AS user_genre_preference FROM genre_counts
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY n DESC, genre) = 1)"""

_RATES = """
user_rate AS (
  SELECT e.event_id, e.user_id,
         coalesce(avg(CAST(c.is_completed_event = 1 OR c.stopped_near_end = 1 AS INT)), 0.0) AS user_completion_rate
  FROM ev e LEFT JOIN completion c ON c.user_id = e.user_id AND c.session_end_ts < e.event_ts
  GROUP BY 1, 2),
title_rate AS (
  SELECT e.event_id, e.content_id,
         coalesce(avg(CAST(c.is_completed_event = 1 OR c.stopped_near_end = 1 AS INT)), 0.0) AS content_completion_rate
  FROM ev e LEFT JOIN completion c ON c.content_id = e.content_id AND c.session_end_ts < e.event_ts
  GROUP BY 1, 2)"""

_VIEW_RATIO = """
view_ratio AS (
  SELECT a.event_id, a.content_id,
         CAST(sum(b.nano) AS DOUBLE) / 1000000000 / count(b.nano) AS average_viewing_duration_ratio
  FROM ev a LEFT JOIN ev b ON b.content_id = a.content_id AND b.event_ts < a.event_ts AND b.event_type = 'stop'
  GROUP BY 1, 2)"""

_PLAYED = """
played AS (
  SELECT event_id, user_id, content_id, CAST(EXISTS (
           SELECT * FROM ev b WHERE (b.user_id, b.content_id) = (a.user_id, a.content_id)
            AND b.event_ts < a.event_ts) AS INT) AS has_played_before
  FROM ev a)"""

_PAUSES = """
pauses AS (
  SELECT a.event_id, a.user_id, a.content_id, count(*) AS number_of_pauses
  FROM sess a JOIN sess b USING (user_id, content_id, session_start_ts)
  WHERE b.event_type = 'pause' AND b.event_ts <= a.event_ts
  GROUP BY 1, 2, 3)"""

_POPULARITY = """
popularity AS (
  SELECT a.event_id, a.content_id, count(DISTINCT b.user_id) AS content_popularity
  FROM ev a LEFT JOIN ev b ON b.content_id = a.content_id AND b.event_ts < a.event_ts
  GROUP BY 1, 2)"""

_GAP = """
gap AS (
  SELECT *, max(CASE WHEN prev_ts = 0 OR event_ts - prev_ts > 1800000 THEN event_ts END) OVER (
           PARTITION BY user_id, content_id ORDER BY event_ts, event_id
           ROWS UNBOUNDED PRECEDING) AS gap_start_ts
  FROM prev)"""

_TIMING = """
timing AS (
  SELECT s.event_id, s.event_ts, s.user_id, s.content_id,
         s.event_ts - s.prev_ts AS time_since_last_event,
         s.event_ts - lag(s.event_ts, 1, 0) OVER u AS time_since_last_event_user,
         s.event_ts - coalesce(lag(c.session_end_ts) OVER u, c.session_end_ts) AS time_since_last_completion,
         CAST(sum(c.session_end_ts - c.session_start_ts) OVER (PARTITION BY s.user_id) AS DOUBLE)
           / count(*) OVER (PARTITION BY s.user_id) AS user_avg_session_duration,
         n.user_content_session_count,
         s.session_start_ts, c.session_end_ts, c.is_completed_event, c.stopped_near_end, c.num_unique_events
  FROM sess s
  JOIN completion c USING (user_id, content_id, session_start_ts)
  JOIN (SELECT user_id, content_id, count(*) AS user_content_session_count FROM completion GROUP BY 1, 2) n
    USING (user_id, content_id)
  WHERE s.release_year IS NOT NULL
  WINDOW u AS (PARTITION BY s.user_id ORDER BY s.event_ts, s.event_id))"""

_CALENDAR = f"""
clock AS (
  SELECT event_id, make_timestamp(event_ts * 1000) AS moment,
         CAST(floor((event_ts - epoch_us(signup_date) / 1000.0) / 86400000) AS BIGINT) AS days_since_signup,
         CAST(year(DATE '{AS_OF}') AS INT) - release_year AS content_age,
         playback_position::DOUBLE / nullif(runtime, 0) AS playback_position_ratio,
         CASE WHEN runtime < 1200 THEN 'short' WHEN runtime >= 1200 AND runtime <= 3600 THEN 'medium' ELSE 'long' END
           AS content_length_category,
         release_year
  FROM ev),
calendar AS (
  SELECT event_id, days_since_signup, content_age, playback_position_ratio, content_length_category,
         CAST(hour(moment) AS INT) AS hour_of_day, CAST(dayofweek(moment) AS INT) AS day_of_week,
         CAST(year(moment) - release_year AS INT) AS content_age_at_event,
         CAST(weekofyear(moment) AS INT) AS event_week_of_year, CAST(month(moment) AS INT) AS event_month_of_year,
         CAST(year(moment) - release_year AS INT) AS time_since_content_release
  FROM clock)"""

_SESSION_STACK = [_RAW, _CLEAN, _DIMS, _ENRICHED, _PREV]
_EV_STACK = [_RAW, _CLEAN, _DIMS, _ENRICHED]

_FEATURE_PARTS = [
    _PREV, _COMPLETION, _RECENT, _ACTIVITY, _ENGAGEMENT, _GENRE, _RATES, _VIEW_RATIO, _PLAYED,
    _PAUSES, _POPULARITY, _TIMING, _CALENDAR,
    """
features AS (
  SELECT e.event_id, e.event_ts, e.plan_tier AS user_plan_tier, k.days_since_signup, a.user_activity_level,
         g.user_content_engagement, p.user_genre_preference, ur.user_completion_rate,
         e.genre AS content_genre, e.runtime AS content_runtime, e.release_year AS content_release_year,
         e.maturity_rating AS content_maturity_rating, k.content_age, tr.content_completion_rate,
         v.average_viewing_duration_ratio, e.event_type, k.playback_position_ratio, e.device,
         k.hour_of_day, k.day_of_week, t.time_since_last_event, h.has_played_before, z.number_of_pauses,
         CAST(t.is_completed_event = 1 OR (t.stopped_near_end = 1 AND t.num_unique_events > 1) AS INT)
           AS is_completion,
         t.time_since_last_event_user, t.time_since_last_completion, t.user_avg_session_duration,
         t.user_content_session_count,
         CAST(hour(make_timestamp(t.session_start_ts * 1000)) AS INT) AS session_start_hour,
         CAST(dayofweek(make_timestamp(t.session_start_ts * 1000)) AS INT) AS session_start_dow,
         o.content_popularity, v.average_viewing_duration_ratio AS content_avg_view_duration_ratio,
         k.content_age_at_event, e.genre AS user_genre_recency, k.content_length_category,
         a.user_activity_level * o.content_popularity AS user_activity_x_content_popularity,
         ur.user_completion_rate * tr.content_completion_rate AS user_completion_x_content_completion,
         k.event_week_of_year, k.event_month_of_year, k.time_since_content_release
  FROM ev e
  JOIN calendar k USING (event_id)
  JOIN timing t USING (event_id)
  JOIN activity a USING (event_id)
  LEFT JOIN engagement g USING (event_id)
  JOIN genre_best p USING (event_id)
  JOIN user_rate ur USING (event_id)
  JOIN title_rate tr USING (event_id)
  JOIN view_ratio v USING (event_id)
  JOIN played h USING (event_id)
  LEFT JOIN pauses z USING (event_id)
  JOIN popularity o USING (event_id)
  WHERE e.release_year IS NOT NULL)""",
]
_FEATURES = [*_EV_STACK, *_FEATURE_PARTS]


def _query(stack: list[str], body: str) -> str:
    return "WITH" + ",".join(stack) + "\n" + body


CATEGORICAL = (
    "user_plan_tier", "content_genre", "content_maturity_rating", "event_type", "device", "user_genre_recency",
    "content_length_category",
)
NUMERIC = [
    c
    for c in FEATURE_COLUMNS
    if c not in (*CATEGORICAL, "event_id", "event_ts", "is_completion", "user_genre_preference")
]
_TRAIN = """
train AS (
  SELECT * FROM features
  QUALIFY row_number() OVER (ORDER BY event_ts, event_id) <= floor((SELECT count(*) FROM features) * 0.8))"""
# Rows by feature (played before or not) and label: a is 1, 1; b is 1, 0; c is 0, 1; d is 0, 0.
_ONE_FEATURE = """
odds AS (
  SELECT count(*) FILTER (has_played_before = 1 AND is_completion = 1)::DOUBLE AS a,
         count(*) FILTER (has_played_before = 1 AND is_completion = 0)::DOUBLE AS b,
         count(*) FILTER (has_played_before = 0 AND is_completion = 1)::DOUBLE AS c,
         count(*) FILTER (has_played_before = 0 AND is_completion = 0)::DOUBLE AS d
  FROM features)"""

def _newton(c: float, rounds: int = 12) -> str:
    """Two features and an intercept, a step of Newton's method per round; the 3 x 3 system by Cramer's rule."""
    steps = ["""
gappy AS (
  SELECT event_id, has_played_before::DOUBLE AS x1, is_completion AS y,
         CASE WHEN CAST(event_id AS BIGINT) % 7 <> 0 THEN playback_position_ratio END AS x2 FROM features),
rows_of AS MATERIALIZED (
  SELECT event_id, x1, coalesce(x2, avg(x2) OVER ()) AS x2, y,
         count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY y)) AS w FROM gappy),
b0 AS (SELECT 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS w3)"""]
    for k in range(rounds):
        steps.append(f"""
sums{k} AS MATERIALIZED (
  SELECT sum(w * (p - y) * x1) + any_value(w1) / {c} AS g1, sum(w * (p - y) * x2) + any_value(w2) / {c} AS g2,
         sum(w * (p - y)) AS g3, sum(q * x1 * x1) + 1 / {c} AS a, sum(q * x1 * x2) AS b, sum(q * x1) AS c,
         sum(q * x2 * x2) + 1 / {c} AS d, sum(q * x2) AS e, sum(q) AS f, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3
  FROM (SELECT *, w * p * (1 - p) AS q FROM (
    SELECT *, 1 / (1 + exp(-(w1 * x1 + w2 * x2 + w3))) AS p FROM rows_of, b{k}))),
b{k + 1} AS MATERIALIZED (
  SELECT w1 - (g1 * (d * f - e * e) - b * (g2 * f - e * g3) + c * (g2 * e - d * g3)) / det AS w1,
         w2 - (a * (g2 * f - e * g3) - g1 * (b * f - e * c) + c * (b * g3 - g2 * c)) / det AS w2,
         w3 - (a * (d * g3 - g2 * e) - b * (b * g3 - g2 * c) + g1 * (b * e - d * c)) / det AS w3
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det FROM sums{k}))""")
    return ",".join([*steps, f"""
optimum AS (SELECT * FROM b{rounds})"""])


_PENALISED = _newton(0.001)

# A fixed score in [0, 1] per event, to check the metrics without a model.
_SCORED_BODY = """
scored AS (
  SELECT CAST(t.is_completed_event = 1 OR (t.stopped_near_end = 1 AND t.num_unique_events > 1) AS INT)
           AS label,
         CAST(least(100, playback_position * 100 // nullif(runtime, 0)) AS DOUBLE) / 100 AS score
  FROM ev JOIN timing t USING (event_id)),
by_score AS (
  SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM scored WHERE score IS NOT NULL GROUP BY 1),
curve AS (
  SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM by_score WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
_SCORED = [*_SESSION_STACK, _COMPLETION, _TIMING, _SCORED_BODY]

SQL = {
    "clean_events": _query([_RAW, _CLEAN], "SELECT * FROM clean"),
    "reject_counts": _query(
        [_RAW, _CHECKED.format(source="raw")],
        "SELECT reject_reason, count(*) AS n_rows FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1",
    ),
    "rejected_events": _query(
        [_RAW, _CHECKED.format(source="raw")], "SELECT * FROM checked WHERE reject_reason IS NOT NULL"
    ),
    "clean_oldest_events": _query(
        [
            _RAW,
            "\noldest AS (SELECT * FROM raw ORDER BY event_ts NULLS LAST, event_id LIMIT 10000)",
            _CHECKED.format(source="oldest"),
        ],
        "SELECT * EXCLUDE (reject_reason) FROM checked WHERE reject_reason IS NULL "
        "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts) = 1",
    ),
    "rows_to_insert": _query(
        [_RAW, _CLEAN],
        "SELECT * FROM clean WHERE event_id NOT IN ("
        "SELECT event_id FROM checked WHERE reject_reason IS NULL AND event_ts < 1705363200000)",
    ),
    "enriched_table": _query(_EV_STACK, "SELECT * FROM enriched"),
    "session_starts": _query(_SESSION_STACK, "SELECT event_id, event_ts, user_id, content_id, prev_ts FROM prev"),
    "session_identification": _query(_SESSION_STACK, "SELECT * EXCLUDE (nano, prev_ts) FROM sess"),
    "sessionize_gap": _query(
        [*_SESSION_STACK, _GAP],
        "SELECT event_id, user_id, content_id, event_ts, gap_start_ts AS session_start_ts FROM gap",
    ),
    "content_completion": _query([*_SESSION_STACK, _COMPLETION], "SELECT * FROM completion"),
    "user_activity": _query([*_EV_STACK, _RECENT, _ACTIVITY], "SELECT * FROM activity"),
    "user_engagement": _query([*_EV_STACK, _RECENT, _ENGAGEMENT], "SELECT * FROM engagement"),
    "user_genre_preference": _query([*_EV_STACK, _RECENT, _GENRE], "SELECT * FROM genre_best"),
    "user_genre_preference_long": _query([*_EV_STACK, _RECENT, _GENRE], "SELECT * FROM genre_best"),
    "user_genre_preference_long_hot_keys": _query([*_EV_STACK, _RECENT, _GENRE], "SELECT * FROM genre_best"),
    "user_genre_preference_changed_titles": _query(
        [_RAW, _CLEAN, _DIMS, _RENAMED, _RECENT, _GENRE], "SELECT * FROM genre_best"
    ),
    "user_completion_rate": _query([*_SESSION_STACK, _COMPLETION, _RATES], "SELECT * FROM user_rate"),
    "content_completion_rate": _query([*_SESSION_STACK, _COMPLETION, _RATES], "SELECT * FROM title_rate"),
    "avg_view_duration_ratio": _query([*_EV_STACK, _VIEW_RATIO], "SELECT * FROM view_ratio"),
    "has_played_before": _query([*_EV_STACK, _PLAYED], "SELECT * FROM played"),
    "number_of_pauses": _query([*_SESSION_STACK, _PAUSES], "SELECT * FROM pauses"),
    "content_popularity": _query([*_EV_STACK, _POPULARITY], "SELECT * FROM popularity"),
    "user_genre_recency": _query(
        _EV_STACK, "SELECT user_id, genre, max(event_ts) AS last_genre_event_ts FROM ev GROUP BY 1, 2"
    ),
    "user_last_session_end": _query(
        [*_SESSION_STACK, _COMPLETION],
        "SELECT user_id, max(session_end_ts) AS last_completion_ts FROM completion GROUP BY 1",
    ),
    "session_timing": _query(
        [*_SESSION_STACK, _COMPLETION, _TIMING],
        "SELECT event_id, time_since_last_event, time_since_last_event_user, time_since_last_completion, "
        "user_avg_session_duration, user_content_session_count FROM timing",
    ),
    "calendar_fields": _query([*_EV_STACK, _CALENDAR], "SELECT * FROM calendar"),
    "completion_prediction_features": _query(_FEATURES, "SELECT * FROM features"),
    "completion_prediction_features_unknown_years": _query(
        [_RAW, _CLEAN, _DIMS, _UNKNOWN_YEARS, *_FEATURE_PARTS], "SELECT * FROM features"
    ),
    "completion_prediction_features_hot_keys": _query(_FEATURES, "SELECT * FROM features"),
    "completion_prediction_features_hot_pairs": _query(_FEATURES, "SELECT * FROM features"),
    "classification_report": _query(
        _SCORED,
        """, cells AS (
  SELECT count(*) FILTER (label = 0 AND score <= 0.5) AS tn, count(*) FILTER (label = 0 AND score > 0.5) AS fp,
         count(*) FILTER (label = 1 AND score <= 0.5) AS fn, count(*) FILTER (label = 1 AND score > 0.5) AS tp
  FROM scored WHERE score IS NOT NULL),
per_class AS (
  SELECT '0' AS class, tn AS hit, fn AS false_hit, fp AS missed FROM cells
  UNION ALL SELECT '1', tp, fp, fn FROM cells),
scores AS (
  SELECT class, coalesce(hit::DOUBLE / nullif(hit + false_hit, 0), 0.0) AS precision,
         coalesce(hit::DOUBLE / nullif(hit + missed, 0), 0.0) AS recall,
         coalesce((2 * hit)::DOUBLE / nullif(2 * hit + false_hit + missed, 0), 0.0) AS f1_score,
         hit + missed AS support
  FROM per_class)
SELECT * FROM scores
UNION ALL SELECT 'accuracy', acc, acc, acc, total FROM (
  SELECT (tn + tp)::DOUBLE / (tn + fp + fn + tp) AS acc, tn + fp + fn + tp AS total FROM cells)
UNION ALL SELECT 'macro avg', (a.precision + b.precision) / 2, (a.recall + b.recall) / 2,
                 (a.f1_score + b.f1_score) / 2, a.support + b.support
  FROM scores a, scores b WHERE a.class = '0' AND b.class = '1'
UNION ALL SELECT 'weighted avg',
                 (a.precision * a.support + b.precision * b.support) / (a.support + b.support),
                 (a.recall * a.support + b.recall * b.support) / (a.support + b.support),
                 (a.f1_score * a.support + b.f1_score * b.support) / (a.support + b.support),
                 a.support + b.support
  FROM scores a, scores b WHERE a.class = '0' AND b.class = '1'""",
    ),
    "roc_auc": _query(
        _SCORED,
        "SELECT sum(neg * (2 * tp - pos))::DOUBLE / 2 / (max(p)::DOUBLE * max(n)) AS roc_auc FROM curve",
    ),
    "average_precision": _query(
        _SCORED,
        "SELECT sum(pos * floor(tp::DOUBLE / (tp + fp) * 1000000000)::BIGINT)::DOUBLE / 1000000000 / max(p) "
        "AS average_precision FROM curve",
    ),
    "roc_curve": _query(
        _SCORED,
        """, neighbours AS (
  SELECT *, row_number() OVER w AS k, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg
  FROM curve WINDOW w AS (ORDER BY score DESC))
SELECT score AS threshold, fp::DOUBLE / n AS fpr, tp::DOUBLE / p AS tpr FROM neighbours
WHERE k = 1 OR next_pos IS NULL OR (next_pos, next_neg) <> (pos, neg)
UNION ALL SELECT NULL, 0.0, 0.0""",
    ),
    "pr_curve": _query(
        _SCORED,
        "SELECT score AS threshold, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / p AS recall FROM curve "
        "UNION ALL SELECT NULL, 1.0, 0.0",
    ),
    "class_weights": _query(
        _SCORED,
        "SELECT label, count(*) AS n_rows, (SELECT count(*) FROM scored)::DOUBLE / (2 * count(*)) AS weight "
        "FROM scored GROUP BY 1",
    ),
    "chronological_split": _query(
        _EV_STACK,
        "SELECT event_id, CAST(row_number() OVER (ORDER BY event_ts, event_id) "
        "<= floor((SELECT count(*) FROM ev) * 0.8) AS INT) AS is_train FROM ev",
    ),
    "one_hot_totals": _query(
        _FEATURES,
        "SELECT concat(name, '_', category) AS feature, count(*) AS n_rows FROM features UNPIVOT ("
        "category FOR name IN (user_plan_tier, content_genre, content_maturity_rating, event_type, device, "
        "user_genre_recency, content_length_category)) GROUP BY 1",
    ),
    "imputed_means": _query(
        [*_FEATURES, _TRAIN],
        f"SELECT feature, printf('%.7e', avg(value)) AS mean FROM ("
        f"SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC)} FROM train) "
        f"UNPIVOT (value FOR feature IN ({', '.join(NUMERIC)})) GROUP BY 1",
    ),
    "one_feature_regression": _query(
        [*_FEATURES, _ONE_FEATURE],
        "SELECT 'has_played_before' AS feature, round(ln(a * d / (b * c)), 3) AS coefficient FROM odds "
        "UNION ALL SELECT '(intercept)', round(ln(c / d * (b + d) / (a + c)), 3) FROM odds",
    ),
    "one_feature_predictions": _query(
        [*_FEATURES, _ONE_FEATURE],
        "SELECT event_id, round(CASE WHEN has_played_before = 1 "
        "THEN a / (a + c) / (a / (a + c) + b / (b + d)) ELSE c / (a + c) / (c / (a + c) + d / (b + d)) END, 3) "
        "AS predicted_completion_probability FROM features, odds",
    ),
    "aligned_for_model": _query(
        _EV_STACK,
        "SELECT event_id, 0.0::DOUBLE AS user_activity_level, "
        "coalesce(playback_position::DOUBLE / nullif(runtime, 0), 0.0) AS playback_position_ratio, device FROM ev",
    ),
    "coefficient_names": _query(
        [*_FEATURES, _TRAIN],
        f"""SELECT CAST(row_number() OVER (ORDER BY kind, place, category) - 1 AS INT) AS position, feature FROM (
  SELECT 0 AS kind, unnest(range({len(NUMERIC)})) AS place, NULL AS category, unnest({list(NUMERIC)}) AS feature
  UNION ALL
  SELECT DISTINCT 1, list_position({list(CATEGORICAL)}, name), category, concat(name, '_', category)
  FROM train UNPIVOT (category FOR name IN ({', '.join(CATEGORICAL)})))""",
    ),
    "streaming_ingest": _query(
        [_RAW],
        "SELECT * FROM raw WHERE playback_position >= 0 AND device IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts) = 1",
    ),
    "streaming_ingest_remembered": _query(
        [_RAW],
        "SELECT * FROM raw WHERE playback_position >= 0 AND device IS NOT NULL "
        "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_ts) = 1",
    ),
    "streaming_quarantine": _query(
        [_RAW],
        "SELECT CASE WHEN playback_position < 0 THEN 'not_json' ELSE 'missing_key' END AS problem, "
        "count(*) AS n_messages FROM raw WHERE playback_position < 0 OR device IS NULL GROUP BY 1",
    ),
    "model_gradient": _query(
        [*_FEATURES, _TRAIN],
        f"""SELECT DISTINCT feature, 0.0::DOUBLE AS slope FROM (
  SELECT unnest({list(NUMERIC)}) AS feature
  UNION ALL
  SELECT concat(name, '_', category) FROM train UNPIVOT (category FOR name IN ({', '.join(CATEGORICAL)})))""",
    ),
    "penalised_regression": _query(
        [*_FEATURES, _PENALISED],
        "SELECT unnest(['has_played_before', 'playback_position_ratio', '(intercept)']) AS feature, "
        "round(unnest([w1, w2, w3]), 6) AS coefficient FROM optimum",
    ),
    "penalised_predictions": _query(
        [*_FEATURES, _PENALISED],
        "SELECT event_id, round(1 / (1 + exp(-(w1 * x1 + w2 * x2 + w3))), 6) AS predicted_completion_probability "
        "FROM rows_of, optimum",
    ),
    "history_in_parts": _query(
        [*_SESSION_STACK, _COMPLETION, _RECENT, _ACTIVITY, _ENGAGEMENT, _VIEW_RATIO, _PLAYED, _TIMING],
        "SELECT event_id, user_activity_level, user_content_engagement, average_viewing_duration_ratio, "
        "has_played_before, time_since_last_event FROM activity LEFT JOIN engagement USING (event_id) "
        "JOIN view_ratio USING (event_id) JOIN played USING (event_id) JOIN timing USING (event_id)",
    ),
    "inserted_by_key": _query([_RAW, _CLEAN], "SELECT * FROM clean"),
    "cleaned_in_runs": _query([_RAW, _CLEAN], "SELECT * FROM clean"),
    "loaded_from_the_catalog": "SELECT c_mktsegment AS plan_tier, count(*) AS n_users FROM customer GROUP BY 1",
    "stored_time_ranges": _query(
        _EV_STACK, "SELECT count(*) AS n_rows, 0::BIGINT AS n_overlaps, true AS in_many_files FROM ev"
    ),
    "cleaning_counts": _query(
        [_RAW, _CHECKED.format(source="raw")],
        "SELECT count(*) AS rows_read, count(*) FILTER (reject_reason IS NULL) AS rows_valid FROM checked",
    ),
}
