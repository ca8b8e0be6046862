"""Windows, sessions, streaks and attribution over the event log, in batch and as streams."""

from __future__ import annotations

from lineloom.plans.base import query
from lineloom.session import table
from lineloom.streaming import events as E
from lineloom.streaming import replay as R
from lineloom.streaming import sessions as S

_SQL = "SELECT time_bucket(INTERVAL 1 HOUR, ts)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL"


@query(_SQL)
def windowed_counts(spark, d):
    return E.windowed_counts(table(spark, d, "events"))


@query(_SQL)
def windowed_counts_stream(spark, d):
    table(spark, d, "events")
    return E.run_available(spark, d)


_SESSIONS = """WITH e AS (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS since FROM events WHERE ts IS NOT NULL),
    s AS (SELECT *, count(*) FILTER (since IS NULL OR since > INTERVAL 6 HOUR) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS nth FROM e)
    SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, nth"""


@query(_SESSIONS)
def user_sessions(spark, d):
    """Sessions of each user, ended by six hours without an event."""
    return S.sessions(table(spark, d, "events"))


@query(_SESSIONS)
def user_sessions_stream(spark, d):
    """The same sessions from events that arrive out of order, each put out once when it has ended."""
    return R.replayed(table(spark, d, "events"), "ts", S.sessions)


@query("""WITH e AS (SELECT *, lag(ts) OVER w AS earlier, lag(event_type) OVER w AS kind, row_number() OVER w AS i FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, count(*) FILTER (i = 1 OR kind IS DISTINCT FROM event_type OR ts - earlier > INTERVAL 24 HOUR) OVER (PARTITION BY user_id ORDER BY i) AS nth FROM e)
    SELECT user_id, event_type, min_by(event_id, i) AS first_id, epoch_us(min(ts)) AS started_us, count(*) AS n FROM s GROUP BY user_id, nth, event_type""")
def user_streaks_stream(spark, d):
    """Runs of events of one type in each user's order, from events that arrive out of order."""
    return R.replayed(table(spark, d, "events").select("event_id", "user_id", "event_type", "ts"), "ts", S.streaks, past="3 days")


@query("""SELECT p.event_id AS effect_id, c.event_id AS cause_id, epoch_us(p.ts) - epoch_us(c.ts) AS micros FROM events p
    LEFT JOIN events c ON c.event_type = 'click' AND c.user_id = p.user_id AND c.ts <= p.ts AND c.ts >= p.ts - INTERVAL 12 HOUR WHERE p.event_type = 'purchase' AND p.ts IS NOT NULL""")
def attribution_stream(spark, d):
    """Purchases with the clicks of the twelve hours before them, as a join of two streams."""
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return R.replayed(rows, "ts", S.attributed, closing=[{"event_type": "click"}, {"event_type": "purchase"}])
