"""Joins by time over events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.operators import asof as A
from lineloom.plans.base import query
from lineloom.session import table


@query("""WITH e AS (SELECT *, lag(event_type) OVER w AS other_type, lag(event_id) OVER w AS other_id, lag(ts) OVER w AS other_ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, CASE WHEN other_type <> event_type THEN {'id': other_id, 'type': other_type, 'ts': other_ts} END AS o FROM e)
    SELECT event_id, event_type, o.id AS earlier_id, o.type AS earlier_type, epoch_us(ts) - epoch_us(o.ts) AS micros FROM (SELECT event_id, event_type, ts, last_value(o IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS o FROM s)""")
def asof_other_type(spark, d):
    """For each event the user's nearest earlier event of another type, and how long before it was."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    near = A.nearest_earlier(e, e, ["user_id"], "ts", "event_id", {"event_id": "earlier_id", "event_type": "earlier_type", "ts": "earlier_ts"}, unlike="event_type", strict=True)
    return near.select("event_id", "event_type", "earlier_id", "earlier_type", (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("earlier_ts").cast("timestamp"))).alias("micros"))


@query("SELECT p.event_id, max_by(c.event_id, (c.ts, c.event_id)) AS click_id, max_by(c.value, (c.ts, c.event_id)) AS click_value FROM events p LEFT JOIN events c ON p.user_id = c.user_id AND c.event_type = 'click' AND c.ts <= p.ts WHERE p.event_type = 'purchase' GROUP BY p.event_id")
def asof_last_click(spark, d):
    """For each purchase the user's last click at or before it."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return A.nearest_earlier(e.where("event_type = 'purchase'"), e.where("event_type = 'click'"), ["user_id"], "ts", "event_id", {"event_id": "click_id", "value": "click_value"}).select("event_id", "click_id", "click_value")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate AS a, max(l_shipdate) AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL HAVING max(l_shipdate) > o_orderdate)
    SELECT x.o_orderkey, count(*) AS others, min(y.o_orderkey) AS first_other FROM o x JOIN o y ON x.o_custkey = y.o_custkey AND x.o_orderkey <> y.o_orderkey AND x.a < y.b AND y.a < x.b GROUP BY x.o_orderkey""")
def interval_overlaps(spark, d):
    """For each order how many others of its customer were open, from order to last shipment, at some time while it was."""
    o = table(spark, d, "orders").join(table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped")), "o_orderkey").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("opened"), "shipped")
    pairs = A.overlapping(o, o, ["o_custkey"], "opened", "shipped").where("a.o_orderkey <> b.o_orderkey")
    return pairs.groupBy("a.o_orderkey").agg(F.count(F.lit(1)).alias("others"), F.min("b.o_orderkey").alias("first_other"))
