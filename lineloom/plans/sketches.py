"""Sketches of the event log, held against exact values."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineloom.operators import sketches as K
from lineloom.plans.base import query
from lineloom.session import table
from lineloom.storage import cut


@query("""WITH c AS (SELECT event_type, props, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL)
    SELECT e.event_type AS dataset, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_ok, true AS ranks_ok, (SELECT max(n) FROM c WHERE c.event_type = e.event_type) AS most
    FROM events e WHERE ts IS NOT NULL GROUP BY e.event_type""")
def sketch_bounds(spark, d):
    """Distinct users, ranks of three quantiles and the largest count from stored hourly sketches; whether they lie within their bounds of the exact values.

    The largest count is exact as long as the items are fewer than are tracked.
    """
    e = table(spark, d, "events").where("ts is not null")
    ranks = (0.5, 0.9, 0.99)
    told = K.estimates(K.merged(cut(K.rollup(e, "event_type", "ts", "user_id", "value", "props"), "sketches")), ranks, 1)
    # a quantile's true rank is anywhere from the share below it to the share up to it
    rows = e.join(told.withColumnRenamed("dataset", "event_type").drop("n"), "event_type")
    shares = [F.struct(F.avg((F.col("value") < F.col("quantiles")[i]).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("quantiles")[i]).cast("double")).alias("upto")).alias(f"r{i}") for i in range(len(ranks))]
    exact = rows.groupBy(F.col("event_type").alias("dataset")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.first("distinct").alias("distinct"), F.first("frequent").alias("frequent"), *shares)
    ok = F.lit(True)
    for i, r in enumerate(ranks):
        ok = ok & (F.col(f"r{i}.below") - K.RANK_ERROR <= r) & (F.col(f"r{i}.upto") + K.RANK_ERROR >= r)
    near = F.abs(F.col("distinct") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * K.DISTINCT_ERROR)
    return exact.select("dataset", "n", "users", near.alias("users_ok"), ok.alias("ranks_ok"), F.col("frequent")[0]["count"].alias("most"))
