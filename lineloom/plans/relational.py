"""Relational breadth: what the reference leaves to free SQL, over the star schema and the lines."""

from __future__ import annotations

from lineloom.plans.base import EL, QUERIES, SQL
from lineloom.session import table
from lineloom.sources import lines as L

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations")

#: Statements that read the same in both engines.
STATEMENTS = {
    "pricing_summary": "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS qty, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue, round(avg(l_discount), 6) AS disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus",
    "shipping_priority": "SELECT o_orderkey, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue, o_orderpriority FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderkey, o_orderpriority",
    "local_suppliers": "SELECT n_name, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name",
    "semi_join": "SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45) GROUP BY o_orderpriority",
    "anti_join": "SELECT c_mktsegment, count(*) AS n FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) GROUP BY c_mktsegment",
    "anti_join_parts": "SELECT p_brand, count(*) AS n FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45) GROUP BY p_brand",
    "correlated_average": "SELECT p_partkey, p_retailprice FROM part p WHERE p_retailprice > (SELECT avg(q.p_retailprice) FROM part q WHERE q.p_brand = p.p_brand)",
    "outer_join": "SELECT c_custkey, count(o_orderkey) AS n, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))), 0) AS DOUBLE) AS total FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey",
    "full_join": "SELECT coalesce(a.k, b.k) AS k, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY c_nationkey) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY s_nationkey) b ON a.k = b.k",
    "set_operations": "(SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 1",
    "rollup": "SELECT o_orderpriority, o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)",
    "cube": "SELECT event_type, user_id % 3 AS bucket, count(*) AS n FROM events GROUP BY CUBE (event_type, user_id % 3)",
    "grouping_sets": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())",
    "top_per_group": "SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) t WHERE rn <= 3",
    "window_frames": "SELECT o_custkey, o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS moving, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS place FROM orders",
    "having_distinct": "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, max(l_quantity) AS most FROM lineitem GROUP BY l_suppkey HAVING count(DISTINCT l_partkey) > 5",
    "correlated_scalar": "SELECT p_partkey, p_retailprice FROM part p WHERE p_retailprice > (SELECT 1.2 * avg(q.p_retailprice) FROM part q WHERE q.p_brand = p.p_brand)",
    "cte_reuse": "WITH r AS (SELECT l_suppkey AS s, CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue FROM lineitem GROUP BY l_suppkey) SELECT s, revenue FROM r WHERE revenue >= (SELECT max(revenue) * 0.9 FROM r)",
    "filtered_aggregates": "SELECT lang, count(*) FILTER (WHERE n_chars > 1000) AS long, count(*) FILTER (WHERE source = 'src0') AS src0, max(n_chars) AS longest FROM documents GROUP BY lang",
}


def _statement(sql: str):
    def run(spark, sf_dir):
        for name in _TABLES:
            if f" {name}" in sql:
                table(spark, sf_dir, name).createOrReplaceTempView(name)
        return spark.sql(sql)

    return run


for _name, _sql in STATEMENTS.items():
    QUERIES[_name], SQL[_name] = _statement(_sql), _sql


def _lines_sql(spark, sf_dir):
    """Read-only SQL over the lines of one dataset, which is all the view holds."""
    from lineloom.plans.guard import read_only

    lines = L.event_lines(spark, sf_dir).where("dataset = 'error'")
    return read_only(spark, lines, "SELECT split_part(text, ' ', 3) AS who, count(*) AS n, max(length(text)) AS longest FROM lines WHERE text ILIKE '%\"k\": 4%' GROUP BY split_part(text, ' ', 3) HAVING count(*) > 1")


QUERIES["lines_sql"] = _lines_sql
SQL["lines_sql"] = f"WITH {EL} SELECT split_part(text, ' ', 3) AS who, count(*) AS n, max(length(text)) AS longest FROM el WHERE dataset = 'error' AND text ILIKE '%\"k\": 4%' GROUP BY ALL HAVING count(*) > 1"
