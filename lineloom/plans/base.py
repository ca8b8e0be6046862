"""The register of queries and the SQL shared by their checks."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}

SPLIT = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def _lines(name: str, table: str, dataset: str, order: str, text: str) -> str:
    return f"""{name} AS (SELECT dataset, (row_number() OVER (PARTITION BY dataset ORDER BY {order}, pos))::INTEGER AS line_number, text FROM (
        SELECT dataset, {order}, unnest(ls) AS text, unnest(range(1, len(ls) + 1)) AS pos FROM (
        SELECT dataset, {order}, CASE WHEN text = '' THEN [] WHEN p[-1] = '' THEN p[1:len(p) - 1] ELSE p END AS ls FROM (
        SELECT {dataset} AS dataset, {order}, {text} AS text, regexp_split_to_array({text}, '{SPLIT}') AS p FROM {table} WHERE {text} IS NOT NULL))))"""


DL = _lines("dl", "documents", "lang", "doc_id", "text")
PL = _lines("pl", "pages", "regexp_extract(url, '://([^/:]+)', 1)", "page_id", "html")
TL = _lines("tl", "conversations", "role", "conv_id, turn", "text")
EL = """el AS (SELECT event_type AS dataset, (row_number() OVER (PARTITION BY event_type ORDER BY event_id))::INTEGER AS line_number,
        strftime(ts, '%Y-%m-%d %H:%M:%S') || ' user=' || user_id || ' type=' || event_type || ' props=' || props AS text FROM events)"""


def query(sql: str | None = None, name: str | None = None):
    """Registers a query (spark, sf_dir) -> DataFrame, with its SQL if it has any."""

    def put(f: Callable) -> Callable:
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return put


def values(rows: list[tuple], names: str) -> str:
    """A VALUES clause for a short list of rows."""
    one = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows) + f") AS t({names})"
