"""The registered queries of the line engine and the SQL they are held against."""

from __future__ import annotations

from lineloom.plans import core, entities, positional, records, relational, search, sketches, stream, tiers, times
from lineloom.plans.base import QUERIES, SQL

FLAGSHIP = "literal_evidence"
PLANS = (core, positional, entities, records, relational, search, sketches, tiers, times, stream)
__all__ = ["FLAGSHIP", "PLANS", "QUERIES", "SQL"]
