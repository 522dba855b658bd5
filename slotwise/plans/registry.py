"""Every query of the library with its SQL."""

from __future__ import annotations

from slotwise.plans import aggregates, audits, coverage, entities, files, ingest, merges, rulepacks, scalar_queries, selection
from slotwise.plans.base import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
for _part in (coverage, selection, aggregates, entities, merges, rulepacks, scalar_queries, ingest, audits, files):
    QUERIES |= _part.family.queries
    ORACLES |= _part.family.oracles
