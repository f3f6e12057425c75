"""The registered queries and, where SQL can say the same, their oracles."""

from __future__ import annotations

from chronolake.plans import corpus_queries, lookup_queries, quality_queries, report_queries, rule_queries, series_queries, sink_queries, snapshot_queries, state_queries, stored_queries

FLAGSHIP = "release_cadence_drift"
_PARTS = (series_queries, stored_queries, quality_queries, corpus_queries, snapshot_queries, report_queries, lookup_queries, state_queries, rule_queries, sink_queries)

QUERIES: dict = {name: f for part in _PARTS for name, (f, _) in part.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
