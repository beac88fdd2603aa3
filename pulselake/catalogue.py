"""The query catalogue: name -> query, name -> oracle SQL."""

from __future__ import annotations

from .plans import grid_sql, join_sql, kernel_queries, operator_queries, rule_sql, signal_sql
from .plans.dialect import oracle_text, query

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "stem_window_features"

for _module in (signal_sql, join_sql, grid_sql, rule_sql):
    for _name, _text in _module.QUERIES.items():
        QUERIES[_name] = getattr(_module, "FUNCTIONS", {}).get(_name) or query(_text)
        ORACLES[_name] = oracle_text(getattr(_module, "ORACLE", {}).get(_name, _text))

QUERIES |= kernel_queries.QUERIES | operator_queries.QUERIES
ORACLES |= operator_queries.ORACLES
