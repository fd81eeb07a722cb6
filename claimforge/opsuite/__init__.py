"""Relational operator queries over the generic test tables, each with its DuckDB counterpart."""

from __future__ import annotations

from claimforge.opsuite import aggregates, events, filters, joins, marts, text, updates, windows  # noqa: F401  they register their queries
from claimforge.opsuite.registry import ORACLES, QUERIES  # noqa: F401
