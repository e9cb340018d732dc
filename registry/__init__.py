"""Registered queries and, for each, an independent SQL statement with the same result.

Each module binds reports to the usage logs derived from a data folder (``QUERIES``) and
states the expected result as plain SQL (``ORACLES``).
"""

from registry import (
    alerts,
    billing,
    governance,
    ingest,
    operator_metrics,
    query_log,
    storage,
    text_log,
    warehouse,
)

MODULES = (
    query_log, operator_metrics, billing, warehouse, storage, governance, text_log, ingest, alerts,
)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
