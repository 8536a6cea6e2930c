"""All queries of the evidence operators and their SQL."""

from __future__ import annotations

from claimweft.plans import flow, registry, run


def queries():
    return registry.queries() | flow.queries() | run.queries()


def oracle_sql():
    return registry.oracle_sql() | flow.oracle_sql() | run.oracle_sql()
