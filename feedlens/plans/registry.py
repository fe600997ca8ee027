"""Import every query module so that the catalog is complete."""

from __future__ import annotations

from feedlens.plans import catalog
from feedlens.plans import live_q, open_q, reports_q, rollups, rows_q  # noqa: F401


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.ORACLES)


def bench_queries():
    return list(catalog.BENCH)
