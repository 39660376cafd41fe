"""Registered queries: operators over the given tables, each with the SQL that says the same."""

from __future__ import annotations

import importlib

from sluice.functions.staging import tidy

MODULES = ("funnel", "report", "performance", "companies", "leads", "audits", "imports", "pages", "books", "projections", "feeds", "reconcile")


def registered() -> tuple[dict, dict[str, str]]:
    """All queries and their SQL; a query that stages tables leaves its result only."""
    queries, sql = {}, {}
    for m in MODULES:
        module = importlib.import_module(f"sluice.plans.{m}")
        queries |= {name: tidy(name, query) for name, query in module.QUERIES.items()}
        sql |= module.SQL
    return queries, sql
