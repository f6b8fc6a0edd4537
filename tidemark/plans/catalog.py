"""Queries over the driver's tables, one for each operator, with their SQL."""

from __future__ import annotations

from . import catalog_derived, catalog_fallback, catalog_journal, catalog_ledger, catalog_people, catalog_proceedings, catalog_relational, catalog_release, catalog_text

_MODULES = (catalog_derived, catalog_fallback, catalog_journal, catalog_ledger, catalog_relational, catalog_text, catalog_proceedings, catalog_people, catalog_release)

QUERIES: dict = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
