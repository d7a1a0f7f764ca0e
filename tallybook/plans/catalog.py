"""All registered queries and their SQL."""

from __future__ import annotations

from tallybook.plans import catalog_ledger, catalog_reports, catalog_rules

CATALOG = {**catalog_ledger.QUERIES, **catalog_rules.QUERIES, **catalog_reports.QUERIES}
