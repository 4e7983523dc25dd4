"""All registered queries by name, each with the SQL it must agree with."""

from __future__ import annotations

from ledgerlens.plans import business, review

SPECS = {**business.SPECS, **review.SPECS}
QUERIES = {name: query for name, (query, _) in SPECS.items()}
ORACLES = {name: sql for name, (_, sql) in SPECS.items() if sql}
