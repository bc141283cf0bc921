"""Every core query of the driver contract, with its SQL: the operators on the driver's tables."""

from __future__ import annotations

from fluvion.plans import campaign, catalog, fields, gauges, relations, reports, series, tables, verifiers, verify

QUERIES: dict = {}
ORACLES: dict = {}
for module in (fields, relations, tables, gauges, verify, campaign, series, catalog, verifiers, reports):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES
