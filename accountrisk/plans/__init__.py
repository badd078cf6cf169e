"""Named queries over the given tables, grouped by family."""

from __future__ import annotations

import importlib

FAMILIES = [
    "intake", "feature", "portfolio", "metric", "monitoring", "modelling", "streams",
]


def load_catalog():
    """(queries, SQL twins) of all families."""
    for family in FAMILIES:
        importlib.import_module(f"accountrisk.plans.{family}")
    from accountrisk.plans.catalog import ORACLES, QUERIES

    return QUERIES, ORACLES
