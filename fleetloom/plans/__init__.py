"""Registered queries: name → (Spark function, SQL twin or None)."""

from __future__ import annotations

from fleetloom.plans import compliance, files, inventory, matching, regression, safety

REGISTRY = {
    **inventory.QUERIES,
    **compliance.QUERIES,
    **matching.QUERIES,
    **safety.QUERIES,
    **regression.QUERIES,
    **files.QUERIES,
}
