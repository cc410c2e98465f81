"""All registered queries, in the order of the operator groups."""

from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

GROUPS = ["q_sources", "q_tables", "q_relational", "q_functions", "q_changes", "q_streams", "q_quality", "q_governance", "q_lineage", "q_ml", "q_gold"]

for _g in GROUPS:
    importlib.import_module(f"{__package__}.{_g}")

__all__ = ["QUERIES", "ORACLES"]
