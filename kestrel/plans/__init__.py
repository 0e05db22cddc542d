"""Registered query plans over the driver tables.

Each plan module registers ``name → (callable(spark, sf_dir), oracle SQL
or None)``; ``all_queries()`` imports them all.
"""

from __future__ import annotations

import importlib

from kestrel.plans.registry import REGISTRY, Plan

MODULES = ("reliability", "relational", "text", "retrieval", "charts", "io")


def all_plans() -> dict[str, Plan]:
    for m in MODULES:
        importlib.import_module(f"kestrel.plans.{m}")
    return dict(REGISTRY)
