"""All named queries with their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ("revenue_features", "revenue_profile", "revenue_diagnostics", "revenue_models", "labels", "retrieval", "graph", "files")


def _catalogues():
    return [importlib.import_module(f"ledgerline.catalog.{m}").catalogue for m in MODULES]


def all_queries() -> dict:
    return {name: q for c in _catalogues() for name, q in c.queries.items()}


def all_oracles() -> dict[str, str]:
    return {name: q for c in _catalogues() for name, q in c.oracles.items()}
