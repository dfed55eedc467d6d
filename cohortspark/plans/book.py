"""All registered queries."""

from __future__ import annotations

import importlib

from cohortspark.plans import registry

_MODULES = ["tables", "aggregates", "windows", "shapes", "texts", "times", "numbers", "lists", "categories", "scores", "files", "graphs"]


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"cohortspark.plans.book_{name}")


def queries():
    _load()
    return dict(registry.QUERIES)


def oracles():
    _load()
    return dict(registry.ORACLES)
