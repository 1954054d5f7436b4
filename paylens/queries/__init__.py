"""Registered queries: one callable and, where SQL can say it, one SQL text each."""

from __future__ import annotations

import importlib

from paylens.queries.registry import REGISTRY

_FAMILIES = [
    "scans", "filters", "joins", "aggregates", "windows", "sets",
    "scalars", "quality", "drift", "privacy", "texts", "streams", "lifecycle",
]


def load() -> dict:
    for family in _FAMILIES:
        try:
            importlib.import_module(f"paylens.queries.{family}")
        except ModuleNotFoundError as missing:
            if missing.name != f"paylens.queries.{family}":
                raise
    return REGISTRY
