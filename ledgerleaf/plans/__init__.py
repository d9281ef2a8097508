"""Registered queries: the jobs bound to the driver's tables, each next to the SQL that must agree with it."""

from __future__ import annotations

import importlib
from types import ModuleType

_MODULES = ("searching", "intake", "texts", "lifecycle", "monitoring", "custody", "streams", "stored", "durable", "landed")


def load() -> ModuleType:
    """The catalog, filled by importing every module of queries once."""
    for name in _MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return importlib.import_module(f"{__name__}.catalog")
