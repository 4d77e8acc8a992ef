"""Queries over the driver tables, each with the SQL it is checked against."""

from __future__ import annotations

import importlib
import pkgutil

_SUPPORT = {"registry", "compare", "bank", "portable"}


def load_all() -> None:
    """Import every module of this package so that its queries register."""
    for module in pkgutil.iter_modules(__path__):
        if module.name not in _SUPPORT:
            importlib.import_module(f"{__name__}.{module.name}")
