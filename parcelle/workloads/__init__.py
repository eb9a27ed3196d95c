"""Registered queries over the driver tables, each next to its oracle SQL."""

import importlib
import pkgutil


def load_all() -> None:
    """Imports every module of this folder, which registers its queries."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
