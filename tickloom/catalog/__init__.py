"""Registered queries by area; ``load`` imports every area once."""
import importlib
import pkgutil


def load():
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if module.startswith("q_"):
            importlib.import_module(f"{__name__}.{module}")
    from tickloom.catalog.base import ORACLES, QUERIES
    return dict(QUERIES), dict(ORACLES)
