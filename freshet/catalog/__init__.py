"""Registered queries, one module per section of the operator inventory."""

import importlib

MODULES = ["scalars", "screens", "joins", "aggregates", "windows", "archives", "ordering", "models", "risk", "streams"]


def load_all() -> None:
    for m in MODULES:
        try:
            importlib.import_module(f"freshet.catalog.{m}")
        except ModuleNotFoundError as err:
            if err.name != f"freshet.catalog.{m}":
                raise
