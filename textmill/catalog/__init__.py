"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from textmill.catalog import registry

MODULES = ("relational", "text", "vectorspace", "models")


def _load() -> None:
    for name in MODULES:
        import_module(f"textmill.catalog.{name}")


def all_queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
