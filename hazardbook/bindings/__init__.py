"""Every operator bound to the given tables, each next to the SQL it must equal.

The given tables hold no security data. ``world`` derives the base tables of this
engine from them (all rows, nothing invented), and the other modules run the feeds,
operators, views and checks over them.
"""

from __future__ import annotations

from importlib import import_module

from hazardbook.bindings.registry import ORACLES, QUERIES, Query

_MODULES = ("views", "feeds", "relational", "history", "jobs")


def _load() -> None:
    for module in _MODULES:
        import_module(f"{__name__}.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
