"""A mapping whose values are built when they are first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import TypeVar

T = TypeVar("T")


class LazyMap(Mapping[str, T]):
    """Naming a table or view costs analysis on the driver, so a query that uses two of
    them should not plan all twenty-eight."""

    def __init__(self, builders: Mapping[str, Callable[[], T]]) -> None:
        self._builders = dict(builders)
        self._built: dict[str, T] = {}

    def __getitem__(self, name: str) -> T:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def builders(self) -> dict[str, Callable[[], T]]:
        return {name: (lambda name=name: self[name]) for name in self._builders}
