"""A read-only mapping whose values are built on first access.

Models reference each other by name (facts need dimensions, dimensions
need staging tables); building a DataFrame costs driver-side analysis,
so a query builds only the models it actually reads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any


class LazyTables(Mapping):
    def __init__(self, factories: dict[str, Callable[[], Any]]):
        self._factories = dict(factories)
        self._built: dict[str, Any] = {}

    def __getitem__(self, name: str) -> Any:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


def lazy(names, build: Callable[[str], Any]) -> LazyTables:
    return LazyTables({n: (lambda n=n: build(n)) for n in names})
