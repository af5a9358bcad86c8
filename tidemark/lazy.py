"""A read-only mapping whose values are built on first access."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Generic, TypeVar

V = TypeVar("V")


class LazyMap(Mapping[str, V], Generic[V]):
    def __init__(self, builders: Mapping[str, Callable[[], V]]):
        self._builders = dict(builders)
        self._values: dict[str, V] = {}

    def __getitem__(self, key: str) -> V:
        if key not in self._values:
            self._values[key] = self._builders[key]()
        return self._values[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
