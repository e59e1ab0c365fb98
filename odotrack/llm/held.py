"""What a Python worker keeps between tasks.

Spark reuses workers for whatever comes next, so caches of one operator would stay while
another works. A worker holds the cache of one owner at a time."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

T = TypeVar("T")
_HELD: list = [None, None]


def held(owner: Hashable, make: Callable[[], T]) -> T:
    """The owner's object, made anew if another owner's was held."""
    if _HELD[0] != owner:
        _HELD[:] = None, None  # free the other one first
        _HELD[:] = owner, make()
    return _HELD[1]
