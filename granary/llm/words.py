"""Caches that turn words into ids: natural text repeats its words, so most are encoded once."""

from __future__ import annotations

from collections.abc import Callable


class Recent(dict):
    """A dict that computes missing values and holds at most 2 * `cap` of them.

    When it is full, its entries become the older generation, from which those still in use come back.
    Keys longer than `longest` characters are computed each time.
    """

    def __init__(self, compute: Callable, cap: int, longest: int = 64):
        self.compute, self.cap, self.longest, self.old = compute, cap, longest, {}

    def __missing__(self, key):
        if (value := self.old.get(key)) is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.cap:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
