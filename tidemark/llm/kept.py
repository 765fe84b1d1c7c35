"""A bounded memory of computed values."""

from __future__ import annotations

from collections.abc import Callable


class Kept(dict):
    """key -> make(key), made once while kept.

    At `most` entries they become the older half, which goes when the next half is full;
    an entry that is asked for again moves to the newer half, so frequent ones stay.
    """

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found

    def forget(self) -> None:
        self.clear()
        self.older = {}
