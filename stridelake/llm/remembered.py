"""A bounded memory for small helpers inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Hashable

#: Characters of a key that is remembered at most; so bytes are bounded as well as entries.
LONGEST_KEY = 48


class Remembered(dict):
    """A dict that fills itself by a function and holds two generations of keys.

    When the young generation is full it becomes the old one, and the old one
    goes; a key of the old one that is asked for again is young again. So it
    never holds more than twice ``most`` keys, and keeps those in use. Longer
    texts than ``LONGEST_KEY`` are worked out each time.
    """

    def __init__(self, make: Callable[[Hashable], object], most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if isinstance(key, str) and len(key) > LONGEST_KEY:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
