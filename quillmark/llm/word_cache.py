"""A bounded memory of what was worked out for each word, one per Python worker.

Two generations: words used since the last turn survive, the others go, so memory stays
bounded however many different words a worker meets.
"""

from __future__ import annotations

from collections.abc import Callable


class WordCache(dict):
    def __init__(self, work: Callable, limit: int = 500_000):
        super().__init__()
        self.work = work
        self.limit = limit
        self.old: dict = {}

    def __missing__(self, word):
        found = self.old.get(word)
        if found is None:
            found = self.work(word)
        self[word] = found
        return found

    def forget(self) -> None:
        """Call when a partition ends: other stages of the same worker need the memory."""
        self.clear()
        self.old = {}

    def turn(self) -> None:
        """Call between batches: starts a new generation if this one is full."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
