"""One side of a book in pages of neighbouring prices, so that a stream reads and writes the pages its diffs touch."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable


class Pages:
    """Prices and quantities in pages of at most `size` levels. The directory has each page's number, a price that none of its levels is
    below, and how many they are, by price; it is all that is needed to find a level, the best one, or those to trim. A page is read
    when it is first needed."""

    def __init__(self, high: bool, directory: list[list], read: Callable[[int], dict[float, float]], size: int = 64):
        self.high, self.directory, self.size = high, directory, size
        self._read, self._held = read, {}
        self.changed: set[int] = set()
        self.gone: set[int] = set()
        self._next = max((p for p, _, _ in directory), default=-1) + 1

    def __len__(self) -> int:
        return sum(n for _, _, n in self.directory)

    def _page(self, number: int) -> dict[float, float]:
        if number not in self._held:
            self._held[number] = self._read(number)
        return self._held[number]

    def page(self, number: int) -> dict[float, float]:
        """A changed page's levels."""
        return self._held[number]

    def _add(self, at: int, levels: dict[float, float]) -> None:
        self.directory.insert(at, [self._next, min(levels), len(levels)])
        self._held[self._next] = levels
        self.changed.add(self._next)
        self._next += 1

    def _drop(self, at: int) -> None:
        number = self.directory.pop(at)[0]
        self._held.pop(number, None)
        self.changed.discard(number)
        self.gone.add(number)

    def put(self, price: float, qty: float) -> None:
        """Sets a level; a quantity of 0 deletes it."""
        if not self.directory:
            if qty:
                self._add(0, {price: qty})
            return
        at = max(0, bisect_right(self.directory, price, key=lambda e: e[1]) - 1)
        entry = self.directory[at]
        if not qty and price < entry[1]:
            return
        levels = self._page(entry[0])
        if qty:
            levels[price] = qty
            entry[1] = min(entry[1], price)
        elif levels.pop(price, None) is None:
            return
        entry[2] = len(levels)
        self.changed.add(entry[0])
        if not levels:
            self._drop(at)
        elif len(levels) > self.size:
            prices = sorted(levels)
            upper = {p: levels.pop(p) for p in prices[len(prices) // 2 :]}
            entry[2] = len(levels)
            self._add(at + 1, upper)

    @property
    def best(self) -> float | None:
        if not self.directory:
            return None
        levels = self._page(self.directory[-1 if self.high else 0][0])
        return max(levels) if self.high else min(levels)

    def trim(self, depth: int) -> None:
        """Leaves the best `depth` levels; pages that go as a whole are not read."""
        over = len(self) - depth
        while over > 0:
            at = 0 if self.high else -1
            number, _, n = self.directory[at]
            if n <= over:
                self._drop(at)
                over -= n
                continue
            levels = self._page(number)
            for price in sorted(levels, reverse=not self.high)[:over]:
                del levels[price]
            self.directory[at][2] = len(levels)
            self.changed.add(number)
            over = 0

    def clear(self) -> None:
        while self.directory:
            self._drop(0)
