"""Spans of a text as (kind, start, end) in code points, and their text form."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Sequence

Span = tuple[str, int, int]


def joined(spans: Iterable[Span], kinds: Sequence[str]) -> str:
    """``kind:start:end`` by start, then kind in the order of ``kinds``, comma-joined."""
    order = {kind: at for at, kind in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]], s[2])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Cover:
    """The places that spans cover, as sorted disjoint intervals: a span is looked up by bisection."""

    def __init__(self, spans: Iterable[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda s: s[1]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1
        return at >= 0 and self.ends[at] > start

    def add(self, start: int, end: int) -> None:
        """Take in an interval that meets none."""
        at = bisect_left(self.starts, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)


def free_of(spans: Iterable[Span], taken: Iterable[Span]) -> list[Span]:
    """The spans that overlap none of ``taken``."""
    cover = Cover(taken)
    return [span for span in spans if not cover.meets(span[1], span[2])]
