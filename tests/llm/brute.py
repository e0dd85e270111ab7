"""Brute-force links and their components."""

from __future__ import annotations

from collections.abc import Iterable


def components(nodes: Iterable, links: Iterable[tuple]) -> dict:
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in root}
