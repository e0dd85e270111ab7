"""Word shingle sets of whole texts as sorted 64-bit hashes, and exact set links in blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import xxhash

CACHE_WORDS = 150_000
PIECE_BYTES = 1 << 16  # of a text, hashed at once
LONG_WORD = 64


class WordHashes(dict):
    """64-bit hash of each word; forgets all when it has grown to CACHE_WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def odd_numbers(seed: int, n: int) -> np.ndarray:
    """Fixed random odd multipliers."""
    values = [xxhash.xxh3_64_intdigest(f"{seed}:{k}".encode()) | 1 for k in range(n)]
    return np.array(values, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others (a bijection)."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _word_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte (0 for white space), the powers of an odd factor and of its inverse."""
    letters = odd_numbers(64, 256)
    letters[[9, 10, 11, 12, 13, 32]] = 0
    factor = 0x9E3779B97F4A7C15  # odd, so it has an inverse
    inverse = pow(factor, -1, 1 << 64)
    powers = [np.full(PIECE_BYTES + LONG_WORD + 1, f, np.uint64) for f in (factor, inverse)]
    for p in powers:
        p[0] = 1
        np.cumprod(p, out=p)
    return letters, *powers


def word_bounds(chars: np.ndarray) -> np.ndarray:
    """Start and end of each word in turn, as places of ``chars`` (bytes or code points)."""
    edge = np.ones(len(chars) + 2, bool)
    edge[1:-1] = (chars == 32) | ((chars >= 9) & (chars <= 13))
    return np.flatnonzero(edge[1:] != edge[:-1])


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text: A-Z in lower case, cut at ASCII white space."""
    data = (text or "").encode("utf-8", "replace").lower()
    bounds = word_bounds(np.frombuffer(data, np.uint8))
    return hashes_between(data, bounds[::2], bounds[1::2])


def hashes_between(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of ``data`` in order, between which there is only ASCII white space.

    A word's hash is the sum of its bytes' numbers times the powers of a factor, counted
    from the word's start, so that all words of a piece of the text are hashed at once
    without building them; words of more than LONG_WORD bytes are hashed one by one.
    """
    chars = np.frombuffer(data, np.uint8)
    out = np.empty(len(starts), np.uint64)
    long = ends - starts > LONG_WORD
    lo = 0
    while lo < len(starts):
        # Words that begin in the next PIECE_BYTES, up to a long one.
        first = int(starts[lo])
        hi = int(np.searchsorted(starts, first + PIECE_BYTES))
        if long[lo:hi].any():
            hi = lo + int(long[lo:hi].argmax())
        if hi > lo:
            piece = _LETTERS[chars[first : ends[hi - 1]]]
            piece *= _POWERS[: len(piece)]
            at = starts[lo:hi] - first
            out[lo:hi] = np.add.reduceat(piece, at) * _INVERSES[at]
            lo = hi
        else:
            out[lo] = xxhash.xxh3_64_intdigest(data[first : ends[lo]])
            lo += 1
    return mixed(out)


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of ``n`` words, in order; of the whole text if it has fewer words."""
    if not len(words):
        return words
    size = min(n, len(words))
    factors = odd_numbers(n * 100 + size, size)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + k + 1] * factors[k]
    return mixed(total)


_LETTERS, _POWERS, _INVERSES = _word_tables()


def linked_pairs(sets: Sequence[np.ndarray], block: Sequence[int], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of sets with 100 * intersection >= percent * union that connect them: a
    spanning forest of all links. Only sets of different blocks are compared if there
    are two blocks. Intersections are counted over shared elements, exactly.
    """
    n = len(sets)
    if n < 2:
        return
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, which, shared_by = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = shared_by[which] > 1
    owner, which = owner[shared], which[shared]
    by_element = np.argsort(which, kind="stable")
    holders = owner[by_element]  # sets that hold each element, element after element
    # Where the holders of an element begin, and how many come after each place.
    place = np.empty(len(which), np.int64)
    place[by_element] = np.arange(len(which))
    ends = np.searchsorted(which[by_element], which, side="right")
    first = np.searchsorted(owner, np.arange(n + 1))
    block = np.asarray(block)
    two = len(set(block.tolist())) > 1
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i in range(n - 1):
        lo, hi = first[i], first[i + 1]
        # Later holders of each of its elements (holders are in order of their number).
        start, count = place[lo:hi] + 1, ends[lo:hi] - place[lo:hi] - 1
        total = int(count.sum())
        if not total:
            continue
        at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(total)
        both = np.bincount(holders[at], minlength=n)
        hit = 100 * both >= percent * (sizes[i] + sizes - both)
        hit &= both > 0
        if two:
            hit &= block != block[i]
        for j in np.flatnonzero(hit).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                yield i, j
