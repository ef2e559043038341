"""Words and word runs of many texts as 64-bit names, in numpy passes over the texts' bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

_ONE = np.uint64(1)
#: Odd multipliers of the two independent name streams.
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_RUNS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything in ASCII that is no letter as a space.
LETTERS = np.array([c if chr(c).isalpha() or c > 127 else 10 if c == 10 else 32 for c in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the whole word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _bytes(stream: int) -> np.ndarray:
    out = mix(np.arange(1, 257, dtype=np.uint64) * _RUNS[stream]) | _ONE
    out[SPACE] = 0
    return out


#: Bytes that are hashed at once.
_STEP = 1 << 19


@lru_cache(4)
def _powers(stream: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the stream's multiplier and of its inverse modulo 2**64."""
    base = int(_BASES[stream])
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _power(stream: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(stream, 2 * _STEP) if n <= 2 * _STEP else _powers.__wrapped__(stream, n)


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of some texts.

    names[s]: each word's 64-bit name in stream s; counts: words of each text; first: index of each text's first
    word; start, end: byte places of each word in data, the texts joined by line feeds. lower: A-Z as a-z; letters:
    what is no letter in ASCII separates words as well.
    """

    def __init__(self, texts: list[str | None], lower: bool = False, streams: int = 1, letters: bool = False):
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        self.data = b"\n".join(raw) + b"\n"
        buf = np.frombuffer(self.data, np.uint8)
        if lower:
            buf = LOWER[buf]
        if letters:
            buf = LETTERS[buf]
        space = SPACE[buf]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        self.start, self.end = edge[::2], edge[1::2]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        stops = np.cumsum(sizes)
        self.first = np.searchsorted(self.start, np.concatenate([[0], stops[:-1]])) if len(raw) else np.zeros(0, np.int64)
        self.counts = np.diff(self.first, append=len(self.start))
        self.names = [np.empty(len(self.start), np.uint64) for _ in range(streams)]
        blocks = np.unique(np.append(np.searchsorted(self.start, np.arange(0, len(buf), _STEP)), len(self.start)))
        for a, b in zip(blocks[:-1].tolist(), blocks[1:].tolist(), strict=True):
            at = self.start[a:b] - self.start[a]
            part = buf[self.start[a] : self.start[b] if b < len(self.start) else len(buf)]
            for s in range(streams):
                up, down = _power(s, len(part))
                with np.errstate(over="ignore"):
                    self.names[s][a:b] = mix(np.add.reduceat(_bytes(s)[part] * up[: len(part)], at) * down[at])

    def __len__(self) -> int:
        return len(self.counts)


def runs(names: np.ndarray, size: int, stream: int = 0) -> np.ndarray:
    """The names of the runs of `size` words that start at each word (the last size - 1 are meaningless)."""
    out = np.zeros(len(names), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            out[: len(names) - i] = out[: len(names) - i] * _RUNS[stream] + names[i:]
        return mix(out + np.uint64(size))


def portions(texts: Iterable[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """The texts in order, as (index of the first, texts) of about `chars` characters; a longer text is alone."""
    at, part, size = 0, [], 0
    for text in texts:
        n = len(text or "")
        if part and size + n > chars:
            yield at, part
            at, part, size = at + len(part), [], 0
        part.append(text)
        size += n
    if part:
        yield at, part
