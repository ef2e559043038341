"""Names sent between tasks as packed arrays: one row for each portion of texts and each range of names.

A blob lists owners with their counts, then the names of all owners, sorted within each. The rows that Spark
moves are few and large, whatever the number of names, and a name's range decides the task it meets its equals in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

#: Names that a range should hold on average.
RANGE = 1_500_000


def ranges(names: int) -> int:
    """A power of two."""
    return 1 << max(4, (max(1, names) // RANGE).bit_length())


def planes(ids: np.ndarray) -> np.ndarray:
    """64-bit numbers by byte planes, of which the high ones are mostly zero and compress away."""
    return np.ascontiguousarray(ids.astype("<i8").view(np.uint8).reshape(-1, 8).T)


def pack(owners: np.ndarray, counts: np.ndarray, *columns: np.ndarray) -> bytes:
    """owners: fixed-width items; counts: uint32 of each; columns: arrays of sum(counts) items each; signed 64-bit ones go by planes."""
    columns = tuple(planes(c) if c.dtype == np.int64 else c for c in columns)
    return b"".join([np.array([len(owners)], np.int64).tobytes(), owners.tobytes(), counts.astype(np.uint32).tobytes(), *[c.tobytes() for c in columns]])


def unpack(blob: bytes, owner: str, *kinds: str) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    at = 8
    owners = np.frombuffer(blob, owner, n, at)
    at += owners.nbytes
    counts = np.frombuffer(blob, np.uint32, n, at)
    at += counts.nbytes
    out, total = [owners, counts], int(counts.sum(dtype=np.int64))
    for kind in kinds:
        if kind == "i8":
            out.append(np.ascontiguousarray(np.frombuffer(blob, np.uint8, 8 * total, at).reshape(8, total).T).view("<i8").ravel())
        else:
            out.append(np.frombuffer(blob, kind, total, at))
        at += out[-1].nbytes
    return out


def unpack_all(blobs: list[bytes], owner: str, *kinds: str) -> list[np.ndarray]:
    """Owners and columns of all blobs, the owners repeated for each of their items."""
    parts = [unpack(b, owner, *kinds) for b in blobs]
    owners = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    return [np.repeat(np.arange(len(owners)), counts), owners, *[np.concatenate([p[2 + i] for p in parts]) for i in range(len(kinds))]]


def send(owners: np.ndarray, index: np.ndarray, names: np.ndarray, parts: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A (range, blob) for each range that has names. index: the owner of each name, ascending."""
    part = names >> np.uint64(64 - parts.bit_length() + 1)
    order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.uint32), kind="stable")
    part, index, names = part[order], index[order], names[order]
    columns = tuple(c[order] for c in columns)
    cut = np.searchsorted(part, np.arange(parts + 1, dtype=part.dtype))
    for p in np.flatnonzero(np.diff(cut)):
        a, b = cut[p], cut[p + 1]
        own = index[a:b]
        edge = np.flatnonzero(np.diff(own, prepend=-1))
        yield int(p), pack(owners[own[edge]], np.diff(edge, append=b - a), names[a:b], *[c[a:b] for c in columns])


def frame(rows: list[tuple[int, bytes]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["part", "blob"])
