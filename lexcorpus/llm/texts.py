"""Whole texts as byte arrays: grouping rows for array work, words, and hashes of byte ranges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

GROUP_BYTES = 1_000_000
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)

#: ASCII white space: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Byte values with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def groups(texts: Iterable[str | None], limit: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8, about ``limit`` bytes at a time: (first row, texts)."""
    held: list[bytes] = []
    first = size = row = 0
    for text in texts:
        held.append(encoded(text))
        size += len(held[-1])
        row += 1
        if size >= limit:
            yield first, held
            held, first, size = [], row, 0
    if held:
        yield first, held


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers.get("up", ())) < n:
        size = max(n, GROUP_BYTES + 200_000)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    up, down = _powers["up"], _powers["down"]
    if n <= GROUP_BYTES + 200_000 < len(up):
        _powers["up"], _powers["down"] = up[: GROUP_BYTES + 200_000].copy(), down[: GROUP_BYTES + 200_000].copy()
    return up[:n], down[:n]


class RangeHashes:
    """64-bit polynomial hashes of any byte ranges of one array."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix, so that all bits of a hash depend on all others."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by a line feed; starts and ends of the texts."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    return data, starts, starts + sizes


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate([[0], edges])
    if len(inside) and inside[-1]:
        edges = np.concatenate([edges, [len(inside)]])
    return edges[0::2], edges[1::2]
