"""Whole groups out of sorted partitions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd


def whole_groups(frames: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of a partition sorted by ``keys``, cut so that no group is split, with the bounds of
    the groups. Only a batch and one group are held, so groups must be of bounded size."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        held.append(frame)
        columns = [frame[k].to_numpy() for k in keys]
        last = np.zeros(len(frame), bool)
        for c in columns:
            last |= c != c[-1]
        others = np.flatnonzero(last)
        if not len(others):
            first = held[0]
            if all(first[k].iloc[-1] == c[-1] for k, c in zip(keys, columns, strict=True)):
                continue
            cut = 0
        else:
            cut = others[-1] + 1
        held[-1] = frame.iloc[:cut]
        if len(done := pd.concat(held, ignore_index=True)):
            yield done, bounds(done, keys)
        held = [frame.iloc[cut:]]
    if held and len(done := pd.concat(held, ignore_index=True)):
        yield done, bounds(done, keys)


def bounds(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    new = np.ones(len(frame) + 1, bool)
    new[1:-1] = False
    for k in keys:
        c = frame[k].to_numpy()
        new[1:-1] |= c[1:] != c[:-1]
    return np.flatnonzero(new)
