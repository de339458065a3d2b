"""Suffix ranks by prefix doubling, in numpy."""

from __future__ import annotations

import numpy as np


def dense(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of ``key`` and their number."""
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.empty(len(key), bool)
    new[:1] = True
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    at = np.cumsum(new) - 1
    rank = np.empty(len(key), np.int64)
    rank[order] = at
    return rank, int(at[-1]) + 1 if len(at) else 0


def doubling(first: np.ndarray, depth: int, step: int = 1) -> list[np.ndarray]:
    """Ranks of all suffixes by their first step, 2 step, 4 step ... symbols.

    ``first`` ranks suffixes by ``step`` symbols.  Ends at ``depth`` symbols,
    or as soon as every rank is its own."""
    n = len(first)
    rank, kinds = dense(first)
    levels = [rank]
    while step < depth and kinds < n:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        rank, kinds = dense(rank * (n + 1) + after)
        levels.append(rank)
        step *= 2
    return levels


def suffix_array(first: np.ndarray) -> np.ndarray:
    """Complete suffix array of an integer sequence."""
    rank = doubling(first, len(first))[-1]
    sa = np.empty(len(first), np.int64)
    sa[rank] = np.arange(len(first))
    return sa
