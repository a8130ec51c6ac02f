"""Suffix arrays by Larsson-Sadakane refinement, and common prefixes by Kasai's argument, in numpy."""

from __future__ import annotations

import numpy as np


def _group_starts(keys: np.ndarray, kind: type) -> np.ndarray:
    """For sorted keys, the place at which each one's group of equal keys starts."""
    starts = np.arange(len(keys), dtype=kind)
    starts[1:][keys[1:] == keys[:-1]] = 0
    return np.maximum.accumulate(starts, out=starts)


def suffix_array(codes: np.ndarray, depth: int, known: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, rank) of a text of whole numbers, ordered by the first ``depth`` symbols.

    ``codes[i]`` stands for the ``known`` symbols from place i on; equal codes mean equal symbols.
    Sorting by codes gives a first order. Each round then orders the suffixes inside every group that
    is still equal by the rank of the suffix ``known`` symbols on, which doubles what is known;
    groups of one are never touched again. Suffixes that agree in exactly ``depth`` symbols stay in one
    group, have the same rank and keep their order. The end of the text sorts first.

    Places are numbers of 32 bits where the text allows it, and ``codes`` are let go after the first order.
    """
    n = len(codes)
    kind = np.int32 if 2 * n < 1 << 31 else np.int64
    order = np.argsort(codes, kind="stable").astype(kind)
    start = _group_starts(codes[order], kind)
    del codes
    rank = np.empty(n, kind)
    rank[order] = start
    open_at = np.arange(n, dtype=kind)  # places of the array in groups of more than one
    while known < depth:
        # A group of one starts at itself and the next one starts right after it.
        alone = np.ones(len(open_at), bool)
        if len(open_at):
            s = start
            alone[:-1] &= s[1:] != s[:-1]
            alone[1:] &= s[1:] != s[:-1]
            open_at, start = open_at[~alone], start[~alone]
        if not len(open_at):
            break
        suffix = order[open_at]
        step = min(known, depth - known)
        # Groups are contiguous here, so that one sort orders each within itself.
        key = start.astype(np.int64)
        key *= n + 1
        inside = suffix < n - step
        key[inside] += rank[suffix[inside] + step] + 1
        by = np.argsort(key, kind="stable")
        key, suffix = key[by], suffix[by]
        del by
        start = open_at[_group_starts(key, kind)]
        del key
        order[open_at] = suffix
        rank[suffix] = start
        known += step
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int, lanes: int = 2048) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``order``, up to ``limit``.

    By Kasai's argument the common prefix of the suffix at i + 1 with its neighbour is at most one
    shorter than that of the suffix at i; this asks for an order of whole suffixes. The text is cut into
    lanes that are walked side by side.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, order.dtype)
    before[order[1:]] = order[:-1]
    length = np.zeros(n, order.dtype)
    steps = -(-n // min(lanes, max(1, n)))
    first = np.arange(0, n, max(1, steps))
    have = np.zeros(len(first), np.int64)
    for step in range(steps):
        at = first + step
        if at[-1] >= n:
            first, have = first[at < n], have[at < n]
            at = at[at < n]
        other = before[at]
        have = np.where(other < 0, 0, np.maximum(have - 1, 0))
        live = np.flatnonzero((other >= 0) & (have < limit))
        while len(live):
            x, y = at[live] + have[live], other[live] + have[live]
            good = (x < n) & (y < n)
            good[good] = text[x[good]] == text[y[good]]
            live = live[good]
            have[live] += 1
            live = live[have[live] < limit]
        length[at] = have
    del before
    out = np.zeros(n, order.dtype)
    out[1:] = length[order[1:]]
    return out
