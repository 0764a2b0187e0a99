"""Dependencies of shortest paths over arcs held in memory.

``first`` and ``ends``: the arcs of node v go to ``ends[first[v]:first[v + 1]]``. Some roots are searched at once; a key is
the place of a root times the number of nodes plus a node, so sums of one root stay close together in memory.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np

#: Entries (root, node) of the searches at once, arcs followed at once, and arcs kept from the way out for the way back.
ENTRIES_AT_ONCE = 1 << 18
ARCS_AT_ONCE = 1 << 17
ARCS_KEPT = 1 << 23

#: Which keys, how many arcs each has, where these begin, the keys they lead to.
Walked = tuple[slice, np.ndarray, np.ndarray, np.ndarray]


def _walk(first: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> Iterator[Walked]:
    """The arcs of the keys, about ``ARCS_AT_ONCE`` at a time."""
    if not len(keys):
        return
    node = keys % (len(first) - 1)
    several = keys[-1] >= len(first) - 1  # roots, as keys are in order
    begin, lengths = first[node], first[node + 1] - first[node]
    upto = np.cumsum(lengths)
    bounds = np.searchsorted(upto, np.arange(ARCS_AT_ONCE, upto[-1], ARCS_AT_ONCE))
    for i, j in pairwise(np.unique([0, *bounds, len(keys)])):
        many = lengths[i:j]
        offset = np.cumsum(many) - many
        position = np.repeat(begin[i:j] - offset, many)
        position += np.arange(len(position))
        to = ends[position].astype(np.int64)
        if several:
            to += np.repeat(keys[i:j] - node[i:j], many)
        yield slice(i, j), many, offset, to


def _push(walked: Iterable[Walked], values: np.ndarray, sums: np.ndarray) -> None:
    """Adds the value of each key to the sums where its arcs lead."""
    for part, many, _, to in walked:
        np.add.at(sums, to, np.repeat(values[part], many))


def _pull(walked: Iterable[Walked], values: np.ndarray, count: int) -> np.ndarray:
    """Per key, all with arcs, the sum of the values where its arcs lead."""
    found = np.empty(count)
    for part, _, offset, to in walked:
        found[part] = np.add.reduceat(values[to], offset)
    return found


def _search(first: np.ndarray, ends: np.ndarray, degree: np.ndarray, roots: np.ndarray, total: np.ndarray) -> None:
    """Adds the dependencies of the roots to ``total``.

    Levels of all roots in step. A level is found from the one before or from the nodes not seen yet, whichever have
    fewer arcs; likewise on the way back. So arcs of a last level are followed only where nodes are left.
    """
    n = len(degree)
    size = len(roots) * n
    sums, values = np.zeros(size), np.zeros(size)
    unseen = np.tile(degree > 0, len(roots))
    keys, sigma = np.arange(len(roots)) * n + roots, np.ones(len(roots))
    left, kept, levels = len(roots) * len(ends), 0, []
    while len(keys):
        unseen[keys] = False
        arcs = int(degree[keys % n].sum())
        left -= arcs
        walked = None
        if arcs <= left:
            if kept + arcs <= ARCS_KEPT:
                walked, kept = list(_walk(first, ends, keys)), kept + arcs
            _push(walked or _walk(first, ends, keys), sigma, sums)
            fresh = np.flatnonzero((sums > 0) & unseen)
            reached = sums[fresh]
            sums.fill(0.0)
        else:
            values[keys] = sigma
            asking = np.flatnonzero(unseen)
            reached = _pull(_walk(first, ends, asking), values, len(asking))
            values[keys] = 0.0
            fresh, reached = asking[reached > 0], reached[reached > 0]
        levels.append((keys, sigma, arcs, walked))
        keys, sigma = fresh, reached
    below, sigma, below_arcs, _ = levels[-1]
    share = 1.0 / sigma
    for keys, sigma, arcs, walked in reversed(levels[1:-1]):
        if walked or arcs <= below_arcs:
            values[below] = share
            arriving = _pull(walked or _walk(first, ends, keys), values, len(keys))
            values[below] = 0.0
        else:
            _push(_walk(first, ends, below), share, sums)
            arriving = sums[keys]
            sums.fill(0.0)
        delta = sigma * arriving
        np.add.at(total, keys % n, delta)
        below, share, below_arcs = keys, (1.0 + delta) / sigma, arcs


def dependencies(first: np.ndarray, ends: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Per node, the sum of its dependencies for the given roots."""
    degree, total = np.diff(first), np.zeros(len(first) - 1)
    at_once = max(1, ENTRIES_AT_ONCE // max(len(degree), 1))
    for begin in range(0, len(roots), at_once):
        _search(first, ends, degree, roots[begin : begin + at_once], total)
    return total
