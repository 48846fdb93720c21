"""What the tasks of a forest fit do with arrays: draws, histograms, splits,
subtrees, routes. Rows are binned: a cell is the number of its feature's
thresholds below the value, so a split "at most this cell" is one comparison.

Executors need numpy and pyarrow but not this package: the functions travel
with the tasks.
"""

from __future__ import annotations

import sys
from math import exp, factorial

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Nodes whose histograms are held at once by a task, and rows that are counted
# at once: their arrays stay in a core's cache.
NODES_AT_ONCE = 256
ROWS_AT_ONCE = 8192
# Cumulative Poisson(1): how often a row is drawn into a tree's bootstrap.
POISSON = np.cumsum([exp(-1) / factorial(k) for k in range(18)])
# The draws of a hash by its first 12 bits; -1 where those do not settle them.
_FIRST = np.searchsorted(POISSON, np.arange(4096) / 4096, side="right")
_DRAWS = np.where(_FIRST == np.searchsorted(POISSON, np.arange(1, 4097) / 4096, side="left"), _FIRST, -1).astype(np.int8)
LEAST_GAIN = 1e-12


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash (splitmix)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the bootstrap of a tree: the same wherever the
    row lies."""
    key = _mixed(np.array([seed * 1_000_003 + tree], dtype=np.uint64))
    mixed = _mixed(ids ^ key)
    out = _DRAWS.take((mixed >> np.uint64(52)).astype(np.int64)).astype(np.int64)
    unsure = np.flatnonzero(out < 0)
    out[unsure] = np.searchsorted(POISSON, (mixed[unsure] >> np.uint64(11)) * 2.0**-53, side="right")
    return out


def cuts_of(found: np.ndarray, n: np.ndarray, bins: int, distinct: int, total: int, before: int, after: float | None) -> np.ndarray:
    """Thresholds that lie in one range of a feature's values, or between it and
    the next. ``found``, ``n``: the distinct values of the range and the rows of
    each; ``distinct``, ``total``: values and rows of all ranges; ``before``:
    rows of the ranges before; ``after``: the first value of the next."""
    cuts = np.arange(len(found))
    if distinct > bins:
        upto, wanted = before + np.cumsum(n), total / bins * np.arange(1, bins)
        cuts = np.unique(np.searchsorted(upto, wanted[(wanted > before) & (wanted <= upto[-1])]))
    if after is None:
        cuts = cuts[cuts < len(found) - 1]
    low, high = found[cuts], np.append(found[1:], found[-1] if after is None else after)[cuts]
    return low + (high - low) / 2


def thresholds_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds of one feature: midpoints of its distinct values, or at
    ``bins`` - 1 quantiles if it has more."""
    found, n = np.unique(values[~np.isnan(values)], return_counts=True)
    return cuts_of(found, n, bins, len(found), n.sum(), 0, None) if len(found) > 1 else np.empty(0)


def binned(values: np.ndarray, thresholds: list) -> np.ndarray:
    """Cells of the values, row by row; NaN lies above every threshold."""
    out = np.empty(values.shape, dtype=np.uint8)
    for j, cuts in enumerate(thresholds):
        out[:, j] = np.searchsorted(cuts, values[:, j], side="left")
    return out


def feature_subsets(rng: np.random.Generator, nodes: int, features: int, k: int) -> np.ndarray:
    """``k`` of the features for each node."""
    draw = rng.random((nodes, features))
    if k >= features:
        return np.argsort(draw, axis=1)
    least = np.argpartition(draw, k - 1, axis=1)[:, :k]
    return np.take_along_axis(least, np.argsort(np.take_along_axis(draw, least, axis=1), axis=1), axis=1)


def histogram(x, y, n, at, subset, sizes, classes: int) -> np.ndarray:
    """Drawn rows by class and (node, feature of its subset, cell). ``at``: the
    node of each row of ``x``."""
    width = sizes[subset]
    starts = (np.cumsum(width) - width.ravel()).reshape(width.shape)
    cell = starts[at] + x
    weights = np.repeat(n.astype(np.float64), subset.shape[1])
    cells = int(width.sum())
    return np.bincount((cell + cells * y.astype(np.int64)[:, None]).ravel(), weights, cells * classes).reshape(classes, cells)


def histogram_of(x, y, n, rows, at, subset, sizes, classes: int) -> np.ndarray:
    """``histogram`` of some ``rows`` of all, some of them at a time. ``at``:
    the node of each of the rows; ``x``: all features."""
    flat, out = x.reshape(-1), np.zeros((classes, int(sizes[subset].sum())))
    for i in range(0, len(rows), ROWS_AT_ONCE):
        r, p = rows[i : i + ROWS_AT_ONCE], at[i : i + ROWS_AT_ONCE]
        cells = flat.take(subset[p] + (r * x.shape[1])[:, None])
        out += histogram(cells, y[r], n[r], p, subset, sizes, classes)
    return out


def histogram_at(columns, y, n, rows, subset, sizes, classes: int) -> np.ndarray:
    """``histogram`` of the ``rows`` of one node. ``columns``: the cells of all
    rows, a line a feature."""
    width = sizes[subset]
    cells = int(width.sum())
    at = columns[subset].take(rows, axis=1) + (np.cumsum(width) - width)[:, None]
    at += y.take(rows).astype(np.int64) * cells
    weights = np.tile(n.take(rows).astype(np.float64), len(subset))
    return np.bincount(at.ravel(), weights, cells * classes).reshape(classes, cells)


def paths(feature, left, wanted) -> list[bool]:
    """Of every node, whether one of the ``wanted`` is it or lies below."""
    out = [node in wanted for node in range(len(feature))]
    for node in reversed(range(len(feature))):
        if feature[node] >= 0:
            out[node] = out[node] or out[left[node]] or out[left[node] + 1]
    return out


def arrivals(feature, cell, left, on_path, wanted, columns, rows):
    """(node, rows that come to it) of the ``wanted`` nodes that any do. Only
    their paths (``paths``) are followed. ``columns``: a line a feature."""
    open_ = [(0, rows)]
    while open_:
        node, own = open_.pop()
        if not on_path[node] or not len(own):
            continue
        if node in wanted:
            yield node, own
            continue
        low, child = columns[feature[node]].take(own) <= cell[node], left[node]
        if on_path[child + 1]:
            open_.append((child + 1, own[~low]))
        if on_path[child]:
            open_.append((child, own[low]))


def best_splits(counts, subset, sizes, weights, min_leaf: int):
    """gain, feature, cell, class counts left and in all, of each node's best
    split by weighted Gini impurity; gain -1 where none leaves enough rows."""
    k = subset.shape[1]
    width = sizes[subset].ravel()
    opens = np.cumsum(width) - width  # the first cell of a (node, feature)
    # Cells without rows split as the one before them: small nodes have few
    # others.
    used = counts.any(axis=0)
    used[opens] = True
    width = np.add.reduceat(used, opens, dtype=np.int64)
    used = np.flatnonzero(used)
    counts = counts[:, used]
    ends = np.cumsum(width)
    starts = ends - width
    # A line per class: sums over the classes run along the cells.
    running = np.concatenate([np.zeros((len(counts), 1)), np.cumsum(counts, axis=1)], axis=1)
    at = np.repeat(np.arange(len(width)), width)  # the (node, feature) of a cell
    left = running[:, 1:] - np.repeat(running[:, starts], width, axis=1)
    per_node = np.add.reduceat(width, np.arange(0, len(width), k))  # cells of a node
    total = running[:, ends[::k]] - running[:, starts[::k]]
    right = np.repeat(total, per_node, axis=1) - left

    def squares(c):
        w = c * weights[:, None]
        size = w.sum(axis=0)
        return (w * w).sum(axis=0) / np.maximum(size, 1e-300), size

    own, size = squares(total)
    gain = (squares(left)[0] + squares(right)[0] - np.repeat(own, per_node)) / np.repeat(np.maximum(size, 1e-300), per_node)
    enough = (left.sum(axis=0) >= min_leaf) & (right.sum(axis=0) >= min_leaf)
    gain = np.where(enough, gain, -1.0)
    firsts = starts[::k]
    best = np.maximum.reduceat(gain, firsts)
    place = np.minimum.reduceat(np.where(gain == np.repeat(best, per_node), np.arange(len(gain)), len(gain)), firsts)
    slot = at[place]
    return best, subset.ravel()[slot], used[place] - opens[slot], left[:, place].T, total.T


def grow(x, y, n, classes: int, sizes, weights, k: int, min_leaf: int, depth: int, rng: np.random.Generator):
    """A subtree over binned rows ``x`` of classes ``y``, drawn ``n`` times:
    feature (-1: leaf), cell, left child (right is next), class shares."""
    rows, at = np.arange(len(y)), np.zeros(len(y), dtype=np.int64)
    total = np.bincount(y, n, classes)[None, :]
    done, base = [], 0
    while True:
        feature, cell, left = (np.full(len(total), v) for v in (-1, 0, 0))
        may = (total.sum(axis=1) >= 2 * min_leaf) & (np.count_nonzero(total, axis=1) > 1) & (depth > 0)
        nodes = np.flatnonzero(may)
        number = np.full(len(total), -1)
        number[nodes] = np.arange(len(nodes))
        at = number[at]
        rows, at = rows[at >= 0], at[at >= 0]
        if len(nodes):
            subset = feature_subsets(rng, len(nodes), x.shape[1], k)
            order = np.argsort(at.astype(np.uint16) if len(nodes) < 1 << 16 else at, kind="stable")
            rows, at = rows[order], at[order]
            # The rows of a node lie together, as they do in every level below.
            x, y, n, rows = x.take(rows, axis=0), y[rows], n[rows], np.arange(len(rows))
            parts, i = [], 0
            firsts = np.searchsorted(at, np.arange(len(nodes) + 1))  # where each node's rows begin
            while i < len(nodes):
                end = max(i + 1, min(i + NODES_AT_ONCE, int(np.searchsorted(firsts, firsts[i] + ROWS_AT_ONCE, "right")) - 1))
                some, a, b = subset[i:end], firsts[i], firsts[end]
                counts = histogram_of(x, y, n, rows[a:b], at[a:b] - i, some, sizes, classes)
                parts.append(best_splits(counts, some, sizes, weights, min_leaf)[:3])
                i = end
            gain, best, cut = (np.concatenate(v) for v in zip(*parts))
            split = gain > LEAST_GAIN
            inner = nodes[split]
            feature[inner], cell[inner] = best[split], cut[split]
            left[inner] = base + len(total) + 2 * np.arange(len(inner))
            number = np.full(len(nodes), -1)
            number[split] = np.arange(len(inner))
            keep = split[at]
            rows, at = rows[keep], at[keep]
            at = 2 * number[at] + (x[rows, best[at]] > cut[at])
        shares = total * weights
        done.append((feature, cell, left, shares / np.maximum(shares.sum(axis=1), 1e-300)[:, None]))
        base += len(total)
        children = 2 * int((feature >= 0).sum())
        if not children:
            break
        total = np.bincount(at * classes + y[rows], n[rows], children * classes).reshape(children, classes)
        depth -= 1
    feature, cell, left, shares = (np.concatenate(v) for v in zip(*done))
    # As MLlib prunes: two leaves of one class become one, from below.
    best, end = shares.argmax(axis=1), len(feature)
    for level in reversed(done):
        nodes = np.arange(end - len(level[0]), end)
        end -= len(level[0])
        nodes = nodes[feature[nodes] >= 0]
        a, b = left[nodes], left[nodes] + 1
        feature[nodes[(feature[a] < 0) & (feature[b] < 0) & (best[a] == best[b])]] = -1
    return feature.astype(np.int16), cell.astype(np.uint8), left.astype(np.int32), shares


def route(feature, cell, left, x, rows, nodes):
    """The leaves that pairs of a row of ``x`` and a start node come to."""
    live = np.arange(len(nodes))
    while len(live):
        node = nodes[live]
        f = feature[node]
        inner = f >= 0
        live, node, f = live[inner], node[inner], f[inner]
        nodes[live] = left[node] + (x[rows[live], f] > cell[node])
    return nodes
