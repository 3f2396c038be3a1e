"""Bisecting k-means over sparse unit vectors: the part that runs inside one task.

All nodes of a level are split together, in array operations over the (node, feature) pairs that
occur, so a task's time follows the number of its entries and not that of its nodes.  A node whose
mean similarity reaches the limit is a leaf, whatever its size, unless its halves share nothing; dispersion comes from sums alone
(|sum|^2 = sum over all pairs of rows).  Splits of different nodes don't touch each other, so taking
all open nodes of a level gives the same leaves as taking the one of largest dispersion each time.
"""

from __future__ import annotations

import numpy as np

#: Lloyd iterations of one split.
ROUNDS = 4
#: Mean similarity between the halves of a leaf: below it they have nothing to do with each other, however compact each is.
APART = 0.02
#: Mean similarity at which halves aren't looked for.
ALIKE = 0.9
#: Hyperplanes tried on a node before its rows are dealt by their ids, to start from.
ATTEMPTS = 6


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Pseudo-random 64-bit numbers, the same on every machine."""
    m = (x.astype(np.uint64) + np.uint64(salt * 7919 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    m ^= m >> np.uint64(29)
    return m * np.uint64(0xBF58476D1CE4E5B9)


def coin(x: np.ndarray, salt: int) -> np.ndarray:
    return (mixed(x, salt) >> np.uint64(40)) & np.uint64(1) == 1


def sign_of(features: np.ndarray, salt: int) -> np.ndarray:
    """A random hyperplane: +1 or -1 for each feature."""
    return np.where(coin(features, salt), 1.0, -1.0)


def take(indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The CSR matrix of the given rows."""
    lengths = (indptr[1:] - indptr[:-1])[rows]
    out = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    where = np.arange(out[-1]) - np.repeat(out[:-1] - indptr[rows], lengths)
    return out, indices[where], data[where]


def bisect(indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, ids: np.ndarray, compact: float, salt: int = 1, rounds: int = ROUNDS) -> np.ndarray:
    """The leaf, numbered from 0, of each row of a CSR matrix of unit vectors.

    ids: a 64-bit hash of each row's id, which decides where no hyperplane divides a node.  A row that
    shares no feature with any other row of its node is a leaf of its own."""
    n = len(indptr) - 1
    leaf, leaves, named = np.full(n, -1, np.int64), 0, np.arange(n)  # named: the rows of the matrix that are left
    node, nodes, live = np.zeros(n, np.int64), 1, np.arange(n)
    features, pair = np.unique(indices, return_inverse=True)  # a pair is a feature within a node
    of = np.zeros(len(features), np.int64)  # the node of each pair
    row, value = np.repeat(np.arange(n), np.diff(indptr)), data
    tries = np.zeros(1, np.int64)
    depth = 0
    while len(live):
        # features of a single row of the node can't draw rows together, nor can rows without others
        shared = np.bincount(pair, minlength=len(of)) > 1
        stay = shared[pair]
        row, value, pair = row[stay], value[stay], (np.cumsum(shared) - 1)[pair[stay]]
        features, of = features[shared], of[shared]
        bound = np.zeros(n, bool)
        bound[row] = True
        lone = live[~bound[live]]
        leaf[named[lone]] = leaves + np.arange(len(lone))
        leaves += len(lone)
        live = live[bound[live]]
        size = np.bincount(node[live], minlength=nodes)
        total = np.bincount(pair, value, len(of))
        between = np.bincount(of, total * total - np.bincount(pair, value * value, len(of)), nodes)
        close = (size > 0) & (between >= compact * size * (size - 1.0))
        alike = (size > 0) & (between >= ALIKE * size * (size - 1.0))
        if 2 * len(live) < n:  # go on with these alone
            place = np.zeros(n, np.int64)
            place[live] = np.arange(len(live))
            open_rows = np.zeros(n, bool)
            open_rows[live] = True
            stay = open_rows[row]
            row, value, pair = place[row[stay]], value[stay], pair[stay]
            node, ids, named, n = node[live], ids[live], named[live], len(live)
            live = np.arange(n)
        still = np.zeros(nodes, bool)
        still[node[live]] = True
        renumbered = np.cumsum(still) - 1
        kept, stay = still[of], still[of[pair]]
        row, value, pair = row[stay], value[stay], (np.cumsum(kept) - 1)[pair[stay]]
        features, of, total, close, alike = features[kept], renumbered[of[kept]], total[kept], close[still], alike[still]
        node[live] = renumbered[node[live]]
        tries, size, nodes = tries[still], size[still].astype(float), int(still.sum())
        at = node[live]
        side = np.zeros(n, bool)
        side[live] = np.where(tries[at] < ATTEMPTS, np.bincount(row, value * sign_of(features, salt + depth)[pair], n)[live] > 0, coin(ids[live], salt + depth))
        fixed = tries >= 2 * ATTEMPTS  # Lloyd iterations undo every start: the ids divide it
        for _ in range(rounds):
            right = np.bincount(at, side[live], nodes)
            two = (right > 0) & (right < size) & ~fixed
            one = np.bincount(pair, value * side[row], len(of))
            c1, c0 = one / np.maximum(right, 1)[of], (total - one) / np.maximum(size - right, 1)[of]
            plane = c1 - c0
            bias = np.bincount(of, plane * (c1 + c0), nodes) / 2
            new = np.where(two[at], np.bincount(row, value * plane[pair], n)[live] > bias[at], side[live])
            if (new == side[live]).all():
                break
            side[live] = new
        right = np.bincount(at, side[live], nodes)
        split = (right > 0) & (right < size)
        # a compact node is a leaf, unless its halves share next to nothing
        one = np.bincount(pair, value * side[row], len(of))
        across = np.bincount(of, one * (total - one), nodes)
        done = close & (alike | np.where(split, across >= APART * right * (size - right), tries >= ATTEMPTS - 1))
        at = node[live]
        leaf[named[live[done[at]]]] = leaves + (np.cumsum(done) - 1)[at[done[at]]]
        leaves += int(done.sum())
        over = np.zeros(n, bool)
        over[live[done[at]]] = True
        live = live[~done[at]]
        stay = ~over[row]
        row, value, pair = row[stay], value[stay], pair[stay]
        at = node[live]
        if not len(live):
            break
        tries = np.where(split, 0, tries + 1)
        half = np.zeros(n, np.int64)
        half[live] = side[live] & split[at]
        child = 2 * node[live] + half[live]
        used = np.zeros(2 * nodes, bool)
        used[child] = True
        renumbered = np.cumsum(used) - 1
        node[live], nodes, tries = renumbered[child], int(used.sum()), np.repeat(tries, 2)[used]
        pair = 2 * pair + half[row]
        used = np.zeros(2 * len(of), bool)
        used[pair] = True
        both = (2 * of[:, None] + np.arange(2)).ravel()
        pair, of, features = (np.cumsum(used) - 1)[pair], renumbered[both[used]], np.repeat(features, 2)[used]
        depth += 1
    return leaf
