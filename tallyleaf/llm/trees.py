"""Gradient-boosted trees on the logistic loss, and isotonic calibration."""

import numpy as np

#: LEAST bounds the sum of second derivatives in a leaf.
BINS, DEPTH, ROUNDS, RATE, LEAST = 32, 3, 60, 0.2, 0.3


def _grow(binned, slope, curve, rows, depth, tree):
    """Adds a node to ``tree`` and returns its number. A node is (feature, bin, left, right, value)."""
    at = len(tree)
    g, h = slope[rows].sum(), curve[rows].sum()
    tree.append((-1, 0, 0, 0, float(RATE * g / (h + 1.0))))
    if depth == 0:
        return at
    best, where = 1e-6, None
    for f in range(binned.shape[1]):
        gs = np.cumsum(np.bincount(binned[rows, f], slope[rows], BINS))[:-1]
        hs = np.cumsum(np.bincount(binned[rows, f], curve[rows], BINS))[:-1]
        gain = gs**2 / (hs + 1.0) + (g - gs) ** 2 / (h - hs + 1.0) - g**2 / (h + 1.0)
        gain[(hs < LEAST) | (h - hs < LEAST)] = 0.0
        if gain.max() > best:
            best, where = gain.max(), (f, int(gain.argmax()))
    if where:
        left = binned[rows, where[0]] <= where[1]
        a = _grow(binned, slope, curve, rows[left], depth - 1, tree)
        b = _grow(binned, slope, curve, rows[~left], depth - 1, tree)
        tree[at] = (*where, a, b, tree[at][4])
    return at


def _binned(cuts, x):
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)


def boost(x, y):
    """The model (start, cuts, trees) for features x and labels y."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    share = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
    start, trees = float(np.log(share / (1 - share))), []
    binned, margins = _binned(cuts, x), np.full(len(x), start)
    for _ in range(ROUNDS if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margins))
        tree = []
        _grow(binned, y - p, p * (1 - p), np.arange(len(x)), DEPTH, tree)
        trees.append(np.array(tree))
        margins += _walk(trees[-1], binned)
    return start, cuts, trees


def _walk(tree, binned):
    node = np.zeros(len(binned), np.int64)
    for _ in range(DEPTH):
        feature = tree[node, 0].astype(np.int64)
        inner = feature >= 0
        left = binned[np.arange(len(binned)), np.maximum(feature, 0)] <= tree[node, 1]
        node = np.where(inner, np.where(left, tree[node, 2], tree[node, 3]).astype(np.int64), node)
    return tree[node, 4]


def margin(model, x):
    """Log-odds before calibration."""
    start, cuts, trees = model
    out, binned = np.full(len(x), start), _binned(cuts, x)
    for tree in trees:
        out += _walk(tree, binned)
    return out


def isotonic(margins, y):
    """Steps (margins, probabilities) of the non-decreasing fit of labels to margins, by pooling adjacent violators."""
    order = np.argsort(margins, kind="stable")
    blocks = []
    for m, label in zip(margins[order].tolist(), y[order].tolist()):
        # Equal margins cannot be told apart and pool from the start.
        if blocks and blocks[-1][3] == m:
            blocks[-1][0] += label
            blocks[-1][1] += 1
        else:
            blocks.append([float(label), 1, m, m])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, n, _, high = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += n
            blocks[-1][3] = high
    points = [(edge, total / n) for total, n, low, high in blocks for edge in ((low, high) if high > low else (low,))]
    return np.array(points, dtype=np.float64).reshape(-1, 2)


def calibrated(points, margins):
    """Probabilities of margins; a trace of the margin itself keeps the order within a step."""
    plain = 1 / (1 + np.exp(-margins))
    if not len(points):
        return plain
    fitted = np.interp(margins, points[:, 0], points[:, 1])
    return np.clip(0.98 * fitted + 0.02 * plain, 0.0, 1.0)
