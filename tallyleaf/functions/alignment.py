"""Longest common subsequence of two word lists, with bit-parallel rows."""

from itertools import groupby
from math import isqrt


def matches(left, right):
    """The places (i, j) of a longest common subsequence of two lists, in order.

    A row is an integer with a bit per word of ``right``: zero where the common subsequence of the words so far grows. Only
    every so manieth row is kept; the rows between are made again, one stretch at a time, on the way back.
    """
    places, full = {}, (1 << len(right)) - 1
    for j, word in enumerate(right):
        places[word] = places.get(word, 0) | 1 << j
    stretch = isqrt(len(left)) + 1

    def after(row, word):
        met = row & places.get(word, 0)
        return ((row + met) | (row - met)) & full

    kept, row = [], full
    for i, word in enumerate(left):
        if i % stretch == 0:
            kept.append(row)
        row = after(row, word)
    found, j = [], len(right)
    for number in range(len(kept) - 1, -1, -1):
        start = number * stretch
        words = left[start : start + stretch]
        rows = [kept[number]]
        for word in words:
            rows.append(after(rows[-1], word))
        i = len(words)
        while i and j:
            if words[i - 1] == right[j - 1]:
                i, j = i - 1, j - 1
                found.append((start + i, j))
            elif rows[i] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
        if not j:
            break
    return found[::-1]


def parts(left, right):
    """[(side, words)]: stretches that are ``equal``, or only on the ``left`` or the ``right``, in reading order."""
    steps, i, j = [], 0, 0
    for to_i, to_j in [*matches(left, right), (len(left), len(right))]:
        steps += [("left", w) for w in left[i:to_i]] + [("right", w) for w in right[j:to_j]]
        steps += [("equal", w) for w in left[to_i : to_i + 1]]
        i, j = to_i + 1, to_j + 1
    return [(side, [w for _, w in run]) for side, run in groupby(steps, key=lambda s: s[0])]
