"""Sets as bits, and the pairs among the rows of a group, compared in NumPy."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

#: Bits to a member of a set, at least; their number is a power of two.
BITS = 4
#: Pairs listed at a time, and 64-bit words of them compared at a time.
LIST, WORDS = 1 << 17, 1 << 19


def set_bits(hashes):
    """A set of hashes as bits, each at the place its low end names. The halves of it laid over one another are the bits of half the width."""
    width = 1 << max(6, (BITS * len(hashes) - 1).bit_length())
    held = np.zeros(width, bool)
    held[hashes & (width - 1)] = True
    return np.packbits(held, bitorder="little").tobytes()


def most_shared(n, words, starts, i, j):
    """No two sets i and j share more members than this.

    A bit that only one of them has stands for one member at least that the other lacks. ``words`` are the bits of all rows,
    those of row r from ``starts[r]`` on; a wider one is laid over itself.
    """
    widths = np.diff(starts)
    swap = widths[i] > widths[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    kind = widths[i] << 32 | widths[j]
    out = np.empty(len(i), np.int64)
    for k in np.unique(kind):
        these, a, b = np.flatnonzero(kind == k), int(k >> 32), int(k & 0xFFFFFFFF)
        for at in range(0, len(these), max(1, WORDS // b)):
            part = these[at : at + max(1, WORDS // b)]
            left = words[starts[i[part], None] + np.arange(a)]
            right = words[starts[j[part], None] + np.arange(b)]
            if b > a:
                right = np.bitwise_or.reduce(right.reshape(len(part), b // a, a), axis=1)
            both = left & right
            only = [np.bitwise_count(side ^ both).sum(axis=1, dtype=np.int64) for side in (left, right)]
            out[part] = np.minimum(n[i[part]] - only[0], n[j[part]] - only[1])
    return out


def may_reach(n, words, starts, i, j, threshold):
    """Whether the sets i and j may reach the threshold; false only for those that do not."""
    sizes = n[i], n[j]
    close = np.minimum(*sizes) >= np.maximum(*sizes) * threshold - 1e-6
    out = np.zeros(len(i), bool)
    i, j = i[close], j[close]
    out[close] = most_shared(n, words, starts, i, j) * (1 + threshold) >= (n[i] + n[j]) * threshold - 1e-6
    return out


def bits_may_reach(n_a: Column, bits_a: Column, n_b: Column, bits_b: Column, threshold: float) -> Column:
    """``may_reach`` of two sets given by their sizes and bits."""

    @pandas_udf("boolean")
    def reach(n_a: pd.Series, bits_a: pd.Series, n_b: pd.Series, bits_b: pd.Series) -> pd.Series:
        n, bits = np.concatenate([n_a, n_b]).astype(np.int64), [*bits_a, *bits_b]
        starts = np.concatenate([[0], np.cumsum([len(b) // 8 for b in bits], dtype=np.int64)])
        i = np.arange(len(n_a))
        return pd.Series(may_reach(n, np.frombuffer(b"".join(bits), np.uint64), starts, i, i + len(n_a), threshold))

    return reach(n_a, bits_a, n_b, bits_b)


GROUP = ("bucket_id", "estimated_value", "low", "high")


def _groups(batches):
    """Tables of whole groups, from batches of rows that are sorted by GROUP; with each the places where a group begins."""

    def begins(table):
        changed = np.zeros(max(len(table) - 1, 0), bool)
        for name in GROUP:
            column = table[name].combine_chunks()
            if name == "estimated_value":
                column = column.dictionary_encode().indices
            changed |= np.diff(column.to_numpy(zero_copy_only=False)) != 0
        return np.concatenate([[0], np.flatnonzero(changed) + 1])

    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        starts = begins(table)
        if starts[-1]:
            yield table.slice(0, starts[-1]).combine_chunks(), starts[:-1]
        rest = table.slice(starts[-1])
    if rest is not None and len(rest):
        yield rest.combine_chunks(), np.array([0])


def _listed(column):
    """(values, starts) of a column of lists or of bytes."""
    column = pa.concat_arrays(column.chunks)
    starts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if pa.types.is_binary(column.type):
        held = np.frombuffer(column.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]].copy().view(np.uint64)
        return held, (starts - starts[0]) // 8
    return column.values.to_numpy(zero_copy_only=False), starts


def _first_shared(buckets, starts, i, j):
    """The least bucket of both rows of each pair. Buckets are sorted and not negative."""
    rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j, sizes = at[: len(i)], at[len(i) :], np.diff(starts)[rows]
    most = int(sizes.max())
    held = np.arange(most) < sizes[:, None]
    padded = np.where(held, buckets[np.minimum(starts[rows, None] + np.arange(most), len(buckets) - 1)], -1)
    other = np.where(held, padded, -2)
    out, step = np.empty(len(i), np.int64), max(1, (1 << 22) // most**2)
    for k in range(0, len(i), step):
        a = padded[i[k : k + step]]
        equal = (a[:, :, None] == other[j[k : k + step]][:, None, :]).any(axis=2)
        out[k : k + step] = a[np.arange(len(a)), equal.argmax(axis=1)]
    return out


def _met(table, starts, threshold):
    """(i, j) of the pairs of rows in each group that may reach the threshold, in the first bucket they share.

    In a group of two blocks the rows of the one meet those of the other. Rows of a component do not meet, nor two that are not outside.
    """
    columns = ("bucket_id", "low", "high", "own", "component", "outside", "n")
    bucket, low, high, own, component, outside, n = (table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in columns)
    n = n.astype(np.int64)
    (words, at), (buckets, held) = _listed(table["bits"]), _listed(table["buckets"])
    ends = np.concatenate([starts[1:], [len(table)]])
    group = np.repeat(np.arange(len(starts)), ends - starts)
    second = (starts + np.add.reduceat((own == low).astype(np.int64), starts))[group]
    last = ends[group]
    first = np.where(low == high, np.arange(len(table)) + 1, np.where(own == low, second, last))
    counts = last - first
    upto, row = np.cumsum(counts), 0
    while row < len(table):
        before = upto[row] - counts[row]
        to = max(row + 1, int(np.searchsorted(upto, before + LIST, "right")))
        i = np.repeat(np.arange(row, to), counts[row:to])
        j = first[i] + np.arange(len(i)) - (upto - counts - before)[i]
        kept = (component[i] != component[j]) & (outside[i] | outside[j])
        i, j, row = i[kept], j[kept], to
        kept = may_reach(n, words, at, i, j, threshold)
        i, j = i[kept], j[kept]
        if len(i):
            kept = _first_shared(buckets, held, i, j) == bucket[i]
            yield i[kept], j[kept]


def ends_of_pairs(columns, threshold):
    """For ``mapInArrow``: of rows sorted by GROUP and block those that are in a pair of ``_met``, with the named columns."""

    def found(batches):
        for table, starts in _groups(batches):
            kept = np.zeros(len(table), bool)
            for i, j in _met(table, starts, threshold):
                kept[i] = kept[j] = True
            yield from table.select(columns).filter(pa.array(kept)).to_batches()

    return found


def similar_pairs(threshold):
    """For ``mapInArrow``: (id_a, id_b, jaccard) of the pairs of ``_met`` whose ``sets`` reach the threshold."""

    def found(batches):
        for table, starts in _groups(batches):
            ids = table["notice_id"].combine_chunks().to_numpy(zero_copy_only=False)
            sets, at = _listed(table["sets"])
            for i, j in _met(table, starts, threshold):
                ordered = {r: np.sort(sets[at[r] : at[r + 1]]) for r in np.unique(np.concatenate([i, j]))}
                out = []
                for a, b in zip(i, j):
                    both = np.sort(np.concatenate([ordered[a], ordered[b]]))
                    shared = int(np.count_nonzero(both[1:] == both[:-1]))
                    jaccard = shared / (len(both) - shared)
                    if jaccard >= threshold:
                        out.append((*sorted((int(ids[a]), int(ids[b]))), jaccard))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["id_a", "id_b", "jaccard"])

    return found
