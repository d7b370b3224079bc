"""Benchmark decontamination: shared q-grams counted in diagonal bands, then banded alignment."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyleaf.llm.tables import new_table

Q = 10
#: Share of an item's characters that may be edited.
EDITS = 0.08
#: Bytes of benchmark text that are compared with all documents in one pass.
BLOCK_BYTES = 4 << 20
#: Pairs of places that are listed at once, and diagonals that are aligned at once.
PAIRS, WIDEST = 1 << 20, 1 << 15
SPACED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
LEAK = [("item_id", T.LongType()), ("edits", T.IntegerType()), ("start", T.LongType()), ("end", T.LongType())]
LEAKS_TYPE = T.ArrayType(T.StructType([T.StructField(*f) for f in LEAK]))


def normalised(text):
    """Lower case, letters and digits only, single blanks, as UTF-8."""
    return b" ".join((text or "").lower().encode().translate(SPACED).split())


def budget(length):
    """Edits allowed for an item of so many bytes: the share, but never so many that no q-gram need survive.

    Each edit destroys at most Q of the length - Q + 1 q-grams, so at least length - Q + 1 - Q * edits are left.
    """
    return min(int(EDITS * length), (length - Q) // Q)


def gram_hashes(data):
    """A hash of the Q bytes at each position of a byte string."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)
    count = len(raw) - Q + 1
    low = np.lib.stride_tricks.as_strided(raw, (count, 8), (1, 1)).copy().view("<u8").reshape(-1)
    high = raw[8 : 8 + count].astype(np.uint64) | (raw[9 : 9 + count].astype(np.uint64) << np.uint64(8))
    mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed ^ (mixed >> np.uint64(29))


def make_index(items):
    """The q-grams of normalised items, sorted by hash, with where they occur; ``short`` has the items without a q-gram."""
    short, long = [[(i, t) for i, t in items if (len(t) < Q) == small] for small in (True, False)]
    hashes = [gram_hashes(t) for _, t in long]
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(long)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    keys, starts, counts = np.unique(flat[order], return_index=True, return_counts=True)
    bits = max(16, int(np.ceil(np.log2(len(keys) + 1))) + 4)
    seen = np.zeros(1 << bits, bool)
    seen[keys >> np.uint64(64 - bits)] = True
    edits = np.array([budget(len(t)) for _, t in long], dtype=np.int64)
    least = np.array([len(t) - Q + 1 - Q * e for (_, t), e in zip(long, edits)], dtype=np.int64)
    words = {}
    for i, t in short:
        if t:
            words.setdefault(t, []).append(i)
    return dict(
        items=long, keys=keys, starts=starts, counts=counts, item=item[order], place=place[order],
        seen=seen, shift=np.uint64(64 - bits), edits=edits, least=least, short=words,
    )


def _spread(starts, counts):
    """The numbers start, start + 1, ... of each start, as many as its count, one run after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def candidates(data, index):
    """(item, band) pairs of one byte string that share enough q-grams: [(item number, first diagonal)].

    A match within e edits stays on e + 1 neighbouring diagonals. Bands are 2(e + 1) wide and begin every
    e + 1 diagonals, so one of them holds all its q-grams; the bands with fewer than the least number are dropped.
    The places of a q-gram in the text are listed once, however often items repeat it, and are put together with the
    item's places for one item at a time, and place by place where that gives too many pairs. So memory follows the text.
    """
    hashes = gram_hashes(data)
    at = np.flatnonzero(index["seen"][hashes >> index["shift"]])
    found = np.searchsorted(index["keys"], hashes[at])
    found[found == len(index["keys"])] = 0
    same = index["keys"][found] == hashes[at] if len(index["keys"]) else np.zeros(len(at), bool)
    at, found = at[same], found[same]
    by_gram = np.argsort(found, kind="stable")
    at = at[by_gram]
    grams, first, times = np.unique(found[by_gram], return_index=True, return_counts=True)
    per_gram = index["counts"][grams]
    posting = _spread(index["starts"][grams], per_gram)
    item, place, gram = index["item"][posting], index["place"][posting], np.repeat(np.arange(len(grams)), per_gram)
    # An item with too few q-grams in the whole string needs no bands.
    total = np.bincount(item, weights=times[gram], minlength=len(index["items"]))
    out = []
    for i in np.flatnonzero(total >= np.maximum(index["least"], 1)):
        mine = item == i
        step, places, g = int(index["edits"][i]) + 1, place[mine], gram[mine]
        if total[i] <= PAIRS:
            band = (at[_spread(first[g], times[g])] - np.repeat(places, times[g])) // step
            both = np.concatenate([band, band - 1])
            shared = np.unique(np.stack([both, np.tile(np.repeat(places, times[g]), 2)], axis=1), axis=0)[:, 0]
            bands, counts = np.unique(shared, return_counts=True)
        else:
            lowest = -(int(places.max()) // step) - 2
            counts = np.zeros(len(data) // step - lowest + 1, np.int32)
            for p, k in zip(places.tolist(), g.tolist()):
                band = (at[first[k] : first[k] + times[k]] - p) // step - lowest
                held = np.zeros(len(counts), bool)
                held[band] = held[band - 1] = True
                counts += held
            bands = np.arange(len(counts)) + lowest
        out += [(int(i), int(b) * step) for b in bands[counts >= index["least"][i]]]
    return out


def align(pattern, text, first, width):
    """(edits, end): the least edit distance of a byte string to a stretch of text, on ``width`` diagonals from ``first``.

    Row i of the table is the first i bytes of the pattern, column d the place in the text i + first + d. Places before
    and behind the text match nothing.
    """
    a, columns, never = np.frombuffer(pattern, np.uint8), np.arange(width), len(pattern) + 1
    padded = np.full(len(a) + width, 256, np.int32)
    start, end = max(first, 0), min(first + len(padded), len(text))
    if end > start:
        padded[start - first : end - first] = np.frombuffer(text, np.uint8)[start:end]
    row = np.zeros(width, np.int32)
    for i in range(len(a)):
        through = row + (padded[i : i + width] != a[i])
        down = np.append(row[1:], never) + 1
        row = np.minimum(through, down) - columns
        row = np.minimum.accumulate(row) + columns
    best = int(row.argmin())
    return int(row[best]), first + len(a) + best


def _stretches(found, index):
    """(item, first diagonal, width) of the bands to align: each with as many diagonals on either side as edits may lead
    away from it, and bands that meet are one stretch, up to WIDEST diagonals."""
    out = []
    for item, first in found:
        edits = int(index["edits"][item])
        start, end = first - edits, first + 2 * (edits + 1) + edits
        if out and out[-1][0] == item and start <= out[-1][2] and end - out[-1][1] <= WIDEST:
            out[-1][2] = end
        else:
            out.append([item, start, end])
    return [(item, start, end - start) for item, start, end in out]


def _whole(text, index):
    """The items without a q-gram that stand in a text word for word: (item_id, edits, start, end)."""
    best = {}
    if index["short"]:
        most = max(t.count(b" ") for t in index["short"]) + 1
        words, starts, at = text.split(), [], 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        for n in range(1, most + 1):
            for k in range(len(words) - n + 1):
                for item_id in index["short"].get(b" ".join(words[k : k + n]), ()):
                    best.setdefault(item_id, (starts[k], starts[k + n - 1] + len(words[k + n - 1])))
    return [(item_id, 0, *span) for item_id, span in best.items()]


def leaks(text, index):
    """[(item number, edits, start, end)] of one normalised text: for each item its nearest stretch within the budget."""
    best = {}
    for item, first, width in _stretches(candidates(text, index), index):
        pattern, edits = index["items"][item][1], int(index["edits"][item])
        if best.get(item, (edits + 1,))[0] == 0:
            continue
        got, end = align(pattern, text, first, width)
        if got <= edits and got < best.get(item, (edits + 1,))[0]:
            best[item] = (got, max(end - len(pattern), 0), min(end, len(text)))
    return [(item, *found) for item, found in sorted(best.items())]


def _annotate(items, column):
    index = make_index(items)

    def annotated(batches):
        for batch in batches:
            found = []
            for text in batch.column(column).to_pylist():
                plain = normalised(text)
                got = [(index["items"][i][0], *at) for i, *at in leaks(plain, index)] + _whole(plain, index)
                found.append([dict(item_id=i, edits=e, start=s, end=t) for i, e, s, t in got])
            columns = [*batch.columns, pa.array(found, LEAKS)]
            yield pa.RecordBatch.from_arrays(columns, [f"c{n}" for n in range(len(columns))])

    return annotated


def benchmark_blocks(items: DataFrame):
    """The benchmark's (item_id, normalised text) pairs, in lists of BLOCK_BYTES of text or one longer item.

    Only one list at a time is on the driver and in the tasks, however large the benchmark is.
    """
    rows = items.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    block, size = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        text = normalised(row.text)
        if block and size + len(text) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    if block:
        yield block


def with_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with a column ``_leaks``: the benchmark items (item_id, edits, start, end) that each text holds.

    An item is held if a stretch of the text is within its edit budget: EDITS of its bytes, after both were put in lower case
    and reduced to letters, digits and single blanks, but never more than leave one q-gram (``budget``), so items below some 50
    bytes have less. An item below Q bytes is held if it stands there word for word. ``start`` and ``end`` are bytes of
    the normalised text; ``start`` is ``end`` less the item's length, so off by up to ``edits``. Per item the nearest stretch is
    given, the first of equals. Null and empty texts hold nothing, items without a letter or digit are held by nothing, items
    of the same text are reported each, repeated rows and other columns are kept, but for one called ``_leaks``, which is replaced.
    Without items nothing is held. A benchmark above BLOCK_BYTES is taken block by block, and what a block found is written
    before the next is read, so one index at a time is in memory.
    """
    docs = docs.drop("_leaks")
    column, out, first = docs.columns.index("text"), docs.withColumn("_leaks", F.array().cast(LEAKS_TYPE)), True
    for block in benchmark_blocks(items):
        if not first:
            out = new_table(out, "leaks")
        # By place: the columns of docs may have any names.
        schema = T.StructType([*out.schema, T.StructField("_leaks", LEAKS_TYPE)])
        found = out.mapInArrow(_annotate(block, column), T.StructType([T.StructField(f"c{n}", f.dataType) for n, f in enumerate(schema)]))
        last = len(docs.columns)
        joined = F.concat(F.col(f"c{last}"), F.col(f"c{last + 1}"))
        out = found.select(*[f"c{n}" for n in range(last)], joined).toDF(*docs.columns, "_leaks")
        first = False
    return out


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, start, end) for every benchmark item held by a document; see ``with_leaks``."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_leaks(texts, items).select("doc_id", F.explode("_leaks").alias("leak")).select("doc_id", "leak.*")
