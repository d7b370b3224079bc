"""Shingle hashes, MinHash signatures, bands and similarities."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallyleaf.functions.pairs import set_bits

try:  # Python's own: on short strings it takes less than half the time of the one in OpenSSL.
    from _md5 import md5
except ImportError:
    from hashlib import md5

PRIME = 2147483647
SEED = 42
CHUNK = 1 << 16


def hash_family(k):
    """k pairs (a, b) of the family x -> (a*x + b) mod PRIME; a longer family starts with a shorter one.

    A plain function, as one that caches would be looked up by name on the workers, which need not have the package.
    """
    rng = random.Random(SEED)
    return [(rng.randrange(1, 10**9), rng.randrange(0, 10**9)) for _ in range(k)]


def hash60(text: Column) -> Column:
    """The first 60 bits of MD5 as a bigint."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def shingle_hashes(shingles: Column) -> Column:
    """One residue below PRIME per shingle: all a signature needs."""
    return F.transform(shingles, lambda s: (hash60(s) % PRIME).cast("int"))


def _hashes(text, n):
    """``hash60`` of the distinct word n-grams of one text, in the order of ``text.word_ngrams``."""
    words = text.split(" ") if text else []
    grams = dict.fromkeys(map(" ".join, zip(*[words[i:] for i in range(n)])) if len(words) >= n else words)
    digests = b"".join([md5(gram, usedforsecurity=False).digest() for gram in map(str.encode, grams)])
    return (np.frombuffer(digests, dtype=">u8")[::2] >> np.uint64(4)).astype(np.int64)


def ngram_hashes(text: Column, n: int) -> Column:
    """``hash60`` of the distinct word n-grams of a text whose blanks are single spaces: no n-gram is kept as a string."""

    @pandas_udf("array<bigint>")
    def hashed(batch: pd.Series) -> pd.Series:
        return pd.Series([None if text is None else _hashes(text, n) for text in batch], dtype=object)

    return hashed.asNondeterministic()(text)


def ngram_signature(text: Column, n: int, k: int) -> Column:
    """The signature of the word n-grams of a text, as ``signature`` gives it of their hashes; null without a word."""

    @pandas_udf("array<int>")
    def signed(batch: pd.Series) -> pd.Series:
        return pd.Series(_signed((_hashes(text, n) % PRIME for text in batch.fillna("")), k), dtype=object)

    return signed.asNondeterministic()(text)


def ngram_features(text: Column, n: int, signed_n: int, k: int) -> Column:
    """``sets``, the hashes of the word n-grams of a text, their ``bits``, and ``signature``, that of its word ``signed_n``-grams, in one pass."""

    @pandas_udf("sets array<bigint>, bits binary, signature array<int>")
    def features(batch: pd.Series) -> pd.DataFrame:
        texts = batch.fillna("")
        sets = pd.Series([_hashes(text, n) for text in texts], dtype=object)
        bits = pd.Series([set_bits(hashes) for hashes in sets], dtype=object)
        return pd.DataFrame({"sets": sets, "bits": bits, "signature": pd.Series(_signed((_hashes(t, signed_n) % PRIME for t in texts), k), dtype=object)})

    return features.asNondeterministic()(text)


def ngram_signatures(text: Column, sizes, k: int) -> Column:
    """``sets``, the hashes of the word n-grams of a text for the first of the sizes, and a signature of those of each, in one pass."""
    names = [f"signature_{n}" for n in sizes]

    @pandas_udf(", ".join(["sets array<bigint>", *[f"{name} array<int>" for name in names]]))
    def signed(batch: pd.Series) -> pd.DataFrame:
        out, texts = {}, batch.fillna("")
        for name, n in zip(names, sizes):
            hashes = [_hashes(text, n) for text in texts]
            out.setdefault("sets", pd.Series(hashes, dtype=object))
            out[name] = pd.Series(_signed((h % PRIME for h in hashes), k), dtype=object)
        return pd.DataFrame(out)

    return signed.asNondeterministic()(text)


def _packed(codes, n):
    """One integer per n-gram of an array of codes: equal for equal n-grams and for no others.

    The codes are packed side by side; where that would take more than 62 bits, what is packed so far is replaced by its rank.
    """
    size = int(codes.max()) + 1
    grams, span = codes, size
    for i in range(1, n):
        if span * size > 1 << 62:
            grams = np.unique(grams, return_inverse=True)[1]
            span = int(grams.max()) + 1
        grams = grams[:-1] * size + codes[i:]
        span *= size
    return grams


def _coded(texts, unit):
    """Each text as an array of its code points, or of numbers of its words, which are the same in all of the texts."""
    if unit == "char":
        return [np.frombuffer(t.encode("utf-32-le"), dtype="<u4").astype(np.int64) for t in texts]
    texts = [t.split(" ") if t else [] for t in texts]
    numbers = {w: i for i, w in enumerate(set().union(*texts))}
    return [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]


def _count_distinct(*some):
    """Different values in arrays; sorting takes a tenth of the time of ``np.unique``."""
    values = np.sort(np.concatenate(some))
    return int(np.count_nonzero(values[1:] != values[:-1])) + 1 if len(values) else 0


def _distinct_grams(codes, unit, n):
    """How many distinct n-grams there are; of fewer than n characters there is one, of fewer words each is one."""
    if len(codes) >= n:
        return _count_distinct(_packed(codes, n))
    return 1 if unit == "char" else _count_distinct(codes)


def _shared_grams(a, b, unit, n):
    """(shared, of a, of b): distinct n-grams, those of short texts as in ``_distinct_grams``."""
    if (len(a) < n) != (len(b) < n):
        # No n-gram equals what stands for them in a shorter text.
        return 0, _distinct_grams(a, unit, n), _distinct_grams(b, unit, n)
    if len(a) < n and unit == "char":
        return int(np.array_equal(a, b)), 1, 1
    length = n if len(a) >= n else 1
    both = np.concatenate([a, b])
    # Those across the border of the two are left out.
    grams = _packed(both, length) if len(both) else both
    mine, others = grams[: max(len(a) - length + 1, 0)], grams[len(a) :]
    size_a, size_b = _count_distinct(mine), _count_distinct(others)
    return size_a + size_b - _count_distinct(mine, others), size_a, size_b


def ngram_counts(shingled) -> Column:
    """The numbers of distinct n-grams of texts in one pass, as a struct. ``shingled`` are (name, text, "char" or "word", n).

    They are the sizes of ``text.char_ngrams`` and ``text.word_ngrams``, of which no n-gram is kept as a string.
    """
    names, columns, units, sizes = zip(*shingled)

    @pandas_udf(", ".join(f"{name} int" for name in names))
    def counted(*batch: pd.Series) -> pd.DataFrame:
        found = [[_distinct_grams(_coded([t], unit)[0], unit, n) for t in texts] for texts, unit, n in zip(batch, units, sizes)]
        return pd.DataFrame(dict(zip(names, found)), dtype=np.int32)

    return counted.asNondeterministic()(*columns)


def shared_ngrams(shingled) -> Column:
    """An array of (shared, size_a, size_b): the distinct n-grams of two texts, for each (text a, text b, "char" or "word", n).

    So texts travel to a pair and not their sets, which are many times as long. N-grams are compared themselves, not by a hash.
    """
    lefts, rights, units, sizes = zip(*shingled)

    @pandas_udf("array<struct<shared: int, size_a: int, size_b: int>>")
    def shared(*batch: pd.Series) -> pd.Series:
        out = []
        for texts in zip(*batch):
            coded, row = {}, []
            for a, b, unit, n in zip(texts, texts[len(units) :], units, sizes):
                if (unit, a, b) not in coded:
                    coded[unit, a, b] = _coded((a, b), unit)
                row.append(dict(zip(("shared", "size_a", "size_b"), _shared_grams(*coded[unit, a, b], unit, n))))
            out.append(row)
        return pd.Series(out, dtype=object)

    return shared.asNondeterministic()(*lefts, *rights)


def _mod_prime(x):
    # PRIME is 2^31 - 1, so folding the high bits onto the low ones is the division.
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x == PRIME, 0, x)


def _signed(rows, k):
    """The k minima over each of the rows of hashes; none for an empty one.

    Slices of about CHUNK hashes stay in cache and bound the memory, however long the texts are.
    """
    family, out, some, size = hash_family(k), [], [], 0

    def minima():
        flat = np.concatenate([h for _, h in some])
        starts = np.concatenate([[0], np.cumsum([len(h) for _, h in some])[:-1]])
        least = np.stack([np.minimum.reduceat(_mod_prime(flat * a + b), starts) for a, b in family], axis=1)
        for (i, _), row in zip(some, least.astype(np.int32)):
            out[i] = row

    for i, hashes in enumerate(rows):
        out.append(None)
        if len(hashes):
            some.append((i, hashes))
            size += len(hashes)
        if size >= CHUNK:
            minima()
            some, size = [], 0
    if some:
        minima()
    return out


def signature(hashes: Column, k: int) -> Column:
    """The k minima over a non-empty array of shingle hashes; null for an empty one."""

    @pandas_udf("array<int>")
    def minima(batch: pd.Series) -> pd.Series:
        return pd.Series(_signed((np.empty(0, np.int64) if h is None else h.astype(np.int64) for h in batch), k), dtype=object)

    # The flag only tells the optimizer not to copy the call into conditions pushed below it.
    return minima.asNondeterministic()(hashes)


def band_buckets(sig: Column, bands: int, rows: int) -> Column:
    """Bucket id per band, in band order. The band is part of the hashed text, so ids never meet across bands."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: hash60(F.concat(i.cast("string"), F.lit(":"), F.array_join(F.slice(sig, i * rows + 1, rows), ","))),
    )


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets held as distinct arrays; 0.0 when either is empty."""
    both = overlap(a, b)
    union = F.size(a) + F.size(b) - both
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / union)


def candidate_probability(s: Column, bands: int, rows: int) -> Column:
    """Chance that banding proposes a pair of similarity s."""
    return 1 - F.pow(1 - F.pow(s, F.lit(rows)), F.lit(bands))


def banding_threshold(bands: int, rows: int) -> float:
    """The similarity about which banding turns from missing pairs to proposing them."""
    return (1 / bands) ** (1 / rows)
