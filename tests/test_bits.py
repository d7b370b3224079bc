"""Pairs met by the bits of their sets before the sets are sent."""

import itertools
import random

import numpy as np
import pytest

from tallyleaf.functions import pairs
from tallyleaf.operators import verify

SCHEMA = "notice_id long, estimated_value string, sets array<long>, n int, bits binary"
SHARED = "estimated_value string, bucket_id long, notice_id long, key_rows long"


def _sets(rng, groups, copies):
    """Groups of sets that share some, most or all members, of very different sizes."""
    found = []
    for _ in range(groups):
        base = [rng.randrange(1 << 60) for _ in range(rng.choice([1, 2, 9, 40, 700]))]
        for _ in range(copies):
            kept = rng.sample(base, max(1, round(len(base) * rng.choice([0.5, 0.8, 1]))))
            found.append(list({*kept, *(rng.randrange(1 << 60) for _ in range(rng.choice([0, 1, len(base) // 3])))}))
    return found


def _score(a, b):
    return len({*a} & {*b}) / len({*a} | {*b})


@pytest.mark.parametrize("threshold", [0.45, 0.7])
def test_bits_leave_out_no_pair_that_reaches_the_threshold(threshold):
    sets = _sets(random.Random(2), 40, 4)
    bits = [pairs.set_bits(np.array(s)) for s in sets]
    starts = np.concatenate([[0], np.cumsum([len(b) // 8 for b in bits])])
    i, j = (np.array(x) for x in zip(*itertools.permutations(range(len(sets)), 2)))
    n, words = np.array([len(s) for s in sets]), np.frombuffer(b"".join(bits), np.uint64)
    kept = {(a, b) for a, b, k in zip(i, j, pairs.may_reach(n, words, starts, i, j, threshold)) if k}
    near = {(a, b) for a, b in zip(i, j) if _score(sets[a], sets[b]) >= threshold}
    assert near and near <= kept and len(kept) < len(i) / 20


@pytest.mark.parametrize("block, batch, components", [(1024, 10_000, False), (3, 5, False), (3, 5, True)])
def test_members_of_a_bucket_meet_in_blocks(spark, monkeypatch, block, batch, components):
    rng = random.Random(4)
    sets = _sets(rng, 12, 5)
    held = [{rng.randrange(6) for _ in range(3)} for _ in sets]
    values = ["a" if rng.random() < 0.8 else "b" for _ in sets]
    known = spark.createDataFrame([(i, v, s, len(s), bytearray(pairs.set_bits(np.array(s)))) for i, (v, s) in enumerate(zip(values, sets))], SCHEMA)
    sizes = {k: sum((v, b) == k for v, h in zip(values, held) for b in h) for k in itertools.product("ab", range(6))}
    shared = spark.createDataFrame([(v, b, i, sizes[v, b]) for i, (v, h) in enumerate(zip(values, held)) for b in h if sizes[v, b] > 1], SHARED)
    one = {i: i // 5 * 5 for i in range(len(sets)) if i % 5 < 3} if components else {}
    joined = spark.createDataFrame(list(one.items()), "notice_id long, component long") if components else None
    monkeypatch.setattr(verify, "BLOCK", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    found = [(r.id_a, r.id_b, r.jaccard) for r in verify.bucket_pairs(known, shared, components=joined).collect()]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {
        (i, j, _score(sets[i], sets[j])) for i, j in itertools.combinations(range(len(sets)), 2)
        if values[i] == values[j] and held[i] & held[j] and one.get(i, i) != one.get(j, j) and _score(sets[i], sets[j]) >= verify.THRESHOLD
    }
    assert len(found) == len({*found}) and expected
    if not components:
        assert {*found} == expected
    else:
        # Those of a bucket's biggest component do not meet, but stand for one another.
        assert {*found} <= expected and {one.get(x, x) for p in found for x in p[:2]} == {one.get(x, x) for p in expected for x in p[:2]}


def test_sets_are_sent_for_pairs_only(spark, monkeypatch):
    """All sets of a bucket's members were sent to it."""
    rng, sent = random.Random(5), []
    sets = [[rng.randrange(1 << 60) for _ in range(50)] for _ in range(30)]
    sets[7] = [*sets[3][:45], 1, 2]
    known = spark.createDataFrame([(i, "a", s, len(s), bytearray(pairs.set_bits(np.array(s)))) for i, s in enumerate(sets)], SCHEMA)
    shared = spark.createDataFrame([("a", b, i, 30) for i in range(30) for b in range(4)], SHARED)
    dealt = verify._dealt
    monkeypatch.setattr(verify, "_dealt", lambda rows, columns: sent.append((rows.count(), "sets" in columns)) or dealt(rows, columns))
    assert [(r.id_a, r.id_b) for r in verify.bucket_pairs(known, shared).collect()] == [(3, 7)]
    assert sent == [(120, False), (2, True)]
