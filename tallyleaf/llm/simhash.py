"""SimHash fingerprints, and groups of documents whose fingerprints differ in few bits."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.llm.components import connected_components
from tallyleaf.operators.skew import salted_join
from tallyleaf.session import cut_lineage

SHINGLE = 3
MAX_BITS = 3
#: Up to 3 differing bits touch up to 3 of the 8 bytes, so 5 bytes are the same at the same position.
MIN_BYTES = 8 - MAX_BITS
#: Four positions whose numbers cancel under XOR: 14 sets of four, one of which lies within any five positions.
POSITION_SETS = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
#: Fingerprints of one posting list that are compared in one piece.
CELL = 2048
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text):
    """The 64-bit fingerprint of one text as an unsigned integer; 0 without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        pieces = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts, ends = (ends - sizes)[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist()
        pieces = [xxhash.xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, ends)]
    hashes = np.array(pieces, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 32768):
        part = hashes[at : at + 32768].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])


def spanning_links(members):
    """Links that connect the fingerprints (uint64) exactly as all pairs within MAX_BITS would.

    A search from one fingerprint removes all that it reaches, so a dense group costs one pass per member that
    still finds something new, and no more links than members are made.
    """
    left, links = np.unique(members), []
    while len(left) > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            one = waiting.pop()
            apart = left ^ one
            shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = shared >= MIN_BYTES
            near[near] = np.bitwise_count(apart[near]) <= MAX_BITS
            for other in left[near].tolist():
                links.append((int(one), other))
                waiting.append(np.uint64(other))
            left = left[~near]
    return links


def _cell_links(batches):
    for batch in batches:
        lists = batch.column(0)
        sizes = np.asarray(lists.value_lengths())
        flat, starts = np.asarray(lists.flatten()).view(np.uint64), np.cumsum(sizes) - sizes
        a, b = flat[starts[sizes == 2]], flat[starts[sizes == 2] + 1]
        shared = ((a ^ b).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = (shared >= MIN_BYTES) & (np.bitwise_count(a ^ b) <= MAX_BITS)
        found = [np.stack([a[near], b[near]], axis=1)]
        for at in np.flatnonzero(sizes > 2):
            links = spanning_links(flat[starts[at] : starts[at] + sizes[at]])
            found.append(np.array(links, dtype=np.uint64).reshape(-1, 2))
        both = np.concatenate(found).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed bigint."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprints, "doc_id long, fp long"
    )


def near_links(prints: DataFrame, cell=CELL) -> DataFrame:
    """Links (a, b) among distinct ``fp`` with the same components as all pairs within MAX_BITS have.

    The inverted index lists fingerprints by the bytes they hold at given positions. A list for one position
    and byte holds 1/256 of everything, so lists are kept for four positions at once; the 14 sets of positions
    are such that any pair with MIN_BYTES equal positional bytes meets in at least one list. Where two meet, their
    equal positional bytes are counted, and those that reach the guaranteed minimum are compared bit by bit. A
    list longer than ``cell`` is cut into blocks, and each pair of blocks is a piece of work of its own.
    """

    def byte(p):
        return F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))

    keys = []
    for number, positions in enumerate(POSITION_SETS):
        key = F.lit(number).cast("long")
        for p in positions:
            key = F.shiftleft(key, 8).bitwiseOR(byte(p))
        keys.append(key)
    postings = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = salted_join(postings, sizes, ["key"], ["fp"]).withColumn("blocks", F.ceil(F.col("n") / cell))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), "blocks"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    piece = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("piece")
    pieces = met.select(piece, "fp").groupBy("piece").agg(F.collect_list("fp").alias("members"))
    return pieces.select("members").mapInArrow(_cell_links, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs(doc_id, text)``.

    ``component_id`` is the least doc_id reachable over fingerprints that differ in at most MAX_BITS bits. A null text
    counts as empty; texts without words share fingerprint 0. Repeated rows each get their row. A null doc_id is
    grouped like any other but never names a component, unless the whole component has no other. Other columns are ignored.
    """
    prints = cut_lineage(fingerprints(docs))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    distinct = cut_lineage(distinct)
    roots = cut_lineage(connected_components(near_links(distinct)))
    rooted = roots.join(distinct, roots.node == distinct.fp)
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    linked = rooted.join(least, "root").select("fp", "component")
    alone = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return salted_join(prints, alone, ["fp"], ["doc_id"]).select("doc_id", hexed, "component_id")


def survivors(docs: DataFrame, key: str) -> DataFrame:
    """(``key``) of one row per group of near duplicates of ``docs(doc_id, text)``: the least doc_id, null last, then the least key.

    Groups are those of fingerprints, whatever ids their rows have: rows without an id, or with the same one, are
    told apart by ``key``, a string. Rows are reduced to one per fingerprint before anything is joined.
    """
    row = F.struct(F.isnull("doc_id").alias("missing"), F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("key"))
    prints = docs.select(row.alias("row"), F.col("text").cast("string")).mapInArrow(
        _fingerprints, "doc_id struct<missing:boolean,doc_id:bigint,key:string>, fp long"
    )
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = cut_lineage(connected_components(near_links(distinct)))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left")
    least = rooted.groupBy(F.coalesce("root", "fp").alias("group")).agg(F.min("first").alias("least"))
    return least.select(F.col("least.key").alias(key))
