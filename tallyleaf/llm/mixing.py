"""Mixing sources to target weights by pivotal dependent rounding of copy numbers."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyleaf.operators.skew import salted_join
from tallyleaf.session import cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 42
#: Pieces into which each source is dealt for the first round, and how many meet in each later one.
CELLS = 256
FAN = 16
WORD = r"[^\x20\x09-\x0D]+"
UNIT = "doc_id long, source string, size long, source_size long, target double, copies int, p double, cell long, h long"
MASK = 2**64 - 1


def _coin(a, b):
    """A number in [0, 1) that depends on the two hashes and the seed alone."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + SEED) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return ((x ^ (x >> 31)) >> 11) / 2**53


def pivot(sizes, chances, hashes, last=False):
    """Rounds fractional chances in order, moving word mass between two documents at a time.

    Returns the chances after rounding: 0.0 or 1.0 for all but at most one, which keeps what is left over (with
    ``last`` it is rounded to the nearer). The sum of size times chance does not change before that last step,
    and each chance keeps its expected value.
    """
    out, carried = list(chances), -1
    for j in range(len(out)):
        if not 0.0 < out[j] < 1.0:
            continue
        if carried < 0:
            carried = j
            continue
        i, si, sj = carried, sizes[carried], sizes[j]
        pi, pj = out[i], out[j]
        up, down = min((1 - pi) * si, pj * sj), min(pi * si, (1 - pj) * sj)
        if _coin(hashes[i], hashes[j]) * (up + down) < down:
            i_ends, j_ends = (1 - pi) * si <= up, pj * sj <= up
            out[i], out[j] = (1.0 if i_ends else pi + up / si), (0.0 if j_ends else pj - up / sj)
        else:
            i_ends, j_ends = pi * si <= down, (1 - pj) * sj <= down
            out[i], out[j] = (0.0 if i_ends else pi - down / si), (1.0 if j_ends else pj + down / sj)
        carried = -1 if i_ends and j_ends else (j if i_ends else i)
    if last and carried >= 0:
        out[carried] = float(out[carried] >= 0.5)
    return out


def _rounder(last):
    def rounds(batches):
        """Rows come sorted by source and cell. One fractional row per source and cell is left over."""
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            if held is not None:
                table = {name: [held[name], *values] for name, values in table.items()}
                held = None
            keys = list(zip(table["source"], table["cell"]))
            cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
            p = table["p"]
            for at, end in zip(cuts, cuts[1:]):
                p[at:end] = pivot(table["size"][at:end], p[at:end], table["h"][at:end])
            # What is left of the last group may meet rows of the next batch.
            at = next((i for i in range(cuts[-2], len(p)) if 0.0 < p[i] < 1.0), None)
            if at is not None:
                held = {name: values.pop(at) for name, values in table.items()}
            yield _settled(table, last)
        if held is not None:
            yield _settled({name: [value] for name, value in held.items()}, last)

    def _settled(table, last):
        p = np.array(table["p"], dtype=np.float64)
        if last:
            p = np.where(p >= 0.5, 1.0, 0.0)
        copies = np.array(table["copies"], dtype=np.int32) + (p >= 1.0)
        columns = dict(table, copies=copies.astype(np.int32), p=np.where(p >= 1.0, 0.0, p))
        kinds = dict(long=pa.int64(), string=pa.string(), double=pa.float64(), int=pa.int32())
        fields = [f.split() for f in UNIT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[k]) for n, k in fields], [n for n, _ in fields])

    return rounds


def _round(rows, last):
    # Large documents first: they need many small ones to be settled, and what is left over at the end is small.
    order = ["source", "cell", F.desc("size"), "h", "doc_id"]
    return rows.repartition("source", "cell").sortWithinPartitions(*order).mapInArrow(_rounder(last), UNIT)


def source_targets(totals: DataFrame) -> DataFrame:
    """Adds ``target`` to ``totals(source, source_size)``, one row per source.

    Sources by code point, null last, take the weights in turn and share SHARE of all words. A target stops at
    MOST times its source; what that frees goes to the others by weight until none is above. The end of that
    process is one level of words per weight, found here from running sums in the order in which sources fill up.
    """
    everything = Window.partitionBy(F.lit(1))
    ranked = totals.withColumn(
        "rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())).cast("long")
    )
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = ranked.withColumn("weight", F.get(weights, ((F.col("rank") - 1) % len(WEIGHTS)).cast("int")))
    ranked = ranked.withColumn("most", F.lit(float(MOST)) * F.col("source_size"))
    ranked = ranked.withColumn("fills", F.col("most") / F.col("weight"))
    before = everything.orderBy("fills", "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(SHARE) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = ranked.withColumn("level", left / open_weight)
    full = F.col("most") <= F.col("weight") * F.col("level")
    first_open = F.min(F.when(~full, F.struct("fills", "rank", "level"))).over(everything)
    target = F.when(full | first_open.isNull(), F.col("most")).otherwise(F.col("weight") * first_open["level"])
    return levelled.withColumn("first_open", first_open).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) for every row of ``docs(doc_id, text, source)``.

    ``size`` counts words (null text: 0), ``taken`` is size times copies, and copies are 0 to MOST. Every document
    of a source has the same expected number of copies. The fraction of it is rounded by pivotal sampling: within
    each of CELLS pieces of a source first, then what is left over from FAN pieces at a time, so that only one
    document per source misses the balance, by less than half its size. Documents are dealt and paired by hashes of doc_id, so
    reruns agree however the input is split. Null sources form one source. Repeated rows are rounded each for itself,
    next to each other. A document without words gets no copy.
    """
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    base = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words.alias("size"))
    base = cut_lineage(base.withColumn("key", F.concat_ws("", F.when(F.isnull("source"), "n").otherwise("s"), "source")))
    totals = base.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals).withColumn(
        "key", F.concat_ws("", F.when(F.isnull("source"), "n").otherwise("s"), "source")
    )
    rated = salted_join(base, targets.drop("source"), ["key"], ["doc_id"])
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    h = F.xxhash64("doc_id", F.lit(SEED))
    units = rated.withColumn("rate", rate).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.floor("rate").cast("int").alias("copies"),
        (F.col("rate") - F.floor("rate")).alias("p"),
        F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(CELLS)).cast("long").alias("cell"),
        h.alias("h"),
    )
    settled, cells, rows = [], CELLS, units
    while True:
        rows = cut_lineage(_round(rows, last=cells == 1))
        settled.append(rows.where("p = 0"))
        if cells == 1:
            break
        cells = -(-cells // FAN)
        rows = rows.where("p > 0").withColumn("cell", F.floor(F.col("cell") / FAN))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return out.select("doc_id", "size", "source_size", "target", taken, "copies")
