"""Exact deduplication: sorted runs of digests, merged pairwise-tree fashion over partitions."""

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.session import cut_lineage

#: Runs that meet in one merge: with two, the rounds are those of a binomial tree.
FAN = 2
#: Digest ranges per task, so that tasks get about the same.
RANGES = 4
RUN = "cell long, digest binary, check long, size long, keep long, n long, run long"
NONE = -(2**63)


def _merge(batches):
    """Merges rows sorted by (cell, digest, check, size): one row per distinct value, with the largest id and the count.

    Only one row is held back from batch to batch. Rows whose digests agree but whose check or size does not are kept apart.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        digest = np.frombuffer(b"".join(cols["digest"].to_pylist()), dtype=">u8").reshape(-1, 4)
        cell, check, size, n, run = (np.asarray(cols[k]) for k in ("cell", "check", "size", "n", "run"))
        keep = np.asarray(cols["keep"].fill_null(NONE))
        if held is not None:
            digest, cell, check, size, keep, n, run = (
                np.concatenate([h, x]) for h, x in zip(held, (digest, cell, check, size, keep, n, run))
            )
        new = (cell[1:] != cell[:-1]) | (check[1:] != check[:-1]) | (size[1:] != size[:-1])
        new |= (digest[1:] != digest[:-1]).any(axis=1)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        merged = [x[starts] for x in (digest, cell, check, size)]
        merged += [np.maximum.reduceat(keep, starts), np.add.reduceat(n, starts), run[starts]]
        held = [x[-1:] for x in merged]
        if len(starts) > 1:
            yield _rows([x[:-1] for x in merged])
    if held is not None:
        yield _rows(held)


def _rows(columns):
    digest, cell, check, size, keep, n, run = columns
    raw = digest.astype(">u8").tobytes()
    digests = pa.array([raw[i : i + 32] for i in range(0, len(raw), 32)], pa.binary())
    arrays = [pa.array(cell), digests, pa.array(check), pa.array(size), pa.array(keep, mask=keep == NONE)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(n), pa.array(run)], [f.split()[0] for f in RUN.split(", ")])


def _sorted_merge(rows):
    return rows.sortWithinPartitions("cell", "digest", "check", "size").mapInArrow(_merge, RUN)


def merge_runs(digests: DataFrame, runs: int) -> DataFrame:
    """One row per distinct (digest, check, size) of ``digests(doc_id, digest, check, size)``, with keep and n.

    Each partition first sorts and merges its own rows into a run, so a value repeated a million times leaves a
    partition once. In round r the runs whose numbers agree after dropping r times log2(FAN) bits meet,
    digest range by digest range: the fewer groups of runs are left, the more ranges each is cut into, so the number
    of equally sized pieces of work stays the same and none of them ever holds everything. A task gets its pieces of runs one
    behind the other, each in order, and Spark's sort by several columns (a merge sort that begins with the runs it
    finds) merges them as they are, any number at a time; the rows of a value then stand together, and the largest id stays.
    """
    first = digests.select(
        F.lit(0).cast("long").alias("cell"),
        "digest",
        "check",
        "size",
        F.col("doc_id").alias("keep"),
        F.lit(1).cast("long").alias("n"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).cast("long").alias("run"),
    )
    merged, groups = _sorted_merge(first), runs
    while True:
        groups = ceil(groups / FAN)
        ranges = ceil(RANGES * runs / groups)
        prefix = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
        part = F.shiftright(prefix * ranges, 32)
        merged = merged.withColumn("run", F.floor(F.col("run") / FAN)).withColumn("cell", F.col("run") * ranges + part)
        merged = _sorted_merge(merged.repartition(runs, "cell"))
        if groups == 1:
            return merged.select("digest", "check", "size", "keep", "n")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs(doc_id, text)``.

    Rows with the same text form a group; its largest doc_id stays. A null text counts as empty. A null doc_id is never
    preferred to another. Rows that repeat both doc_id and text share one decision, and each counts in
    ``group_size``. Equality is that of the SHA-256 digest, verified by length and a second hash in every merge.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digests = docs.select(
        F.col("doc_id").cast("long"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.xxhash64(text).alias("check"),
        F.octet_length(text).cast("long").alias("size"),
    )
    digests = cut_lineage(digests)
    runs = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = merge_runs(digests, runs)
    return digests.join(groups, ["digest", "check", "size"]).select(
        "doc_id",
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.expr("doc_id <=> keep").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
