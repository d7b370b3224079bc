"""Joins whose left side may hold very many rows of one key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(rows: DataFrame, lookup: DataFrame, keys, identity, how="inner", salts=SALTS) -> DataFrame:
    """Join ``rows`` to a narrow ``lookup`` with unique keys, spreading each key over ``salts`` tasks.

    The salt follows from the ``identity`` columns, so a task run again after a lost executor sends every row
    to the same place. Lookup rows are repeated once per salt.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*identity), F.lit(salts)).cast("int"))
    spread = lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread, [*keys, "salt"], how).drop("salt")


def meet(rows, other, keys, by, columns, block=1024):
    """Every row of ``rows`` with every row of ``other`` under the same keys, ``columns`` as ``<name>_a`` and ``<name>_b``.

    Both sides carry ``key_rows``, a bound of the rows of their key. A key is cut into blocks of about ``block`` rows by
    a hash of ``by``, and each pair of blocks is joined by itself: a hot key is spread over many tasks, a small one
    is one block, and each pair meets exactly once.
    """
    blocks = F.ceil(F.col("key_rows") / block)
    own, each = F.pmod(F.xxhash64(*by), blocks), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    a = rows.select(*keys, *[F.col(c).alias(f"{c}_a") for c in columns], own.alias("block_a"), each.alias("block_b"))
    b = other.select(*keys, *[F.col(c).alias(f"{c}_b") for c in columns], each.alias("block_a"), own.alias("block_b"))
    return a.join(b, [*keys, "block_a", "block_b"]).drop("block_a", "block_b")
