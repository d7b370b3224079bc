"""What a cut of the lineage leaves on the driver."""

from pyspark.sql import functions as F

from tallyleaf.operators.cards import connected_components
from tallyleaf.session import cut_lineage


def _size(rows):
    return rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def test_the_estimated_size_does_not_grow_from_round_to_round(spark):
    rows = cut_lineage(spark.range(20).selectExpr("id", "id % 7 as other"))
    for _ in range(8):
        other = rows.select(F.col("id").alias("other"), F.col("other").alias("further"))
        rows = cut_lineage(rows.join(other, "other").select("id", F.col("further").alias("other")))
    assert _size(rows).bit_length() <= 64
    assert sorted(tuple(r) for r in rows.collect()) == [(i, i % 7) for i in range(20)]
    edges = spark.range(40).selectExpr("id as id_a", "id + 1 as id_b")
    found = connected_components(edges)
    assert _size(found).bit_length() <= 64
    assert {r.component for r in found.collect()} == {0} and found.count() == 41


def test_a_size_within_bounds_is_kept(spark):
    rows = spark.range(1000)
    assert _size(cut_lineage(rows)) == _size(rows)
