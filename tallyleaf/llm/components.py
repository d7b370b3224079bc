"""Connected components by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.operators.skew import salted_join
from tallyleaf.session import cut_lineage


def _state(edges):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large_star(edges):
    """Every larger neighbour of a node is hung below the least node that node sees."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
    return salted_join(edges, least, ["v"], ["u"]).select("u", F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges):
    """Every smaller neighbour of a node, and the node, are hung below the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    met = salted_join(edges, least, ["u"], ["v"]).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; the root is the least node of its component.

    Links from a node to itself are ignored. Only links travel, pre-aggregated by node; those of a hub are spread over many
    tasks. Each round is cut off by a checkpoint. The rounds end when one changes nothing, so their number follows the
    logarithm of the diameter.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut_lineage(edges)
    before, now = None, _state(edges)
    while now != before:
        edges = cut_lineage(_small_star(_large_star(edges)))
        before, now = now, _state(edges)
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
