"""Notices, adjudicated pairs and truth clusters from CSV."""

from pyspark.sql import DataFrame, SparkSession

from tallyleaf import schemas


def _quoted(spark, schema):
    # Bodies hold line breaks and doubled quotes, so records span lines.
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"')


def read_notices(spark: SparkSession, paths) -> DataFrame:
    return _quoted(spark, schemas.NOTICE).csv(paths)


def read_labelled_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LABELLED_PAIR).option("header", True).csv(path)


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CLUSTER).option("header", True).csv(path)
