"""Tables between steps, and the test tables."""

import uuid

from pyspark.sql import DataFrame

from tallyleaf.session import shared_folder


def new_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into a new folder below the shared one, and read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
