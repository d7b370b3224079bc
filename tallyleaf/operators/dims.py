"""Effective-dated joins to products, categories, prices and stores.

No side is broadcast by hint: the masters are small in a shop but ``products`` may not be, so Spark decides
by size and adaptive execution splits a product that sells far more than the others.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_products(sales: DataFrame, products: DataFrame, how="inner") -> DataFrame:
    """The product a code meant on the day of sale; both ends of the validity count."""
    p = products.withColumnRenamed("product_code", "master_code")
    on = (F.col("product_code") == F.col("master_code")) & F.col("business_date").between(
        F.col("valid_from"), F.col("valid_to")
    )
    return sales.join(p, on, how).drop("master_code")


def join_prices(sales: DataFrame, prices: DataFrame, how="inner") -> DataFrame:
    """The list price in force on the day of sale."""
    p = prices.withColumnRenamed("product_sk", "priced_sk")
    on = (F.col("product_sk") == F.col("priced_sk")) & F.col("business_date").between(
        F.col("effective_from"), F.col("effective_to")
    )
    return sales.join(p, on, how).drop("priced_sk")


def join_categories(sales: DataFrame, categories: DataFrame) -> DataFrame:
    return sales.join(categories, "category_id")


def join_stores(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return sales.join(stores, "store_id")


def reissued_codes(products: DataFrame) -> DataFrame:
    """All versions of the codes that more than one product has carried."""
    repeated = products.groupBy("product_code").count().where("count > 1")
    return products.join(repeated, "product_code", "left_semi")


def code_join_fanout(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Rows a join on the code alone gives, rows the dated join gives, and the surplus.

    One join on the code serves both counts.
    """
    master = products.select(F.col("product_code").alias("master_code"), "valid_from", "valid_to")
    by_code = sales.select("product_code", "business_date").join(master, F.col("product_code") == F.col("master_code"))
    counts = by_code.agg(
        F.count("*").alias("code_join_rows"),
        F.count_if(F.col("business_date").between(F.col("valid_from"), F.col("valid_to"))).alias("dated_join_rows"),
    )
    return counts.withColumn("surplus_rows", F.col("code_join_rows") - F.col("dated_join_rows"))
