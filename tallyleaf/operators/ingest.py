"""From raw export lines to the deduplicated, partitioned sales table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyleaf.functions.minhash import PRIME, hash60

# The line types that count as revenue.
REVENUE_TYPES = ("SALE", "RETURN", "DISCOUNT", "VOID")


def latest_lines(lines: DataFrame, keys=("bill_no", "line_no"), order=("file_name",)) -> DataFrame:
    """One row per key: the copy from the last file, ties settled by the whole payload.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a key sent
    very often costs no more than others.
    """
    payload = sorted(set(lines.columns) - set(keys) - set(order))
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (*order, *payload)])
    return lines.withColumn("copy_rank", F.row_number().over(newest)).where("copy_rank = 1").drop("copy_rank")


def with_bill_parts(lines: DataFrame) -> DataFrame:
    """Store and business date out of ``bill_no`` (store/yyyymmdd/number). The timestamp never decides the date."""
    parts = F.split("bill_no", "/")
    day = F.to_date(parts[1], "yyyyMMdd")
    return lines.withColumns({"store_id": parts[0], "business_date": day}).withColumns(
        {
            "year_month": F.date_format("business_date", "yyyy-MM"),
            "day_of_week": F.date_format("business_date", "EEEE"),
        }
    )


def is_revenue(line_type: Column) -> Column:
    return line_type.isin(*REVENUE_TYPES)


def revenue_treatment(line_type: Column) -> Column:
    return F.when(is_revenue(line_type), "revenue").otherwise("not revenue")


def with_revenue(lines: DataFrame) -> DataFrame:
    """Line revenue in decimals: exact, so sums do not depend on the order of partitions."""
    amount = F.round(F.col("qty") * F.col("unit_price"), 4)
    return lines.withColumns(
        {
            "is_revenue": is_revenue(F.col("line_type")),
            "line_revenue": F.when(is_revenue(F.col("line_type")), amount).otherwise(F.lit(0).cast("decimal(29,4)")),
        }
    )


def all_sales(lines: DataFrame) -> DataFrame:
    """Every deduplicated line with its derived columns."""
    return with_revenue(with_bill_parts(lines))


def fact_sales(lines: DataFrame) -> DataFrame:
    """The revenue lines only."""
    return all_sales(lines.where(is_revenue(F.col("line_type"))))


def ingest_metrics(lines: DataFrame, keys=("bill_no", "line_no")) -> DataFrame:
    """Raw lines, unique lines and copies removed, from one count per key."""
    per_key = lines.groupBy(*keys).agg(F.count("*").alias("copies"))
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_lines"), F.count("*").alias("unique_lines")
    )
    return totals.withColumn("duplicates_removed", F.col("raw_lines") - F.col("unique_lines"))


def checksum(rows: DataFrame, columns) -> DataFrame:
    """Order-free digest of a table: rows, exclusive-or and modular sum of the row hashes.

    The exclusive-or alone would miss a row present twice; the sum does not.
    """
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    hashed = rows.select(hash60(line).alias("h"))
    return hashed.agg(
        F.count("*").alias("rows"),
        F.bit_xor("h").alias("digest_xor"),
        (F.sum(F.col("h").cast("decimal(28,0)")) % PRIME).cast("bigint").alias("digest_sum"),
    )


SALES_DIGEST = ("bill_no", "line_no", "product_code", "qty", "unit_price", "line_type")
