"""Monthly reconciliation against the ledger, and the audits that explain differences."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.operators.slices import money


def bill_totals(fact: DataFrame) -> DataFrame:
    """Revenue and lines per bill."""
    return fact.groupBy("bill_no", "year_month").agg(
        F.sum("line_revenue").alias("bill_revenue"), F.count("*").alias("line_count")
    )


def monthly_totals(fact: DataFrame) -> DataFrame:
    """Per month: revenue, revenue with each bill rounded to the unit, bills, lines."""
    return bill_totals(fact).groupBy("year_month").agg(
        F.round(F.sum("bill_revenue"), 2).cast("decimal(18,2)").alias("revenue"),
        F.sum(F.round("bill_revenue", 0)).cast("decimal(18,2)").alias("rounded_revenue"),
        F.count("*").alias("total_bills"),
        F.sum("line_count").alias("total_lines"),
    )


def bill_rounding(fact: DataFrame) -> DataFrame:
    """How far bill-level rounding moves each month's revenue."""
    return monthly_totals(fact).select(
        "year_month",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("rounded_revenue").cast("double").alias("rounded_revenue"),
        (F.col("revenue") - F.col("rounded_revenue")).cast("double").alias("rounding_difference"),
        "total_bills",
    )


def reconcile(monthly: DataFrame, ledger: DataFrame, causes: DataFrame) -> DataFrame:
    """Own monthly revenue against the signed-off figures.

    A month only one side has is reported as missing instead of failing the run. ``causes`` maps a month to
    the reason agreed for its difference.
    """
    own = monthly.select(F.col("year_month").alias("month"), "revenue")
    both = own.join(ledger.select("month", "closed_on", "revenue_inr"), "month", "full_outer")
    difference = F.col("revenue") - F.col("revenue_inr")
    status = (
        F.when(F.col("revenue").isNull(), "MISSING_PIPELINE")
        .when(F.col("revenue_inr").isNull(), "MISSING_LEDGER")
        .when(difference == 0, "MATCH")
        .otherwise("DIFF")
    )
    named = both.join(causes, "month", "left")
    cause = F.when(status == "MATCH", "Exact match").when(
        status == "DIFF", F.coalesce(F.col("cause"), F.lit("Unclassified"))
    )
    return named.select(
        "month",
        F.col("revenue").cast("double").alias("pipeline_revenue"),
        F.col("revenue_inr").cast("double").alias("ledger_revenue"),
        difference.cast("double").alias("difference"),
        status.alias("status"),
        F.col("closed_on").cast("string").alias("closed_on"),
        F.coalesce(cause, status).alias("root_cause"),
    )


def missing_store_days(observed: DataFrame) -> DataFrame:
    """Days between a store's first and last export on which it sent nothing.

    ``observed`` holds (store_id, business_date), repeated as often as it likes.
    """
    days = observed.select("store_id", "business_date").distinct()
    span = days.groupBy("store_id").agg(F.min("business_date").alias("first"), F.max("business_date").alias("last"))
    calendar = span.select("store_id", F.explode(F.sequence("first", "last")).alias("business_date"))
    return calendar.join(days, ["store_id", "business_date"], "left_anti")


def bill_integrity(sales: DataFrame) -> DataFrame:
    """Per month: bills whose TENDER equals items plus discount plus TAX, and cancelled bills that net to zero."""

    def total(*types):
        amount = F.col("qty") * F.col("unit_price")
        return F.coalesce(F.sum(F.when(F.col("line_type").isin(*types), amount)), F.lit(0))

    bills = sales.groupBy("bill_no", "year_month").agg(
        total("SALE", "RETURN", "VOID").alias("items"),
        total("DISCOUNT").alias("discount"),
        total("TAX").alias("tax"),
        total("TENDER").alias("tender"),
        F.count_if(F.col("line_type") == "VOID").alias("voids"),
    )
    balanced = F.col("tender") == F.col("items") + F.col("discount") + F.col("tax")
    return bills.groupBy("year_month").agg(
        F.count("*").alias("bills"),
        F.count_if(balanced).alias("balanced_bills"),
        F.count_if(F.col("voids") > 0).alias("void_bills"),
        F.count_if((F.col("voids") > 0) & (F.col("items") + F.col("discount") == 0)).alias("void_bills_at_zero"),
        money(F.sum("tender")).alias("tender_total"),
    )
