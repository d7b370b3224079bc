"""Revenue slices of the sales table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyleaf.functions.minhash import PRIME, hash60
from tallyleaf.operators import dims
from tallyleaf.operators.ingest import SALES_DIGEST, revenue_treatment


def money(total: Column, places=2) -> Column:
    """A decimal total, rounded as a decimal and then shown as a double."""
    return F.round(total, places).cast("double")


def revenue() -> Column:
    return money(F.sum("line_revenue"))


def units() -> Column:
    return money(F.sum("qty"), 0)


def by_line_type(sales: DataFrame) -> DataFrame:
    """Lines and subtotal of qty * unit_price per month and line type, with their treatment."""
    totals = sales.groupBy("year_month", "line_type").agg(
        F.count("*").alias("line_count"), money(F.sum(F.col("qty") * F.col("unit_price"))).alias("subtotal")
    )
    return totals.withColumn("revenue_treatment", revenue_treatment(F.col("line_type")))


def double_count_audit(sales: DataFrame) -> DataFrame:
    """Per month: the sum over every line, the true revenue, and how many times too high the first is."""
    totals = sales.groupBy("year_month").agg(
        F.sum(F.col("qty") * F.col("unit_price")).alias("naive"), F.sum("line_revenue").alias("revenue")
    )
    naive, true = money(F.col("naive")), money(F.col("revenue"))
    return totals.select(
        "year_month",
        naive.alias("naive_total"),
        true.alias("true_revenue"),
        F.when(true != 0, naive / true).alias("ratio"),
    )


def store_month(fact: DataFrame, store_id: str, year_month: str) -> DataFrame:
    """Lines and revenue of one store in one month; on the partitioned table both conditions prune folders."""
    chosen = fact.where((F.col("store_id") == store_id) & (F.col("year_month") == year_month))
    return chosen.agg(F.count("*").alias("line_count"), revenue().alias("revenue"))


def by_store(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue and bills per store. Sales are summed before the join, so no store is a hot join key."""
    totals = fact.groupBy("store_id").agg(
        F.sum("line_revenue").alias("revenue"), F.countDistinct("bill_no").alias("total_bills")
    )
    return dims.join_stores(totals, stores).select(
        "store_id", "store_name", "city", "region", money(F.col("revenue")).alias("total_revenue"), "total_bills"
    )


def by_category(fact: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Revenue and units per category; summed per category id before the names are joined."""
    totals = dims.join_products(fact, products).groupBy("category_id").agg(
        F.sum("line_revenue").alias("revenue"), F.sum("qty").alias("units")
    )
    return dims.join_categories(totals, categories).select(
        "category_id",
        "category_name",
        "department",
        money(F.col("revenue")).alias("total_revenue"),
        money(F.col("units"), 0).alias("units_sold"),
    )


def top_by_revenue(slice_: DataFrame, key: str, n: int) -> DataFrame:
    """The n largest, equal revenues in key order."""
    return slice_.orderBy(F.col("total_revenue").desc(), F.col(key)).limit(n)


def by_weekday(fact: DataFrame) -> DataFrame:
    """Total and average per trading day of each weekday, in calendar order through ``weekday_no``."""
    days = fact.groupBy("business_date", "day_of_week").agg(F.sum("line_revenue").alias("day_total"))
    return days.groupBy("day_of_week", (F.weekday("business_date") + 1).alias("weekday_no")).agg(
        money(F.sum("day_total")).alias("total_revenue"),
        (money(F.sum("day_total"), 4) / F.count("*")).alias("avg_daily_revenue"),
    )


def by_month(fact: DataFrame) -> DataFrame:
    """Revenue, bills and average basket per month."""
    totals = fact.groupBy("year_month").agg(
        revenue().alias("total_revenue"), F.countDistinct("bill_no").alias("total_bills")
    )
    return totals.withColumn("avg_basket", F.col("total_revenue") / F.col("total_bills"))


def kpi(fact: DataFrame, month: str) -> DataFrame:
    """Total revenue, revenue of one month, bills and stores. One row per bill first, then one distinct count."""
    bills = fact.groupBy("bill_no", "store_id").agg(
        F.sum("line_revenue").alias("revenue"),
        F.sum(F.when(F.col("year_month") == month, F.col("line_revenue")).otherwise(0)).alias("month_revenue"),
    )
    stores = bills.groupBy("store_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("month_revenue").alias("month_revenue"), F.count("*").alias("bills")
    )
    return stores.agg(
        money(F.sum("revenue")).alias("total_revenue"),
        money(F.sum("month_revenue")).alias("month_revenue"),
        F.sum("bills").alias("total_bills"),
        F.count("*").alias("total_stores"),
    )


def reissued_code_sales(fact, products, categories, months) -> DataFrame:
    """Sales of reissued codes in the given months, by the product each line resolves to."""
    reissued = dims.reissued_codes(products)
    sales = dims.join_products(fact.where(F.col("year_month").isin(*months)), reissued)
    totals = sales.groupBy("year_month", "product_sk", "product_code", "product_name", "category_id").agg(
        units().alias("total_qty"), revenue().alias("total_revenue")
    )
    return dims.join_categories(totals, categories).select(
        "year_month", "product_sk", "product_code", "product_name", "category_name", "total_qty", "total_revenue"
    )


def effective_prices(fact, products, categories, prices, months=None, product_code=None) -> DataFrame:
    """Per month and price revision: printed price, units, and revenue at list price.

    The same query for any month or product; leave both out for all of them.
    """
    if months is not None:
        fact = fact.where(F.col("year_month").isin(*months))
    if product_code is not None:
        fact = fact.where(F.col("product_code") == product_code)
    sales = dims.join_prices(dims.join_products(fact, products), prices)
    keys = ["year_month", "product_sk", "product_code", "product_name", "category_id", "revision_id"]
    keys += ["mrp", "selling_price", "effective_from", "effective_to"]
    totals = sales.groupBy(*keys).agg(
        F.sum("unit_price").alias("printed"),
        F.count("*").alias("line_count"),
        units().alias("total_units_sold"),
        money(F.sum(F.col("qty") * F.col("selling_price"))).alias("revenue_at_list_price"),
    )
    return dims.join_categories(totals, categories).select(
        "year_month",
        "product_sk",
        "product_code",
        "product_name",
        "category_name",
        "revision_id",
        F.col("mrp").cast("double").alias("mrp"),
        F.col("selling_price").cast("double").alias("effective_price"),
        F.col("effective_from").cast("string").alias("effective_from"),
        F.col("effective_to").cast("string").alias("effective_to"),
        (F.col("printed").cast("double") / F.col("line_count")).alias("avg_printed_price"),
        "total_units_sold",
        "revenue_at_list_price",
    )


def price_mismatch(fact, products, prices, tolerance="0.001") -> DataFrame:
    """How many item lines print another price than the list, and how many have no list price at all."""
    lines = dims.join_prices(dims.join_products(fact, products), prices, "left")
    differs = F.abs(F.col("unit_price") - F.col("selling_price")) > F.lit(tolerance).cast("decimal(4,3)")
    counts = lines.agg(
        F.count("*").alias("item_lines"),
        F.count("selling_price").alias("priced_lines"),
        F.count_if(differs).alias("mismatched_lines"),
    )
    return counts.withColumns(
        {
            "unpriced_lines": F.col("item_lines") - F.col("priced_lines"),
            "mismatch_rate": F.when(F.col("priced_lines") > 0, F.col("mismatched_lines") / F.col("priced_lines")),
        }
    )


def store_category_report(fact, stores, products, categories, month=None, region=None) -> DataFrame:
    """Revenue and units by region, city, store and category, with optional month and region."""
    if month is not None:
        fact = fact.where(F.col("year_month") == month)
    if region is not None:
        stores = stores.where(F.col("region") == region)
        fact = fact.join(stores, "store_id", "left_semi")
    totals = dims.join_products(fact, products).groupBy("store_id", "category_id").agg(
        F.sum("line_revenue").alias("revenue"), F.sum("qty").alias("units")
    )
    named = dims.join_categories(dims.join_stores(totals, stores), categories)
    return named.select(
        "region",
        "city",
        "store_name",
        "category_name",
        money(F.col("revenue")).alias("category_revenue"),
        money(F.col("units"), 0).alias("units_sold"),
    )


def fact_summary(fact: DataFrame) -> DataFrame:
    """Rows, revenue, distinct bills and order-free digest of the sales table, in one pass."""
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in SALES_DIGEST])
    hashed = fact.select("bill_no", "line_revenue", hash60(line).alias("h"))
    per_bill = hashed.groupBy("bill_no").agg(
        F.sum("line_revenue").alias("revenue"),
        F.count("*").alias("line_count"),
        F.bit_xor("h").alias("digest"),
        F.sum(F.col("h").cast("decimal(20,0)")).alias("digest_sum"),
    )
    return per_bill.agg(
        F.sum("line_count").alias("total_rows"),
        money(F.sum("revenue")).alias("total_revenue"),
        F.count("*").alias("distinct_bills"),
        F.bit_xor("digest").alias("digest_xor"),
        (F.sum("digest_sum") % PRIME).cast("bigint").alias("digest_sum"),
    )
