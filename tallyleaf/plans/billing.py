"""The billing queries over a folder of tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyleaf.operators import dims, ingest, reconcile, slices
from tallyleaf.session import cut_lineage, shared_folder
from tallyleaf.sources import layout, tables

KPI_MONTH = "1998-10"
SWITCH_MONTHS = ("1998-05", "1998-06")
COMPARED_MONTHS = ("1997-03", "1999-12")
REPORT_REGION = "ASIA"


def revenue_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return slices.by_month(tables.fact(spark, folder))


def line_type_audit(spark, folder):
    return slices.by_line_type(tables.sales(spark, folder))


def double_count_audit(spark, folder):
    return slices.double_count_audit(tables.sales(spark, folder))


def ingest_metrics(spark, folder):
    return ingest.ingest_metrics(tables.sent_lines(spark, folder), keys=("l_orderkey", "l_linenumber"))


def fact_summary(spark, folder):
    return slices.fact_summary(tables.fact(spark, folder))


def bill_integrity(spark, folder):
    return reconcile.bill_integrity(tables.sales(spark, folder))


def store_month(spark, folder):
    return slices.store_month(tables.fact(spark, folder), "S01", KPI_MONTH)


def revenue_by_store(spark, folder):
    return slices.by_store(tables.fact(spark, folder), tables.stores(spark, folder))


def top_stores(spark, folder):
    return slices.top_by_revenue(revenue_by_store(spark, folder).drop("total_bills"), "store_id", 5)


def revenue_by_category(spark, folder):
    return slices.by_category(
        tables.fact(spark, folder), tables.products(spark, folder), tables.categories(spark, folder)
    )


def top_categories(spark, folder):
    return slices.top_by_revenue(revenue_by_category(spark, folder).drop("units_sold"), "category_id", 5)


def revenue_by_weekday(spark, folder):
    return slices.by_weekday(tables.fact(spark, folder))


def kpi(spark, folder):
    return slices.kpi(tables.fact(spark, folder), KPI_MONTH)


def reissued_codes(spark, folder):
    versions = dims.reissued_codes(tables.products(spark, folder))
    dates = {c: F.col(c).cast("string") for c in ("valid_from", "valid_to")}
    return versions.withColumns({**dates, "is_current": F.col("is_current").cast("int")})


def reissued_code_sales(spark, folder):
    return slices.reissued_code_sales(
        tables.fact(spark, folder), tables.products(spark, folder), tables.categories(spark, folder), SWITCH_MONTHS
    )


def code_join_fanout(spark, folder):
    return dims.code_join_fanout(tables.fact(spark, folder), tables.products(spark, folder))


def _prices(spark, folder, months=None):
    return slices.effective_prices(
        tables.dealt_fact(spark, folder),
        tables.products(spark, folder),
        tables.categories(spark, folder),
        tables.prices(spark, folder),
        months,
    )


def effective_prices(spark, folder):
    return _prices(spark, folder)


def price_comparison(spark, folder):
    return _prices(spark, folder, COMPARED_MONTHS).drop("product_sk", "category_name")


def price_mismatch(spark, folder):
    fact, products = tables.fact(spark, folder), tables.products(spark, folder)
    listed = tables.printed_list(dims.join_products(fact, products), tables.prices(spark, folder))
    return slices.price_mismatch(fact, products, listed)


def _store_categories(spark, folder, **only):
    return slices.store_category_report(
        tables.fact(spark, folder),
        tables.stores(spark, folder),
        tables.products(spark, folder),
        tables.categories(spark, folder),
        **only,
    )


def store_category_revenue(spark, folder):
    return _store_categories(spark, folder)


def top_store_categories(spark, folder):
    report = _store_categories(spark, folder, month=KPI_MONTH, region=REPORT_REGION)
    return report.orderBy(F.col("category_revenue").desc(), "store_name", "category_name").limit(10)


def bill_rounding(spark, folder):
    return reconcile.bill_rounding(tables.fact(spark, folder))


def monthly_reconciliation(spark, folder):
    monthly = reconcile.monthly_totals(tables.fact(spark, folder))
    return reconcile.reconcile(monthly, tables.ledger(spark, folder), tables.causes(spark))


def missing_store_days(spark, folder):
    observed = ingest.with_bill_parts(tables.bills(spark, folder).select("bill_no"))
    return reconcile.missing_store_days(observed).withColumn("business_date", F.col("business_date").cast("string"))


def new_folder(spark, name):
    """A path of its own under the shared folder, so that runs side by side do not meet."""
    return f"{shared_folder(spark)}/tallyleaf/{name}-{uuid.uuid4().hex}"


def partition_round_trip(spark, folder):
    """Revenue per store and month, read back from the partitioned table."""
    path = new_folder(spark, "sales")
    layout.write_partitioned(tables.fact(spark, folder), path)
    rows = layout.read_sales(spark, path)
    return rows.groupBy("store_id", "year_month").agg(slices.revenue().alias("revenue"), F.count("*").alias("line_count"))


def all_lines_round_trip(spark, folder):
    """Lines and amounts per store, month and line type, read back from the partitioned table of all lines."""
    path = new_folder(spark, "all-lines")
    layout.write_partitioned(tables.sales(spark, folder), path)
    rows = layout.read_sales(spark, path).groupBy("store_id", "year_month", "line_type")
    return rows.agg(F.count("*").alias("line_count"), F.round(F.sum(F.col("qty") * F.col("unit_price")), 2).cast("double").alias("subtotal"))


def layout_metrics(spark, folder):
    """Files and rows that one store-month query opens in the partitioned table, and among files by month without partitions."""
    path, flat = new_folder(spark, "sales"), new_folder(spark, "flat")
    layout.write_partitioned(tables.fact(spark, folder), path)
    rows = layout.read_sales(spark, path)
    layout.write_flat(rows, flat)
    found = layout.layout_metrics(layout.read_flat(spark, flat), rows, "S01", KPI_MONTH)
    return found.select("flat_files", "flat_rows", "pruned_files", "pruned_rows", "file_reduction")


def idempotent_runs(spark, folder):
    """Digest of the written table after each of two ingest runs into the same folder."""
    path = new_folder(spark, "sales")
    runs = []
    for run in (1, 2):
        layout.write_partitioned(tables.fact(spark, folder), path, dynamic=True)
        digest = ingest.checksum(layout.read_sales(spark, path), ingest.SALES_DIGEST)
        runs.append(cut_lineage(digest.select(F.lit(run).alias("run"), "*")))
    return runs[0].unionByName(runs[1])


QUERIES = {
    f.__name__: f
    for f in (
        revenue_by_month,
        line_type_audit,
        double_count_audit,
        ingest_metrics,
        fact_summary,
        bill_integrity,
        store_month,
        revenue_by_store,
        top_stores,
        revenue_by_category,
        top_categories,
        revenue_by_weekday,
        kpi,
        reissued_codes,
        reissued_code_sales,
        code_join_fanout,
        effective_prices,
        price_comparison,
        price_mismatch,
        store_category_revenue,
        top_store_categories,
        bill_rounding,
        monthly_reconciliation,
        missing_store_days,
        partition_round_trip,
        all_lines_round_trip,
        layout_metrics,
        idempotent_runs,
    )
}
