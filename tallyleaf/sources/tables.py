"""The billing and notice inputs, derived from a folder of order, part and document tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyleaf.functions import minhash
from tallyleaf.operators import lsh
from tallyleaf.operators.ingest import all_sales, fact_sales, latest_lines
from tallyleaf.operators.skew import salted_join
from tallyleaf.session import cut_lineage

LAST_DAY = "9999-12-31"
REISSUED_ON = "1998-06-01"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sent_lines(spark, folder) -> DataFrame:
    """Item lines as sent; an (order, line) sent again is a re-send."""
    return read(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        "l_extendedprice",
        "l_partkey",
        "l_quantity",
        "l_returnflag",
        "l_tax",
    )


def bills_of(orders) -> DataFrame:
    """One row per bill: its number, whether it was cancelled, its bill-level discount."""
    store = F.concat(F.lit("S"), F.lpad((F.col("o_orderkey") % 25).cast("string"), 2, "0"))
    day = F.replace(F.col("o_orderdate").cast("date").cast("string"), F.lit("-"), F.lit(""))
    cancelled = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    rebate = (F.col("o_totalprice").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")
    return orders.select(
        "o_orderkey",
        F.concat_ws("/", store, day, F.col("o_orderkey").cast("string")).alias("bill_no"),
        cancelled.alias("cancelled"),
        F.when((F.col("o_orderpriority") == "5-LOW") & ~cancelled, -rebate).alias("discount"),
        (F.col("o_orderpriority") == "2-HIGH").alias("cash"),
    )


def bills(spark, folder) -> DataFrame:
    return bills_of(read(spark, folder, "orders"))


def revenue_lines(spark, folder) -> DataFrame:
    """Deduplicated SALE, RETURN, VOID and DISCOUNT lines.

    Copies are removed before the join: only one row per key and task is shuffled then.
    """
    orders = bills(spark, folder)
    kept = latest_lines(sent_lines(spark, folder), keys=("l_orderkey", "l_linenumber"), order=("l_shipdate",))
    return item_lines(kept, orders).unionByName(discount_lines(orders))


def item_lines(sent, orders, *also) -> DataFrame:
    """SALE and RETURN lines of the sent rows, and the VOID mirror of each on a cancelled bill."""
    qty = F.col("l_quantity").cast("decimal(10,2)")
    returned = F.col("l_returnflag") == "R"
    signed = F.when(returned, -qty).otherwise(qty).cast("decimal(10,2)")

    def line(offset, line_type, amount):
        return F.struct(
            (F.col("l_linenumber") + offset).alias("line_no"), line_type.alias("line_type"), amount.alias("qty")
        )

    item = line(0, F.when(returned, "RETURN").otherwise("SALE"), signed)
    mirror = line(50, F.lit("VOID"), (-signed).cast("decimal(10,2)"))
    return (
        sent.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("line", F.explode(F.when(F.col("cancelled"), F.array(item, mirror)).otherwise(F.array(item))))
        .select(
            "bill_no",
            "line.line_no",
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_code"),
            "line.qty",
            F.col("l_extendedprice").cast("decimal(18,2)").alias("unit_price"),
            "line.line_type",
            F.col("l_tax").cast("decimal(4,2)").alias("tax_rate"),
            *also,
        )
    )


def discount_lines(orders, *also) -> DataFrame:
    return orders.where("discount is not null").select(
        "bill_no",
        F.lit(101).alias("line_no"),
        F.lit("DISC").alias("product_code"),
        F.lit(1).cast("decimal(10,2)").alias("qty"),
        F.col("discount").alias("unit_price"),
        F.lit("DISCOUNT").alias("line_type"),
        F.lit(0).cast("decimal(4,2)").alias("tax_rate"),
        *also,
    )


def all_lines(spark, folder) -> DataFrame:
    """The revenue lines plus each bill's TAX and TENDER rows. Bills paid in cash are paid in whole units."""
    lines = revenue_lines(spark, folder)
    amount = F.col("qty") * F.col("unit_price")
    summed = lines.groupBy("bill_no").agg(
        F.round(F.sum(amount * F.col("tax_rate")), 2).cast("decimal(18,2)").alias("tax"),
        F.sum(amount).cast("decimal(18,2)").alias("net"),
    )
    summed = summed.join(bills(spark, folder).select("bill_no", "cash"), "bill_no")
    closing = summed.select("bill_no", F.explode(F.array(_closing(102, "TAX", "tax"), _tender())).alias("line"))
    return lines.drop("tax_rate").unionByName(closing.select("bill_no", "line.*"))


def _closing(line_no, line_type, amount):
    price = amount if not isinstance(amount, str) else F.col(amount)
    return F.struct(
        F.lit(line_no).alias("line_no"),
        F.lit(line_type).alias("product_code"),
        F.lit(1).cast("decimal(10,2)").alias("qty"),
        price.cast("decimal(18,2)").alias("unit_price"),
        F.lit(line_type).alias("line_type"),
    )


def _tender():
    paid = (F.col("net") + F.col("tax")).cast("decimal(18,2)")
    return _closing(103, "TENDER", F.when(F.col("cash"), F.round(paid, 0).cast("decimal(18,2)")).otherwise(paid))


def fact(spark, folder) -> DataFrame:
    return fact_sales(revenue_lines(spark, folder).drop("tax_rate"))


#: Sent lines to a task of ``dealt_fact``.
LINE_TASK = 1 << 18


def dealt_fact(spark, folder) -> DataFrame:
    """``fact`` on tasks of about LINE_TASK sent lines each, and on as many as there are cores at least.

    For joins and groupings whose memory follows the rows of a task: by size, Spark gives a task the more rows the narrower they are.
    Lines are dealt by what they say, not by their product alone, which may be a hot one.
    """
    tasks = max(spark.sparkContext.defaultParallelism, -(-read(spark, folder, "lineitem").count() // LINE_TASK))
    return fact(spark, folder).repartition(tasks, "product_code", "business_date", "qty", "unit_price")


def sales(spark, folder) -> DataFrame:
    return all_sales(all_lines(spark, folder))


def stores(spark, folder) -> DataFrame:
    """A store per nation."""
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("S"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("store_id"),
        F.concat(F.lit("Store "), F.col("n_name")).alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
    )


def products(spark, folder) -> DataFrame:
    """Parts as effective-dated products; the codes of size 7 were reissued to another product."""
    first, second = F.lit("1990-01-01").cast("date"), F.lit(REISSUED_ON).cast("date")
    forever = F.lit(LAST_DAY).cast("date")
    retired = F.col("p_size") == 7

    def version(offset, name, category, start, end, current):
        return F.struct(
            (F.col("p_partkey") * 2 + offset).alias("product_sk"),
            name.alias("product_name"),
            category.alias("category_id"),
            start.alias("valid_from"),
            end.alias("valid_to"),
            F.lit(current).alias("is_current"),
        )

    name, kind = F.col("p_name"), F.col("p_type")
    other = F.when(kind == "PROMO", "LARGE").otherwise("PROMO")
    old = version(0, name, kind, first, F.date_sub(second, 1), False)
    new = version(1, F.concat(F.lit("reissued "), name), other, second, forever, True)
    only = version(0, name, kind, first, forever, True)
    versions = F.when(retired, F.array(old, new)).otherwise(F.array(only))
    return (
        read(spark, folder, "part")
        .select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_code"), F.explode(versions).alias("v"))
        .select("product_code", "v.*")
    )


def categories(spark, folder) -> DataFrame:
    kind = F.col("p_type")
    return read(spark, folder, "part").select("p_type").distinct().select(
        kind.alias("category_id"),
        F.concat(F.lit("Category "), kind).alias("category_name"),
        F.when(kind.isin("PROMO", "ECONOMY"), "Value").otherwise("Core").alias("department"),
    )


# The price windows and the factor on the retail price in each.
PRICE_WINDOWS = (
    ("1995-04-01", "1996-12-31", "1.00"),
    ("1997-01-01", "1998-12-31", "1.05"),
    ("1999-01-01", LAST_DAY, "1.12"),
)


def prices(spark, folder) -> DataFrame:
    """Three consecutive price revisions per product. Sales before the first window have no list price."""

    def window(no, start, end, factor):
        listed = F.col("p_retailprice").cast("decimal(12,2)") * F.lit(factor).cast("decimal(3,2)")
        selling = listed.cast("decimal(12,2)")
        return F.struct(
            F.lit(no).alias("no"),
            (selling * F.lit("1.10").cast("decimal(3,2)")).cast("decimal(12,2)").alias("mrp"),
            selling.alias("selling_price"),
            F.lit(start).cast("date").alias("effective_from"),
            F.lit(end).cast("date").alias("effective_to"),
        )

    windows = F.array(*[window(i, *w) for i, w in enumerate(PRICE_WINDOWS)])
    versions = F.when(F.col("p_size") == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    parts = read(spark, folder, "part").select("p_partkey", "p_retailprice", F.explode(versions).alias("version"), "p_size")
    priced = parts.select((F.col("p_partkey") * 2 + F.col("version")).alias("product_sk"), F.explode(windows).alias("w"))
    return priced.select(
        (F.col("product_sk") * 3 + F.col("w.no")).alias("revision_id"),
        "product_sk",
        "w.mrp",
        "w.selling_price",
        "w.effective_from",
        "w.effective_to",
    )


def printed_list(sold: DataFrame, revisions: DataFrame) -> DataFrame:
    """The revisions with the price each was first printed at as its list price; one that nothing was sold under has none.

    ``sold`` are item lines with their product_sk. The first line of a revision is that of the earliest bill.
    """
    lines = sold.where("line_type = 'SALE'").select(
        F.col("product_sk").alias("sold_sk"), F.struct("business_date", "bill_no", "line_no", "unit_price").alias("line")
    )
    on = (F.col("product_sk") == F.col("sold_sk")) & F.col("line.business_date").between(F.col("effective_from"), F.col("effective_to"))
    first = revisions.join(lines, on).groupBy("revision_id").agg(F.min("line")["unit_price"].alias("selling_price"))
    return revisions.drop("selling_price").join(first, "revision_id")


# The months in which the ledger was closed on another figure, and why.
BULK_MONTH, BULK_INVOICE = "1997-03", "486250.00"
ROUNDED_MONTH = "1998-12"
UNSIGNED_MONTH = "2001-07"
EARLY_MONTH = "1994-12"


def booked_months(spark, folder) -> DataFrame:
    """(month, revenue, rounded_revenue) as an accountant would book them, without the sales table.

    Cancelled orders are never booked, while the tills ring them up and void them; amounts are whole cents. Of the copies of a line
    the greatest counts, by the same order as in the exports.
    """
    order = ["l_shipdate", "l_extendedprice", "l_partkey", "l_quantity", "l_returnflag", "l_tax"]
    last = F.max(F.struct(*order))
    lines = read(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(last.alias("last"))
    cents = (F.col("last.l_extendedprice").cast("decimal(18,2)") * 100).cast("bigint")
    quantity = (F.col("last.l_quantity").cast("decimal(10,2)") * 100).cast("bigint")
    signed = F.when(F.col("last.l_returnflag") == "R", -1).otherwise(1) * cents * quantity
    sold = lines.groupBy("l_orderkey").agg(F.sum(signed).alias("sold"))
    kept = read(spark, folder, "orders").where("not (o_orderstatus = 'P' and o_orderpriority = '1-URGENT')")
    total = (F.col("o_totalprice").cast("decimal(18,2)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")
    rebate = F.when(F.col("o_orderpriority") == "5-LOW", (total * 10000).cast("bigint")).otherwise(0)
    # An order with nothing on it is no bill.
    booked = kept.join(sold, F.col("o_orderkey") == F.col("l_orderkey"), "left").where("sold is not null or o_orderpriority = '5-LOW'")
    amount = ((F.coalesce("sold", F.lit(0)) - rebate).cast("decimal(28,0)") / 10000).cast("decimal(24,4)")
    per_order = booked.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), amount.alias("amount"))
    return per_order.groupBy("month").agg(
        F.round(F.sum("amount"), 2).cast("decimal(18,2)").alias("revenue"),
        F.sum(F.round("amount", 0)).cast("decimal(18,2)").alias("rounded_revenue"),
    )


def ledger(spark, folder) -> DataFrame:
    """A signed-off ledger: two months closed on other figures, one not closed, one without sales."""
    month = F.col("month")
    signed = (
        F.when(month == BULK_MONTH, F.col("revenue") + F.lit(BULK_INVOICE).cast("decimal(18,2)"))
        .when(month == ROUNDED_MONTH, F.col("rounded_revenue"))
        .otherwise(F.col("revenue"))
    )
    closed = F.date_add(F.last_day(F.to_date(F.concat(month, F.lit("-01")))), 9)
    known = booked_months(spark, folder).where(month != UNSIGNED_MONTH)
    known = known.select("month", closed.alias("closed_on"), signed.cast("decimal(18,2)").alias("revenue_inr"))
    early = spark.sql(
        f"select '{EARLY_MONTH}' as month, date '1995-01-09' as closed_on, cast(0 as decimal(18,2)) as revenue_inr"
    )
    return known.unionByName(early)


def causes(spark) -> DataFrame:
    return spark.sql(
        "select * from values"
        f" ('{BULK_MONTH}', 'Scope: invoice outside the tills'), ('{ROUNDED_MONTH}', 'Rounding: bill-level rounding')"
        " as t(month, cause)"
    )


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` on as many tasks as there are cores, where their files give fewer: what is done with a text costs far more than
    moving it once. Tables of many files are left as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, key)


def spread_texts(rows: DataFrame, key: str, task_bytes: int) -> DataFrame:
    """``rows`` on tasks of about ``task_bytes`` of text each, and on as many as there are cores at least: what a task holds does not
    grow with the table."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes)), key)


def notices(spark, folder, task_bytes=None) -> DataFrame:
    """Documents as notices: the portal is the source, the value to match on is the language."""
    documents = read(spark, folder, "documents").select("doc_id", "source", "text", "lang")
    dealt = spread(documents, "doc_id") if task_bytes is None else spread_texts(documents, "doc_id", task_bytes)
    return dealt.select(
        F.col("doc_id").alias("notice_id"),
        F.col("source").alias("portal_id"),
        F.lit("").alias("title"),
        F.col("text").alias("body"),
        F.col("lang").alias("estimated_value"),
    )


def pages(spark, folder) -> DataFrame:
    """Web pages as notices: the portal is the top-level domain, the title the address."""
    return read(spark, folder, "pages").select(
        F.col("page_id").alias("notice_id"),
        F.regexp_extract("url", r"^https?://[^/]*\.([a-z]+)", 1).alias("portal_id"),
        F.col("url").alias("title"),
        F.col("html").alias("body"),
    )


def incoming(spark, folder) -> DataFrame:
    """Benchmark items as a batch of notices still to be looked up."""
    return read(spark, folder, "benchmark").select(
        F.col("item_id").alias("notice_id"), F.lit("").alias("title"), F.col("text").alias("body")
    )


def clusters(spark, folder) -> DataFrame:
    """Truth clusters: documents of equal text, named after the lowest id. ``copy_index`` orders the members."""
    keyed = read(spark, folder, "documents").select(
        F.col("doc_id").alias("notice_id"), F.md5("text").alias("text_key"), F.col("lang").alias("archetype")
    )
    repeated = keyed.groupBy("text_key").agg(F.min("notice_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = salted_join(keyed, repeated.drop("n"), ["text_key"], ["notice_id"], "left")
    cluster = F.coalesce("first", "notice_id")
    return joined.select(
        "notice_id", cluster.alias("cluster_id"), (F.col("notice_id") - cluster).alias("copy_index"), "archetype"
    )


def labelled_pairs(spark, folder) -> DataFrame:
    """Pairs with a label, in number proportional to the documents.

    Every document is paired with the first one that has the same lowest shingle hash, and with the first one
    of its portal and language. The label is "same" when the lowest shingle agrees and the lengths are within
    a tenth: a rule of its own, not the similarity under test.
    """
    cleaned = lsh.clean(notices(spark, folder), "naive")
    lowest = F.array_min(minhash.ngram_hashes(F.col("clean"), 3))
    # Read four times below: written once as a narrow table instead of hashing every text four times.
    docs = cut_lineage(
        cleaned.select(
            "notice_id",
            "portal_id",
            "estimated_value",
            F.length("clean").alias("size"),
            F.coalesce(lowest, F.lit(-1)).alias("lowest"),
        )
    )
    pairs = _with_first(docs, ["lowest"]).union(_with_first(docs, ["portal_id", "estimated_value"])).distinct()
    shorter, longer = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    same = (F.col("lowest_a") == F.col("lowest_b")) & (10 * shorter >= 9 * longer)
    return pairs.select("id_a", "id_b", F.when(same, "same").otherwise("different").alias("label"))


def _with_first(docs, keys):
    features = F.struct("notice_id", "size", "lowest")
    first = docs.groupBy(*keys).agg(F.min(features).alias("first"))
    paired = salted_join(docs, first, keys, ["notice_id"]).where("notice_id > first.notice_id")
    return paired.select(
        F.col("first.notice_id").alias("id_a"),
        F.col("notice_id").alias("id_b"),
        F.col("first.size").alias("size_a"),
        F.col("size").alias("size_b"),
        F.col("first.lowest").alias("lowest_a"),
        F.col("lowest").alias("lowest_b"),
    )


#: The second week brings every notice whose id leaves this rest. At this threshold some of them link cards of the first week.
WEEK_OF, SECOND_WEEK = 6, 1
WEEKLY_THRESHOLD = 0.7


def weekly_notices(spark, folder):
    """(first week, second week): all documents, dealt to two weeks by their ids."""
    every, rest = notices(spark, folder), F.col("notice_id") % WEEK_OF
    return every.where(rest != SECOND_WEEK), every.where(rest == SECOND_WEEK)


def earlier_notices(spark, folder) -> DataFrame:
    """The documents that carry a quality label: what an earlier run had seen."""
    seen = read(spark, folder, "labels").select(F.col("doc_id").alias("notice_id"))
    return notices(spark, folder).join(seen, "notice_id", "left_semi")
