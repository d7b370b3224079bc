"""Billing semantics on hand-written rows."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyleaf import schemas
from tallyleaf.operators import dims, ingest, reconcile, slices
from tallyleaf.plans import billing
from tallyleaf.sources import exports, layout, tables
from tallyleaf.sources import notices as notice_files
from tallyleaf.streaming import nightly
from tallyleaf.streaming.nightly import ingest_stream

COMMA = "bill_no,line_no,product_code,qty,unit_price,line_type,ts\n"


@pytest.fixture
def sales_folder(tmp_path):
    def put(name, text, bom=False):
        (tmp_path / name).write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())

    day = "S05/20240104/00001"
    put("SALES_S05_20240104.csv", COMMA + f"{day},1, P1 ,2,10.50,SALE,2024-01-05T00:40:00\n{day},2,TENDER,1,21.00,TENDER,x\n")
    put("SALES_S05_20240104__R1.csv", COMMA + f"{day},1,P1,3,10.50,SALE,2024-01-05T00:40:00\n")
    put(
        "SALES_S07_20240110.csv",
        "bill_no;line_no;item_code;quantity;rate;type;txn_time\n"
        "S07/20240110/00001;1;P2;-1;4.25;RETURN;10-01-2024 12:12:17\n"
        "S07/20240110/00001;2;P2;1;4.25;SALE;not a time\n",
    )
    put(
        "SALES_S11_20240104.csv",
        "ts,bill_no,line_no,line_type,product_code,unit_price,qty\n1704369600,S11/20240104/00001,1,SALE,P3,7.00,1\n"
        "soon,S11/20240104/00001,2,SALE,P3,7.00,1\n",
        bom=True,
    )
    put("SALES_X99_20240104.csv", COMMA + "X99/20240104/00001,1,P1,1,1.00,SALE,2024-01-04T10:00:00\n")
    return str(tmp_path)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dialects(spark, sales_folder):
    lines = exports.read_exports(spark, sales_folder, formats=("csv",))
    got = {(r.bill_no, r.line_no, r.file_name[:9]): r for r in lines.collect()}
    assert len(got) == 7 and lines.count() == 8
    semicolon = got[("S07/20240110/00001", 1, "SALES_S07")]
    assert (semicolon.product_code, semicolon.qty, semicolon.unit_price) == ("P2", Decimal("-1"), Decimal("4.25"))
    assert semicolon.ts == "2024-01-10T12:12:17"
    assert got[("S07/20240110/00001", 2, "SALES_S07")].ts == "not a time"
    assert got[("S11/20240104/00001", 1, "SALES_S11")].ts == "2024-01-04T12:00:00"
    assert got[("S11/20240104/00001", 2, "SALES_S11")].ts == "soon"
    assert got[("X99/20240104/00001", 1, "SALES_X99")].line_type == "SALE"
    assert got[("S05/20240104/00001", 1, "SALES_S05")].product_code == "P1"


def test_parquet_days_join_the_union(spark, sales_folder):
    day = spark.sql(
        "select 'S02/20240104/9' bill_no, 1 line_no, 'P9' product_code, 1 qty, 2.5 unit_price, 'SALE' line_type, 't' ts"
    )
    day.coalesce(1).write.parquet(sales_folder + "/SALES_S02_20240104.parquet")
    lines = exports.read_exports(spark, sales_folder)
    assert lines.count() == 9


def test_last_file_wins_and_partial_resend_keeps_other_lines(spark, sales_folder):
    lines = exports.read_exports(spark, sales_folder, formats=("csv",))
    kept = ingest.latest_lines(lines).where("bill_no like 'S05%'")
    assert rows(kept.select("line_no", "qty"), "line_no") == [(1, Decimal("3.00")), (2, Decimal("1.00"))]
    metrics = ingest.ingest_metrics(lines).first()
    assert tuple(metrics) == (8, 7, 1)


def test_business_date_is_the_bills_and_tender_is_no_revenue(spark, sales_folder):
    lines = exports.read_exports(spark, sales_folder, formats=("csv",))
    sales = ingest.all_sales(ingest.latest_lines(lines))
    first = sales.where("bill_no like 'S05%' and line_no = 1").first()
    assert str(first.business_date) == "2024-01-04" and first.day_of_week == "Thursday"
    assert first.line_revenue == Decimal("31.5000")
    assert sales.where("line_type = 'TENDER'").first().line_revenue == 0
    assert ingest.fact_sales(ingest.latest_lines(lines)).where("line_type = 'TENDER'").count() == 0


def test_survivor_does_not_depend_on_input_order(spark):
    lines = spark.range(200).selectExpr("'b' bill_no", "cast(id % 3 as int) line_no", "id % 7 qty", "'f' file_name")
    one = rows(ingest.latest_lines(lines.repartition(7)), "line_no")
    assert one == rows(ingest.latest_lines(lines.orderBy(F.desc("qty"))), "line_no") and len(one) == 3


def test_copies_are_dropped_before_the_shuffle(spark):
    lines = spark.range(10).selectExpr("cast(id as string) bill_no", "id % 3 line_no", "id * 2 qty", "'f' file_name")
    plan = ingest.latest_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_checksum_sees_duplicates(spark):
    once = spark.range(5).selectExpr("id a")
    thrice = once.union(once).union(once)
    a, b = ingest.checksum(once, ["a"]).first(), ingest.checksum(thrice, ["a"]).first()
    assert a.digest_xor == b.digest_xor and a.digest_sum != b.digest_sum


@pytest.fixture
def catalogue(spark):
    products = spark.sql(
        "select * from values (1L, 'P1', 'old', 'C1', date'2019-04-01', date'2024-05-31', false),"
        " (2L, 'P1', 'new', 'C2', date'2024-06-01', date'9999-12-31', true),"
        " (3L, 'P2', 'other', 'C1', date'2019-04-01', date'9999-12-31', true)"
        " as t(product_sk, product_code, product_name, category_id, valid_from, valid_to, is_current)"
    )
    sales = spark.sql(
        "select * from values ('P1', date'2024-05-31'), ('P1', date'2024-06-01'), ('P2', date'2024-06-01'),"
        " ('P1', date'2018-01-01') as t(product_code, business_date)"
    )
    return products, sales


def test_dated_join_takes_both_ends(spark, catalogue):
    products, sales = catalogue
    joined = dims.join_products(sales, products).select("business_date", "product_name")
    assert [n for _, n in rows(joined, "business_date", "product_name")] == ["old", "new", "other"]
    assert tuple(dims.code_join_fanout(sales, products).first()) == (7, 3, 4)
    assert dims.reissued_codes(products).count() == 2


def test_reconcile_statuses(spark):
    monthly = spark.sql("select * from values ('m1', 5.00BD), ('m2', 6.00BD), ('m3', 7.00BD) t(year_month, revenue)")
    ledger = spark.sql(
        "select * from values ('m1', date'2024-02-01', 5.00BD), ('m2', date'2024-02-01', 6.50BD),"
        " ('m4', date'2024-02-01', 1.00BD) t(month, closed_on, revenue_inr)"
    )
    causes = spark.sql("select 'm9' month, 'why' cause")
    got = {r.month: (r.status, r.root_cause, r.difference) for r in reconcile.reconcile(monthly, ledger, causes).collect()}
    assert got == {
        "m1": ("MATCH", "Exact match", 0.0),
        "m2": ("DIFF", "Unclassified", -0.5),
        "m3": ("MISSING_LEDGER", "MISSING_LEDGER", None),
        "m4": ("MISSING_PIPELINE", "MISSING_PIPELINE", None),
    }


def test_missing_store_days(spark):
    seen = spark.sql(
        "select * from values ('S1', date'2024-07-08'), ('S1', date'2024-07-12'), ('S1', date'2024-07-10') t(store_id, business_date)"
    )
    assert [str(d) for _, d in rows(reconcile.missing_store_days(seen), "business_date")] == ["2024-07-09", "2024-07-11"]


def test_partitioned_write_prunes_and_repeats(spark, sales_folder, tmp_path):
    fact = ingest.fact_sales(ingest.latest_lines(exports.read_exports(spark, sales_folder, formats=("csv",))))
    path = str(tmp_path / "fact")
    for _ in range(2):
        layout.write_partitioned(fact, path, dynamic=True)
    back = layout.read_sales(spark, path)
    assert back.count() == fact.count() == 6
    pruned = back.where("store_id = 'S05' and year_month = '2024-01'")
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString()
    metrics = layout.layout_metrics(back, back, "S05", "2024-01").first()
    assert metrics.pruned_files == 1 and metrics.flat_files == 4 and metrics.byte_reduction > 1
    assert slices.store_month(back, "S05", "2024-01").first().revenue == 31.5


def test_stream_takes_a_later_resend(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    schema = "bill_no string, line_no int, product_code string, qty decimal(10,2), unit_price decimal(18,2), line_type string, file_name string"

    def send(name, *lines):
        spark.createDataFrame([(b, n, "P", Decimal(q), Decimal(2), "SALE", name) for b, n, q in lines], schema).coalesce(
            1
        ).write.mode("append").parquet(str(source))
        ingest_stream(spark.readStream.schema(schema).parquet(str(source)), target, str(tmp_path / "progress"))
        return rows(layout.read_published(spark, target).select("bill_no", "line_no", "qty"), "bill_no", "line_no")

    first = send("a.csv", ("S01/20240101/1", 1, 5), ("S02/20240101/1", 1, 1), ("S01/20240201/1", 1, 9))
    assert [r[2] for r in first] == [5, 9, 1]
    second = send("a__R1.csv", ("S01/20240101/1", 1, 6), ("S01/20240101/1", 2, 7))
    assert [r[2] for r in second] == [6, 7, 9, 1]
    assert [r[2] for r in send("a0.csv")] == [6, 7, 9, 1]


def test_lost_merge_leaves_the_table_and_is_repeated(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    schema = "bill_no string, line_no int, product_code string, qty decimal(10,2), unit_price decimal(18,2), line_type string, file_name string"

    def batch(name, *lines):
        return spark.createDataFrame([(b, n, "P", Decimal(q), Decimal(2), "SALE", name) for b, n, q in lines], schema)

    def stored():
        return rows(layout.read_published(spark, target).select("bill_no", "line_no", "qty"), "bill_no", "line_no")

    first = batch("a.csv", ("S01/20240101/1", 1, 5), ("S02/20240101/1", 1, 1))
    second = batch("b.csv", ("S01/20240101/1", 1, 6), ("S01/20240101/1", 2, 7))
    layout.create_versions(spark, target, ingest.all_sales(first).schema)
    nightly.merge_lines(first, target, 0)
    before = stored()

    def lost(*_):
        raise RuntimeError("lost before publishing")

    with monkeypatch.context() as patched:
        patched.setattr(layout, "publish", lost)
        with pytest.raises(RuntimeError):
            nightly.merge_lines(second, target, 1)
    assert stored() == before and [r[2] for r in before] == [5, 1]
    nightly.merge_lines(second, target, 1)
    assert [r[2] for r in stored()] == [6, 7, 1]
    nightly.merge_lines(first, target, 1)
    assert [r[2] for r in stored()] == [6, 7, 1]


def test_default_formats_need_not_both_exist(spark, sales_folder, tmp_path):
    assert exports.read_exports(spark, str(sales_folder)).count() == exports.read_exports(spark, str(sales_folder), ("csv",)).count()
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        exports.read_exports(spark, str(tmp_path / "none"))


def test_golden_counts(spark):
    """Counts measured by reading 150 real exports line by line; GOLDEN_SALES_DIR names their folder."""
    folder = os.environ.get("GOLDEN_SALES_DIR")
    if not folder:
        pytest.skip("GOLDEN_SALES_DIR is not set")
    raw = exports.read_exports(spark, folder).cache()
    lines = ingest.latest_lines(raw)
    by_type = {r.line_type: r["count"] for r in lines.groupBy("line_type").count().collect()}
    assert (raw.count(), lines.count(), lines.select("bill_no").distinct().count()) == (14414, 14121, 2145)
    assert by_type == {"SALE": 9316, "RETURN": 202, "DISCOUNT": 272, "VOID": 41, "TAX": 2145, "TENDER": 2145}


def test_dialect_streams_equal_the_batch(spark, sales_folder, tmp_path):
    """Files of three dialects and re-sends arrive in three batches."""
    inbox, target = tmp_path / "inbox", str(tmp_path / "table")
    inbox.mkdir()
    files = sorted(f for f in os.listdir(sales_folder) if f.startswith("SALES_"))
    days = [[f for f in files if "S05" in f and "__R" not in f], [f for f in files if "S07" in f or "X99" in f], [f for f in files if "__R" in f or "S11" in f]]
    for day in days:
        for name in day:
            (inbox / name).write_bytes(open(os.path.join(sales_folder, name), "rb").read())
        nightly.ingest_exports(spark, str(inbox), target, str(tmp_path / "progress"))
    expected = ingest.all_sales(ingest.latest_lines(exports.read_exports(spark, sales_folder, formats=("csv",))))
    stored = layout.read_published(spark, target).select(expected.columns)
    assert rows(stored, "bill_no", "line_no") == rows(expected, "bill_no", "line_no")
    assert {r.line_type for r in stored.collect()} == {"SALE", "TENDER", "RETURN"} and stored.count() == 7


def test_compaction_keeps_what_readers_hold(spark, tmp_path):
    target = str(tmp_path / "out")
    schema = "bill_no string, line_no int, product_code string, qty decimal(10,2), unit_price decimal(18,2), line_type string, file_name string"

    def merge(version, *lines):
        made = [(b, n, "P", Decimal(q), Decimal(2), t, f"f{version}") for b, n, q, t in lines]
        nightly.merge_lines(spark.createDataFrame(made, schema), target, version)

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(f"{target}/rows") for f in names if f.startswith("part-")}

    def stored():
        return rows(layout.read_published(spark, target).select("bill_no", "line_no", "qty", "line_type"), "bill_no", "line_no")

    layout.create_versions(spark, target, ingest.all_sales(spark.createDataFrame([], schema)).schema)
    assert nightly.compact(spark, target) == 0
    merge(0, ("S01/20240101/1", 1, 5, "SALE"), ("S02/20240101/1", 1, 1, "SALE"))
    merge(2, ("S01/20240101/1", 1, 6, "SALE"), ("S01/20240101/1", 102, 1, "TAX"), ("S03/20240201/1", 103, 4, "TENDER"))
    merge(4, ("S02/20240101/1", 1, 2, "SALE"))
    # A reader that began after the first batch still finds its files.
    early = layout.read_published(spark, target)
    before, held = stored(), files()
    assert nightly.compact(spark, target, oldest_reader=2) == 1
    assert stored() == before and rows(early.select("bill_no", "line_no", "qty", "line_type"), "bill_no", "line_no") == before
    assert len(held - files()) == 1
    # A lost run leaves files that nobody lists.
    layout.write_version(layout.read_published(spark, target).where("store_id = 'S03'"), target, 3)
    assert nightly.compact(spark, target, oldest_reader=5) == 5
    assert stored() == before and {f.split("version=")[1][0] for f in files()} == {"5"}
    merge(6, ("S02/20240101/1", 1, 3, "SALE"))
    merge(4, ("S02/20240101/1", 1, 9, "SALE"))
    assert [r[2] for r in stored()] == [6, 1, 3, 4]


SQL_TEXT = """-- it's a dump; don't count this quote
DROP TABLE IF EXISTS stores;
CREATE TABLE stores (store_id TEXT, note TEXT);
INSERT INTO stores (store_id,opened_on,store_name,floor_area_sqft) VALUES
  ('S01',DATE '2011-01-01','O''Neil, (Main) Road',8200), -- the first's comment
  ('S02',NULL,'two
lines; INSERT INTO stores VALUES (''S9'')
-- not a comment',-5),
  ('S03',DATE '2012-04-06','',NULL);
insert into other values ('S07', 1), ('S08', 2);
INSERT INTO public.stores VALUES ('S04','name','addr','city','st','re',1,DATE '2020-02-29'); INSERT_LOG x;
"""


@pytest.mark.parametrize("split", ["128m", "64b"])
def test_rows_of_insert_statements(spark, tmp_path, split):
    (tmp_path / "dump.sql").write_text(SQL_TEXT)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        found = exports.read_sql_inserts(spark, str(tmp_path / "dump.sql"), "stores", schemas.MASTERS["stores"])
        got = rows(found.selectExpr("store_id", "store_name", "floor_area_sqft", "cast(opened_on as string)", "city"), "store_id")
        other = exports.read_sql_inserts(spark, str(tmp_path / "dump.sql"), "other", "a string, b int")
        assert rows(other, "a") == [("S07", 1), ("S08", 2)]
        assert exports.read_sql_inserts(spark, str(tmp_path / "dump.sql"), "none", "a string").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [
        ("S01", "O'Neil, (Main) Road", 8200, "2011-01-01", None),
        ("S02", "two\nlines; INSERT INTO stores VALUES ('S9')\n-- not a comment", -5, None, None),
        ("S03", "", None, "2012-04-06", None),
        ("S04", "name", 1, "2020-02-29", "city"),
    ]


def test_golden_masters(spark, tmp_path):
    """Rows of the four masters as counted by hand; GOLDEN_MASTERS_SQL names the SQL text."""
    path = os.environ.get("GOLDEN_MASTERS_SQL")
    if not path:
        pytest.skip("GOLDEN_MASTERS_SQL is not set")
    exports.convert_masters(spark, path, str(tmp_path), fmt="sql")
    counts = {n: exports.read_master(spark, n, str(tmp_path)).count() for n in schemas.MASTERS}
    assert counts == {"stores": 12, "product_categories": 14, "products": 1224, "price_revisions": 4320}


def test_masters_and_ledger_from_csv(spark, tmp_path):
    for name, schema in schemas.MASTERS.items():
        columns = [c.split()[0] for c in schema.split(", ")]
        kinds = {"date": "2024-02-29", "boolean": "true", "int": "7", "bigint": "8", "decimal(4,3)": "0.125", "decimal(12,2)": "9.50"}
        cells = [kinds.get(c.split()[1], c.split()[0]) for c in schema.split(", ")]
        (tmp_path / f"{name}.csv").write_text(",".join(columns) + "\n" + ",".join(cells) + "\n")
    exports.convert_masters(spark, str(tmp_path), str(tmp_path / "masters"))
    price = exports.read_master(spark, "price_revisions", str(tmp_path / "masters")).first()
    assert (price.mrp, str(price.effective_to)) == (Decimal("9.50"), "2024-02-29")
    assert exports.read_master(spark, "products", str(tmp_path / "masters")).first().is_current is True
    (tmp_path / "ledger.csv").write_text("month,closed_on,revenue_inr,signed_off_by\n2024-01,2024-02-09,12.34,A\n")
    assert tuple(exports.read_ledger(spark, str(tmp_path / "ledger.csv")).first())[2] == Decimal("12.34")


def test_reports_as_one_file(spark, tmp_path):
    report = spark.createDataFrame([("a", 1), ("b", None)], "name string, n int").repartition(3)
    for fmt in ("csv", "json"):
        layout.write_report(report, str(tmp_path / fmt), fmt)
        assert len([f for f in os.listdir(tmp_path / fmt) if f.startswith("part-")]) == 1
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "csv")), "name") == [("a", "1"), ("b", None)]
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_notice_files(spark, tmp_path):
    head = "notice_id,portal_id,published_at,title,body,estimated_value,closing_date\n"
    (tmp_path / "a.csv").write_text(head + 'N1,P1,2025-01-01,"Road, ""A""","line 1\nline 2",500,2025-02-01\n')
    (tmp_path / "b.csv").write_text(head + "N2,P2,2025-01-02,Bridge,,,\n")
    found = rows(notice_files.read_notices(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]), "notice_id")
    assert [(r[0], r[3], r[4], r[5]) for r in found] == [("N1", 'Road, "A"', "line 1\nline 2", 500), ("N2", "Bridge", None, None)]
    (tmp_path / "pairs.csv").write_text("notice_id_a,notice_id_b,label\nN1,N2,different\n")
    assert rows(notice_files.read_labelled_pairs(spark, str(tmp_path / "pairs.csv")), "label") == [("N1", "N2", "different")]
    (tmp_path / "clusters.csv").write_text("notice_id,cluster_id,copy_index,is_corrigendum,archetype\nN1,C1,0,False,works\n")
    assert rows(notice_files.read_clusters(spark, str(tmp_path / "clusters.csv")), "notice_id") == [("N1", "C1", 0, False, "works")]


def test_prices_are_joined_on_tasks_of_bounded_rows(spark, folder, monkeypatch):
    """However narrow the lines are, a task of ``effective_prices`` gets a share of them that does not grow with the table."""
    given, priced = [], slices.effective_prices
    monkeypatch.setattr(tables, "LINE_TASK", 100)
    monkeypatch.setattr(slices, "effective_prices", lambda fact, *more: given.append(fact) or priced(fact, *more))
    billing.effective_prices(spark, folder)
    per_task = given[0].groupBy(F.spark_partition_id().alias("task")).count()
    assert given[0].count() == tables.fact(spark, folder).count()
    assert per_task.agg(F.max("count")).first()[0] <= 3 * tables.LINE_TASK
