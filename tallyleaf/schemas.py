"""Declared schemas of every input."""

MONEY = "decimal(18,2)"
QTY = "decimal(10,2)"

COMMA_EXPORT = (
    "bill_no string, line_no string, product_code string, qty string, unit_price string, line_type string, ts string"
)
SEMICOLON_EXPORT = (
    "bill_no string, line_no string, item_code string, quantity string, rate string, type string, txn_time string"
)
SEMICOLON_NAMES = {
    "item_code": "product_code",
    "quantity": "qty",
    "rate": "unit_price",
    "type": "line_type",
    "txn_time": "ts",
}
EPOCH_EXPORT = (
    "ts string, bill_no string, line_no string, line_type string, product_code string, unit_price string, qty string"
)
LEDGER = "month string, closed_on date, revenue_inr decimal(18,2), signed_off_by string"
MASTERS = {
    "stores": "store_id string, store_name string, address_line string, city string, state string, region string,"
    " floor_area_sqft int, opened_on date",
    "product_categories": "category_id string, category_name string, department string, gst_rate decimal(4,3)",
    "products": "product_sk bigint, product_code string, product_name string, category_id string, brand string,"
    " pack_size string, uom string, valid_from date, valid_to date, is_current boolean",
    "price_revisions": "revision_id bigint, product_sk bigint, mrp decimal(12,2), selling_price decimal(12,2),"
    " effective_from date, effective_to date",
}
NOTICE = (
    "notice_id string, portal_id string, published_at string, title string, body string, estimated_value bigint,"
    " closing_date string"
)
LABELLED_PAIR = "notice_id_a string, notice_id_b string, label string"
CLUSTER = "notice_id string, cluster_id string, copy_index int, is_corrigendum boolean, archetype string"
