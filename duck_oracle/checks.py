"""SQL text of each check. The shapes differ from the Spark plans on purpose: full
number series less the present ones, sub-queries, and joins that fan out."""

from __future__ import annotations

from duck_oracle.tables import TABLES

# Report date T and audited day D of the test tables.
T, D = "DATE '2024-03-06'", "DATE '2024-03-05'"

SLUGS = (
    "sale",
    "purchase",
    "b2c_sale",
    "sale_return",
    "purchase_return",
    "expiry_in",
    "expiry_out",
    "transfer_in",
    "transfer_out",
)
SHEETS = (
    "Database_salehead",
    "Database_Purchasehead",
    "Database_b2csalehead",
    "Database_Salereturnhead",
    "Database_Purchasereturnhead",
    "Database_Expiry_inhead",
    "Database_Expiryouthead",
    "Database_Transferinhead",
    "Database_Transferouthead",
)
GAP_TITLE = "Invoice_Sequence_Missing"
DUP_TITLE = "Invoice_Duplicates"
MISMATCH_TITLE = "Item_Header_Mismatch"
QUANTITY_TITLE = "High_Purchase_Quantity(PurchaseQuantity + PurchaseFree>5000)"


def _heads(slug: str, db: int | None) -> str:
    both = "" if db is None else f" AND db = {db}"
    return f"(SELECT * FROM heads WHERE dom = {SLUGS.index(slug)}{both})"


def _items(db: int | None) -> str:
    return "items" if db is None else f"(SELECT * FROM items WHERE db = {db})"


# --- missing numbers -------------------------------------------------------------

_GAP_COLUMNS = {
    "sale": "h.id, h.entry_number, h.entry_date, m.branch_id, bname AS branch_name, "
    "bdomain AS branch_domain, h.is_retail_b2b_bill",
    "purchase": "h.id, h.entry_number, h.entry_date, bname AS name, bdomain AS domain, m.branch_id",
    "b2c_sale": "h.id, h.entry_number, h.entry_date, m.branch_id, bname AS branch_name, "
    "bdomain AS branch_domain",
    "sale_return": "h.id, h.entry_number, h.entry_date, f.is_b2b_bill, m.branch_id, "
    "bname AS branch_name, bdomain AS domain",
    "purchase_return": "h.id, h.entry_number, h.entry_date, h.branch_id, bname AS name, bdomain AS domain",
    "transfer_in": "h.id, h.entry_date, h.entry_number, bname AS branch_name, m.branch_id, bdomain AS domain",
}
for _slug in ("expiry_in", "expiry_out", "transfer_out"):
    _GAP_COLUMNS[_slug] = (
        "h.id, h.entry_number, h.entry_date, bname AS branch_name, bdomain AS domain, m.branch_id"
    )


def gap_sql(slug: str, db: int | None = None) -> str:
    heads = _heads(slug, db)
    if slug == "expiry_in":
        taking_part = "num IS NOT NULL"
    elif slug == "b2c_sale":
        taking_part = f"num IS NOT NULL AND ts >= {D} AND ts < {T}"
    else:
        taking_part = f"ok AND ts >= {D} AND ts {'<' if slug == 'sale' else '<='} {T}"
    text = "pre || lpad(CAST(n AS VARCHAR), 4, '0')"
    if slug in ("b2c_sale", "expiry_in"):
        present = f"SELECT 1 FROM {heads} x WHERE x.branch_id = r.branch_id AND x.entry_number = r.{text}"
    else:
        present = "SELECT 1 FROM w x WHERE x.branch_id = r.branch_id AND x.pre = r.pre AND x.num = r.n"
    if slug in ("sale", "transfer_in", "transfer_out"):
        same = "h.pre = m.pre"
    else:
        same = "h.entry_number = m.missing"
    flag = ""
    if slug == "sale_return":
        flag = """LEFT JOIN (
          SELECT branch_id, pre, is_b2b_bill FROM (
            SELECT *, row_number() OVER (PARTITION BY branch_id, pre ORDER BY id) AS nth FROM w)
          WHERE nth = 1) f ON f.branch_id = m.branch_id AND f.pre = m.pre"""
    return f"""
      WITH w AS (SELECT * FROM {heads} WHERE {taking_part}),
      r AS (SELECT branch_id, pre, unnest(generate_series(min(num), max(num))) AS n
            FROM w GROUP BY branch_id, pre),
      m AS (SELECT branch_id, pre, {text} AS missing FROM r WHERE NOT EXISTS ({present}))
      SELECT {_GAP_COLUMNS[slug]}, m.missing AS missing_entry_number
      FROM m JOIN branches ON bid = m.branch_id {flag}
      LEFT JOIN {heads} h ON h.branch_id = m.branch_id AND {same}"""


# --- duplicates ------------------------------------------------------------------


def dup_sql(slug: str, db: int | None = None) -> str:
    day = f"(SELECT * FROM {_heads(slug, db)} WHERE ymd = {D})"
    return f"""
      SELECT h.id, h.entry_number, h.entry_date, h.branch_id, bname AS name, bdomain AS domain
      FROM {day} h JOIN branches ON bid = h.branch_id
      WHERE h.entry_number IN (SELECT entry_number FROM {day} GROUP BY entry_number HAVING count(*) > 1)"""


# --- amounts ---------------------------------------------------------------------

_INC = "h.billing_on IN ('3', '8', '9')"
_CUT_BY_MODE = (
    f"CASE WHEN {_INC} THEN shared / (1 + g / 100) ELSE plain END",
    f"CASE WHEN {_INC} THEN shared ELSE plain * (1 + g / 100) END",
)
_AMOUNTS = {
    "purchase": ("net - net * o / 100", "(net - net * o / 100) * (1 + g / 100)"),
    "purchase_return": (
        f"CASE WHEN {_INC} THEN bought / (1 + g / 100) ELSE bought END",
        f"CASE WHEN {_INC} THEN bought ELSE bought * (1 + g / 100) END",
    ),
    "expiry_in": ("shared", "plain * (1 + g / 100)"),
    "transfer_in": ("bought", "bought * (1 + g / 100)"),
}
_SUM_NAMES = {
    "purchase": ("item_total_purchase_value", "item_discount_value"),
    "transfer_in": ("item_total_purchase_value", "item_discount_value"),
    "purchase_return": ("item_total_purchase_returnvalue", "item_discount_value"),
}


def mismatch_sql(slug: str, db: int | None = None) -> str:
    tax, total = _AMOUNTS.get(slug, _CUT_BY_MODE)
    value_name, discount_name = _SUM_NAMES.get(slug, ("item_total_sale_value", "item_discount_sale_value"))
    by_supplier = slug in ("purchase_return", "transfer_in")
    party = "supplier_name" if by_supplier else "client_name"
    client = "h.supplier_id_id" if by_supplier else "b.client"
    buyer = "supplier_id_id" if by_supplier or slug == "expiry_out" else "customer_id_id"
    by_mode = slug not in ("purchase", "expiry_in", "transfer_in")
    calculated = "h.gross_total + h.total_gst - h.total_disc"
    if by_mode:
        calculated = f"CASE WHEN {_INC} THEN h.gross_total - h.total_disc ELSE {calculated} END"
    supplier = "LEFT JOIN supplier ON s_suppkey = h.supplier_id_id" if slug == "purchase" else ""
    # Item arithmetic in steps: percentages first, then the cuts.
    return f"""
      WITH j AS (
        SELECT h.*, b.bname, b.bdomain, c.cid, c.cname, i.val, i.gst_value, i.disc,
          CAST(i.val AS DOUBLE) AS v, CAST(i.disc AS DOUBLE) AS d, CAST(i.gst AS DOUBLE) AS g,
          coalesce(u.factor, 0.0) AS f, coalesce(CAST(h.overall_disc AS DOUBLE), 0.0) AS o,
          coalesce(s.overrides, false) AS ov
        FROM {_heads(slug, db)} h
        LEFT JOIN {_items(db)} i ON i.hid = h.id
        LEFT JOIN branches b ON b.bid = h.branch_id
        LEFT JOIN clients c ON c.cid = {client}
        LEFT JOIN settings s ON s.sbranch = h.branch_id
        LEFT JOIN buyers u ON u.uid = h.{buyer} {supplier}
        WHERE h.ts >= {D} AND h.ts < {T}),
      p AS (SELECT *, v - v * d / 100 AS net, v - v * d / 100 * (1 - f / 100) AS soft FROM j),
      q AS (SELECT *,
          soft - CASE WHEN ov THEN 0.0 ELSE net * (1 - f / 100) * o / 100 END AS shared,
          soft - CASE WHEN ov THEN 0.0 ELSE net * o / 100 END AS plain,
          net - CASE WHEN ov THEN 0.0 ELSE net * f / 100 END AS bought
        FROM p),
      t AS (
        SELECT entry_date, entry_number, branch_id, bname AS branch_name, bdomain AS domain, cid,
          cname AS {party}, billing_on, net_amount, gross_total, total_gst, total_disc,
          sum(val) AS {value_name}, sum(gst_value) AS item_total_gst_value, sum(disc) AS {discount_name}, id,
          CAST(sum(CAST({tax} AS DECIMAL(30,10))) AS DECIMAL(16,2)) AS items_tax_value,
          CAST(sum(CAST({total} AS DECIMAL(30,10))) AS DECIMAL(16,2)) AS items_total_value,
          {calculated} AS calculated_net_amount
        FROM q h GROUP BY ALL)
      SELECT * EXCLUDE (cid{'' if by_mode else ', billing_on'}),
        abs(calculated_net_amount - net_amount) AS difference_amount
      FROM t WHERE abs(calculated_net_amount - net_amount) <> 0"""


# --- quantities ------------------------------------------------------------------

_ITEM_NAMES = {
    "sale": ("sale_header_id", "sale_value", "sale_quantity", "sale_free", "sum_of_sq_sf"),
    "sale_return": ("sale_return_header_id", "sale_value", "sale_quantity", "sale_free", "sum_of_sq_sf"),
    "purchase_return": (
        "purchase_return_header_id",
        "return_value",
        "return_quantity",
        "return_free",
        "sum_of_pq_pf",
    ),
}
_PURCHASE_NAMES = (
    "purchase_header_id",
    "purchase_value",
    "purchase_quantity",
    "purchase_free",
    "sum_of_pq_pf",
)


def quantity_sql(slug: str, db: int | None = None) -> str:
    names = _ITEM_NAMES.get(slug, _PURCHASE_NAMES)
    shown = ", ".join(
        f"{value} AS {name}" for value, name in zip(("hid", "val", "qty", "free", "qty + free"), names)
    )
    branch = ("", "") if slug == "b2c_sale" else (
        "bname AS branch_name, bdomain AS domain,",
        "JOIN branches ON bid = h.branch_id",
    )
    if slug in _ITEM_NAMES or slug == "purchase":
        source = f"{_items(db)} i JOIN {_heads(slug, db)} h ON h.id = i.hid"
    else:
        source = f"""{_items(db)} i JOIN {_heads('purchase', db)} a ON a.id = i.hid
          JOIN {_heads(slug, db)} h ON h.branch_id = a.branch_id AND h.ymd = a.ymd"""
    return f"""
      SELECT h.id, h.entry_number, h.entry_date, h.branch_id, {branch[0]} {shown}
      FROM {source} {branch[1]} WHERE h.ymd = {D} AND qty + free > 5000"""


FAMILIES = (
    ("seq_gap", GAP_TITLE, gap_sql),
    ("dup", DUP_TITLE, dup_sql),
    ("mismatch", MISMATCH_TITLE, mismatch_sql),
    ("high_qty", QUANTITY_TITLE, quantity_sql),
)


# --- building blocks and report --------------------------------------------------


def _sections():
    for db, name in ((0, "RMS"), (1, "DMS")):
        for slug, sheet in zip(SLUGS, SHEETS):
            for prefix, title, sql in FAMILIES:
                yield prefix, name, sheet, title, sql(slug, db)


def _status_sql() -> str:
    counts = "\nUNION ALL ".join(
        f"SELECT '{name}' AS source_db, '{sheet}' AS sheet, '{title}' AS check_title, count(*) AS n FROM ({sql})"
        for _, name, sheet, title, sql in _sections()
    )
    return f"""
      SELECT source_db, sheet, check_title, CASE WHEN n = 0 THEN 'EMPTY' ELSE 'ROWS' END AS status,
        n AS row_count, CASE WHEN n = 0 THEN 'No records found' END AS message
      FROM ({counts})"""


# Family -> record fields reported beside the id, and the amounts (in cents) or quantities.
DETAIL_FIELDS = {
    "seq_gap": ("missing_entry_number",),
    "dup": ("entry_number",),
    "mismatch": ("entry_date", "entry_number"),
    "high_qty": ("entry_date", "entry_number"),
}
DETAIL_AMOUNTS = {
    "mismatch": ("difference_amount", "net_amount", "items_total_value"),
    "high_qty": ("sum_of_sq_sf", "sum_of_pq_pf"),
}


def _detail(prefix: str, sql: str) -> str:
    fields = [*DETAIL_FIELDS[prefix]]
    for name in DETAIL_AMOUNTS.get(prefix, ()):
        if name in sql:
            fields.append(f"CAST(CAST(round(CAST({name} AS DOUBLE) * 100) AS BIGINT) AS VARCHAR)")
    return f"concat_ws('|', {', '.join(fields)})"


def _detail_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS source_db, '{sheet}' AS sheet, '{title}' AS check_title, id, "
        f"{_detail(prefix, sql)} AS detail FROM ({sql})"
        for prefix, name, sheet, title, sql in _sections()
    )


def _skipped_sql() -> str:
    """Head rows by head table first, each section's from its tables after that."""
    blank = "trim(coalesce(entry_date, '')) = ''"
    tables = []
    for slug in SLUGS:
        span = "true" if slug == "expiry_in" else f"ts >= {D} AND ts {'<' if slug in ('sale', 'b2c_sale') else '<='} {T}"
        usable = "num IS NOT NULL" if slug in ("b2c_sale", "expiry_in") else "ok"
        tables.append(f"""
          SELECT '{slug}' AS slug, db, CAST({blank} AS INTEGER) AS blank, CAST(NOT {blank} AND ts IS NULL AS INTEGER) AS bad,
            CASE WHEN branch_id IS NOT NULL AND {span} THEN
              CASE WHEN coalesce(entry_number, '') = '' THEN 'none' WHEN {usable} THEN 'used' ELSE 'bad' END END AS numbering
          FROM heads WHERE dom = {SLUGS.index(slug)}""")
    sections = []
    for db, name in ((0, "RMS"), (1, "DMS")):
        for slug, sheet in zip(SLUGS, SHEETS):
            for prefix, title, _ in FAMILIES:
                read = [slug]
                if prefix == "high_qty" and slug not in _ITEM_NAMES and slug != "purchase":
                    read.append("purchase")
                dates = 0 if (prefix, slug) == ("seq_gap", "expiry_in") else 1
                numbers = 1 if prefix == "seq_gap" else 0
                among = ", ".join(f"'{s}'" for s in read)
                sections.append(f"""
                  SELECT '{name}' AS source_db, '{sheet}' AS sheet, '{title}' AS check_title,
                    CAST(coalesce(sum({dates} * blank), 0) AS BIGINT) AS undated,
                    CAST(coalesce(sum({dates} * bad), 0) AS BIGINT) AS malformed_dates,
                    {numbers} * count(*) FILTER (numbering = 'none') AS unnumbered,
                    {numbers} * count(*) FILTER (numbering = 'bad') AS malformed_numbers
                  FROM head_rows WHERE db = {db} AND slug IN ({among})""")
    return f"WITH head_rows AS MATERIALIZED ({' UNION ALL '.join(tables)}) {' UNION ALL '.join(sections)}"


def oracle_sql() -> dict[str, str]:
    checks = {f"{prefix}_{slug}": sql(slug) for slug in SLUGS for prefix, _, sql in FAMILIES}
    checks["entry_number_parts"] = (
        "SELECT CAST(dom AS INTEGER) AS domain_no, id, branch_id, pre AS series, num AS number FROM heads WHERE ok"
    )
    checks["day_window"] = (
        "SELECT CAST(dom AS INTEGER) AS domain_no, id, branch_id, entry_number, entry_date "
        f"FROM heads WHERE ts >= {D} AND ts < {T}"
    )
    checks["report_status"] = _status_sql()
    checks["report_detail"] = _detail_sql()
    checks["report_skipped"] = _skipped_sql()
    return {key: f"WITH {TABLES}\n SELECT * FROM ({sql})" for key, sql in checks.items()}
