"""DuckDB SQL that recomputes every registered query from the same tables, straight from the rules.

Deliberately dense and naive: products are crossed with the calendar and stock is a running sum over all days.
"""

from __future__ import annotations

from shelfledger.schemas import DAILY_COLUMNS

RUN_DATE, CUTOFF = "DATE '2001-12-31'", "DATE '2001-06-30'"
INACTIVE_FROM = "DATE '1999-07-01'"
D = "DECIMAL(38,6)"

# Name -> (names it reads, SQL), in reading order.
STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def step(name: str, reads: str, sql: str) -> None:
    STEPS[name] = (tuple(reads.split()), sql)


def with_steps(reads: str, sql: str, changed: dict[str, str] | None = None) -> str:
    """The query with the steps it needs ahead of it; some may be other than usual."""
    needed: set[str] = set()
    todo = reads.split()
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += STEPS[name][0]
    parts = [f"{name} AS MATERIALIZED ({(changed or {}).get(name, STEPS[name][1])})" for name in STEPS if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


step(
    "pos_detail",
    "",
    f"""SELECT CASE WHEN p_size = 13 THEN NULL ELSE l_partkey::INTEGER END AS product,
      CASE WHEN p_size = 29 AND l_linenumber = 7 THEN NULL WHEN p_size = 29 AND l_linenumber = 6 THEN -1
           ELSE l_orderkey END AS pos_master,
      CASE WHEN p_size = 17 THEN 0 WHEN p_size = 29 AND l_linenumber = 1 THEN NULL ELSE l_quantity END::{D} AS qty,
      l_extendedprice::{D} AS amount,
      l_returnflag = 'R' AS is_return,
      CASE WHEN round(l_discount * 100)::INTEGER > 5 THEN round(l_discount * 100)::INTEGER END AS discount,
      round(l_extendedprice * 100)::BIGINT AS cents, l_quantity::BIGINT AS whole_qty
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
)
step("config", "", "SELECT CASE WHEN r_regionkey = 0 THEN 1 END AS code FROM region")
step(
    "pos_master",
    "",
    "SELECT o_orderkey AS code, o_orderdate + to_minutes(o_custkey % 1440) AS transaction_ts FROM orders",
)
step(
    "imex_detail",
    "",
    f"""SELECT CASE WHEN p_size = 17 THEN NULL ELSE l_partkey::INTEGER END AS product,
      CASE WHEN p_size = 29 AND l_linenumber = 7 THEN NULL ELSE l_orderkey END AS document_no,
      (l_quantity + 1)::{D} AS quantity,
      CASE WHEN l_tax = 0.08 AND l_quantity = 13 THEN NULL ELSE l_quantity * 3 END::{D} AS qty_received
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
)
step(
    "imex_master",
    "",
    """SELECT code, eff_ts, kind,
      CASE WHEN o_orderstatus = 'O' THEN CASE WHEN kind IN (1, 2, 21) THEN 2 ELSE 5 END
           ELSE CASE WHEN kind IN (1, 2, 21) THEN 3 ELSE 6 END END AS status,
      CASE WHEN cust % 31 = 0 THEN NULL WHEN cust % 37 = 0 THEN eff_ts + INTERVAL 1 DAY
           WHEN cust % 41 = 0 THEN eff_ts + INTERVAL 86399700 MILLISECONDS
           ELSE eff_ts + to_hours(cust % 24) END AS receipt_ts
    FROM (SELECT o_orderkey AS code, o_custkey AS cust, o_orderstatus,
            o_orderdate + to_days((o_custkey % 30)::INTEGER) AS eff_ts,
            CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 21 WHEN '4-NOT SPECIFIED' THEN 2
              WHEN '5-LOW' THEN 10 ELSE CASE WHEN o_orderstatus = 'P' THEN 99 ELSE 5 END END AS kind
          FROM orders)""",
)
step(
    "product",
    "",
    """SELECT CASE WHEN p_size <> 23 THEN p_partkey::INTEGER END AS product, (1000 + 4 * p_size)::VARCHAR AS group_code,
      CASE WHEN p_size = 29 THEN 'H' || p_partkey WHEN p_size = 31 THEN '  ' WHEN p_size = 37 THEN NULL
           WHEN p_size IN (41, 43) THEN 'B' || regexp_extract(p_brand, '([0-9]+)', 1)
           ELSE '893' || p_partkey END AS barcode,
      p_name AS product_name, regexp_extract(p_brand, '([0-9]+)', 1) AS brand_code,
      p_size::VARCHAR AS quantitative, p_type AS packing_size
    FROM part""",
)
step(
    "groups",
    "",
    """SELECT (r_regionkey + 1)::BIGINT AS code, NULL::BIGINT AS parent, r_name AS name FROM region
    UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, n_name FROM nation
    UNION ALL SELECT s_suppkey + 1000, s_nationkey + 100, s_name FROM supplier""",
)
step(
    "brand",
    "",
    """SELECT regexp_extract(p_brand, '([0-9]+)', 1) AS brand_code, max(p_brand) AS brand_name
    FROM part WHERE p_brand <> 'Brand#25' GROUP BY 1""",
)
step(
    "bundle",
    "",
    """SELECT CASE WHEN n_nationkey <> 10 THEN n_nationkey END AS discount, n_regionkey + 1 AS promotion FROM nation""",
)
step(
    "promotion",
    "",
    """SELECT CASE WHEN r_regionkey <> 4 THEN r_regionkey + 1 END AS promotion,
      CASE WHEN r_regionkey = 2 THEN DATE '1997-01-01' ELSE DATE '1995-01-01' END AS start_date,
      CASE WHEN r_regionkey = 2 THEN DATE '1999-12-31' ELSE DATE '2001-12-31' END AS end_date,
      CASE r_regionkey WHEN 1 THEN 2 WHEN 2 THEN 7 WHEN 3 THEN 1 END AS promotion_type
    FROM region""",
)
step(
    "pos_dated",
    "pos_detail pos_master",
    """SELECT d.*, m.transaction_ts, m.transaction_ts::DATE AS business_date
    FROM pos_detail d LEFT JOIN pos_master m ON m.code = d.pos_master WHERE d.product IS NOT NULL""",
)
step(
    "pos_daily",
    "pos_dated",
    f"""SELECT product, business_date, sum(CASE WHEN NOT is_return THEN qty ELSE 0::{D} END) AS sale_qty,
      sum(CASE WHEN is_return THEN qty ELSE 0::{D} END) AS return_qty, count(*) AS line_count,
      bool_or(qty IS NULL) AS has_null_qty
    FROM pos_dated GROUP BY 1, 2""",
)


def _imex(in_progress: bool) -> str:
    extra = f"""WHEN {in_progress} AND kind IN (1, 2, 3, 4, 21, 31, 41, 50) AND status = 2 THEN quantity
        WHEN {in_progress} AND kind IN (5, 6, 7, 8, 9, 20, 30, 40, 52) AND status = 5 THEN -qty_received"""
    return f"""SELECT m.code AS document, d.product, eff_ts::DATE AS business_date,
      CASE WHEN kind IN (1, 2, 3, 4, 21, 31, 41, 50) AND status = 3 THEN qty_received
        WHEN kind IN (5, 6, 7, 8, 9, 10, 20, 30, 40, 52) AND status = 6 THEN -qty_received
        {extra} ELSE 0 END::{D} AS net_qty,
      coalesce(kind = 1 AND status = 3, false) AS is_internal_receipt,
      date_trunc('second', receipt_ts + INTERVAL 500 MILLISECONDS) AS raw_receipt_ts,
      CASE WHEN kind = 1 AND status = 3 AND receipt_ts::DATE = eff_ts::DATE
        THEN date_trunc('second', receipt_ts + INTERVAL 500 MILLISECONDS) END AS receipt_candidate_ts
    FROM imex_detail d LEFT JOIN imex_master m ON m.code = d.document_no
    WHERE d.product IS NOT NULL AND (m.code IS NULL OR eff_ts IS NULL
      OR (kind IN (1, 2, 3, 4, 21, 31, 41, 50) AND status IN (2, 3))
      OR (kind IN (5, 6, 7, 8, 9, 10, 20, 30, 40, 52) AND status IN (5, 6)))"""


step("imex", "imex_detail imex_master", _imex(False))
step("imex_progress", "imex_detail imex_master", _imex(True))
step("activity", "pos_daily", "SELECT DISTINCT business_date FROM pos_daily WHERE business_date IS NOT NULL")
step(
    "audit",
    "pos_daily product",
    """SELECT s.product, p.barcode, p.product IS NULL AS missing_from_master,
      p.barcode IS NULL OR trim(p.barcode) = '' AS missing_barcode, coalesce(p.barcode LIKE 'H%', false) AS has_h_prefix
    FROM (SELECT DISTINCT product FROM pos_daily) s LEFT JOIN product p ON p.product = s.product""",
)
step(
    "candidate",
    "audit",
    "SELECT product, barcode FROM audit WHERE NOT missing_from_master AND NOT missing_barcode AND NOT has_h_prefix",
)
step(
    "win",
    "pos_daily imex",
    f"""SELECT window_end, ((window_end - INTERVAL 5 YEAR) + INTERVAL 1 DAY)::DATE AS window_start
    FROM (SELECT max(d) AS window_end FROM (SELECT business_date AS d FROM pos_daily
          UNION ALL SELECT business_date FROM imex) WHERE d <= {RUN_DATE})""",
)
step(
    "moves",
    "pos_daily imex",
    """SELECT product, business_date, net_qty, net_qty IS NULL AS unknown FROM imex WHERE business_date IS NOT NULL
    UNION ALL SELECT product, business_date, return_qty - sale_qty, has_null_qty FROM pos_daily
    WHERE business_date IS NOT NULL""",
)
step(
    "receipt_day",
    "imex",
    """SELECT product, business_date, min(raw_receipt_ts::DATE) AS first_receipt_date,
      bool_or(raw_receipt_ts IS NULL) AS any_missing,
      bool_or(raw_receipt_ts IS NOT NULL AND raw_receipt_ts::DATE <> business_date) AS any_mismatch,
      bool_or(raw_receipt_ts IS NOT NULL AND raw_receipt_ts = date_trunc('day', raw_receipt_ts)) AS any_midnight,
      min(receipt_candidate_ts) AS first_ts
    FROM imex WHERE is_internal_receipt AND business_date IS NOT NULL GROUP BY 1, 2""",
)
# Dense on purpose: levels on every day of the inactivity window, not on movement days only.
step(
    "evidence",
    "candidate moves pos_daily receipt_day",
    f"""WITH opening AS (SELECT product, coalesce(sum(net_qty), 0) AS opening, bool_or(unknown) AS unknown FROM moves
        WHERE business_date < {INACTIVE_FROM} GROUP BY 1),
      day_net AS (SELECT product, business_date, sum(net_qty) AS net_qty, bool_or(unknown) AS unknown FROM moves
        WHERE business_date BETWEEN {INACTIVE_FROM} AND {CUTOFF} GROUP BY 1, 2),
      days AS (SELECT unnest(generate_series({INACTIVE_FROM}::TIMESTAMP, {CUTOFF}::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d),
      level AS (SELECT c.product, days.d, coalesce(o.opening, 0::{D}) AS opening,
          coalesce(n.net_qty, 0::{D}) AS net_qty, coalesce(o.unknown, false) OR coalesce(n.unknown, false) AS unknown
        FROM candidate c CROSS JOIN days LEFT JOIN opening o ON o.product = c.product
        LEFT JOIN day_net n ON n.product = c.product AND n.business_date = days.d),
      running AS (SELECT product, d, opening, unknown, net_qty,
          opening + sum(net_qty) OVER (PARTITION BY product ORDER BY d ROWS UNBOUNDED PRECEDING) AS close_level
        FROM level),
      stock AS (SELECT product, max(opening) AS stock_at_window_start, max(close_level - net_qty) AS max_open_stock,
          max(close_level) AS max_close_stock, least(max(opening), min(close_level)) AS min_stock,
          bool_or(unknown) AS has_unknown_qty FROM running GROUP BY 1),
      sold AS (SELECT DISTINCT product FROM pos_daily WHERE sale_qty > 0
        AND business_date BETWEEN {INACTIVE_FROM} AND {CUTOFF}),
      received AS (SELECT DISTINCT product FROM receipt_day WHERE NOT any_missing AND NOT any_mismatch
        AND first_ts IS NOT NULL AND business_date BETWEEN {INACTIVE_FROM} AND {CUTOFF})
    SELECT s.product, c.barcode, sold.product IS NOT NULL AS has_positive_sales,
      received.product IS NOT NULL AS has_receipt, stock_at_window_start::{D} AS stock_at_window_start,
      max_open_stock::{D} AS max_open_stock, max_close_stock::{D} AS max_close_stock, min_stock::{D} AS min_stock,
      has_unknown_qty, has_unknown_qty OR min_stock < 0 AS has_untrusted_stock,
      sold.product IS NULL AND received.product IS NULL AND max_open_stock <= 0 AND max_close_stock <= 0
        AND NOT has_unknown_qty AND min_stock >= 0 AS is_long_term_inactive
    FROM stock s JOIN candidate c ON c.product = s.product
    LEFT JOIN sold ON sold.product = s.product LEFT JOIN received ON received.product = s.product""",
)
step(
    "paths",
    "groups",
    """SELECT g.code, CASE WHEN r.code IS NOT NULL THEN [r.code, n.code, g.code] WHEN n.code IS NOT NULL
        THEN [n.code, g.code] ELSE [g.code] END AS codes,
      CASE WHEN r.code IS NOT NULL THEN [r.name, n.name, g.name] WHEN n.code IS NOT NULL
        THEN [n.name, g.name] ELSE [g.name] END AS names
    FROM groups g LEFT JOIN groups n ON n.code = g.parent LEFT JOIN groups r ON r.code = n.parent""",
)
step(
    "group_path",
    "paths",
    "SELECT code::VARCHAR AS assigned_group, "
    + ", ".join(
        f"'G' || codes[{k}] AS group_id{'' if k == 1 else k}, names[{k}] AS group_name{'' if k == 1 else k}"
        for k in range(1, 6)
    )
    + " FROM paths",
)
GROUP_COLUMNS = ", ".join(f"group_id{s}, group_name{s}" for s in ("", "2", "3", "4", "5"))
step(
    "target",
    "candidate evidence product group_path brand win",
    f"""SELECT c.product, p.product_name, c.barcode, {GROUP_COLUMNS}, p.brand_code, b.brand_name, p.quantitative,
      p.packing_size, win.window_start, win.window_end
    FROM candidate c JOIN evidence e ON e.product = c.product AND NOT e.is_long_term_inactive
    JOIN product p ON p.product = c.product LEFT JOIN group_path g ON g.assigned_group = p.group_code
    LEFT JOIN brand b ON b.brand_code = p.brand_code CROSS JOIN win""",
)
step(
    "seed",
    "target moves",
    f"""SELECT t.product, CASE WHEN coalesce(s.unknown, false) THEN NULL ELSE coalesce(s.net, 0::{D}) END AS seed_net_movement,
      NOT coalesce(s.unknown, false) AS is_seed_known
    FROM target t LEFT JOIN (SELECT m.product, sum(net_qty) AS net, bool_or(unknown) AS unknown FROM moves m
      JOIN target t USING (product) WHERE m.business_date < t.window_start GROUP BY 1) s ON s.product = t.product""",
)
step(
    "lines",
    "pos_detail pos_master target",
    """SELECT d.product, m.transaction_ts::DATE AS business_date, d.qty, d.amount, d.discount, d.is_return, d.cents, d.whole_qty
    FROM pos_detail d JOIN pos_master m ON m.code = d.pos_master JOIN target t ON t.product = d.product
    WHERE m.transaction_ts >= t.window_start AND m.transaction_ts < t.window_end + INTERVAL 1 DAY""",
)
step(
    "sales",
    "lines",
    "SELECT product, business_date, sum(qty) AS sales_qty FROM lines WHERE NOT is_return GROUP BY 1, 2",
)
# Half-up division at six digits, in whole numbers.
step(
    "price_line",
    "lines",
    f"""SELECT product, business_date, (((20000 * cents + whole_qty) // (2 * whole_qty))::DECIMAL(30,0)
        * 0.000001::DECIMAL(7,6))::{D} AS unit_price
    FROM lines WHERE NOT is_return AND discount IS NULL AND qty > 0 AND amount IS NOT NULL""",
)
step(
    "price",
    "price_line",
    """SELECT product, business_date, CASE WHEN count(DISTINCT unit_price) = 1 THEN max(unit_price) END AS price,
      count(DISTINCT unit_price) AS distinct_unit_prices FROM price_line GROUP BY 1, 2""",
)
step(
    "resolution",
    "lines bundle promotion",
    """SELECT u.discount, b.discount IS NOT NULL AS bundle_found, p.promotion IS NOT NULL AS promotion_found, p.promotion,
      p.start_date, p.end_date, p.promotion_type
    FROM (SELECT DISTINCT discount FROM lines WHERE discount IS NOT NULL) u
    LEFT JOIN (SELECT discount, max(promotion) AS promotion FROM bundle WHERE discount IS NOT NULL GROUP BY 1) b
      ON b.discount = u.discount
    LEFT JOIN promotion p ON p.promotion = b.promotion""",
)
step(
    "promo",
    "lines resolution",
    """SELECT l.product, l.business_date, sum(l.qty) AS promo_qty FROM lines l JOIN resolution r ON r.discount = l.discount
    WHERE NOT l.is_return AND r.promotion_found AND r.promotion_type IN (2, 7)
      AND l.business_date BETWEEN r.start_date AND r.end_date GROUP BY 1, 2""",
)
step(
    "movement",
    "target imex lines",
    f"""SELECT product, business_date, bool_or(stocked) AS has_inventory_movement,
      CASE WHEN NOT bool_or(unknown) THEN sum(imex_net) END AS inventory_net_movement, sum(pos_out) AS pos_out_qty,
      sum(pos_back) AS return_qty,
      CASE WHEN NOT bool_or(unknown) THEN sum(imex_net - pos_out + pos_back) END AS daily_net_movement,
      bool_or(unknown) AS has_unknown_movement
    FROM (SELECT i.product, i.business_date, true AS stocked, i.net_qty AS imex_net, 0::{D} AS pos_out, 0::{D} AS pos_back,
            i.net_qty IS NULL AS unknown
          FROM imex i JOIN target t ON t.product = i.product AND i.business_date BETWEEN t.window_start AND t.window_end
          UNION ALL
          SELECT product, business_date, false, 0::{D}, CASE WHEN is_return THEN 0::{D} ELSE qty END,
            CASE WHEN is_return THEN qty ELSE 0::{D} END, false FROM lines)
    GROUP BY 1, 2""",
)
step(
    "calendar",
    "win activity",
    """SELECT c.d AS business_date, a.business_date IS NOT NULL AS has_sales_record
    FROM (SELECT unnest(generate_series(window_start::TIMESTAMP, window_end::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM win) c
    LEFT JOIN activity a ON a.business_date = c.d""",
)
step(
    "stock",
    "target calendar seed movement",
    f"""SELECT product, business_date, net AS daily_net_movement,
      CASE WHEN NOT tainted THEN close_level - net END::{D} AS open_stock,
      CASE WHEN NOT tainted THEN close_level END::{D} AS close_stock,
      CASE WHEN tainted THEN 'UNKNOWN_QUANTITY' WHEN close_level < 0 OR close_level - net < 0 THEN 'NEGATIVE'
        ELSE 'VALID' END AS stock_status
    FROM (SELECT t.product, c.business_date, coalesce(m.daily_net_movement, 0::{D}) AS net,
        coalesce(s.seed_net_movement, 0::{D}) + sum(coalesce(m.daily_net_movement, 0::{D})) OVER w AS close_level,
        bool_or(NOT s.is_seed_known OR coalesce(m.has_unknown_movement, false)) OVER w AS tainted
      FROM target t CROSS JOIN calendar c JOIN seed s ON s.product = t.product
      LEFT JOIN movement m ON m.product = t.product AND m.business_date = c.business_date
      WINDOW w AS (PARTITION BY t.product ORDER BY c.business_date ROWS UNBOUNDED PRECEDING))""",
)
step(
    "receipt",
    "receipt_day target",
    """SELECT r.product, r.business_date, r.first_receipt_date,
      CASE WHEN NOT any_missing AND NOT any_mismatch THEN first_ts END AS first_receipt_ts,
      CASE WHEN NOT any_missing AND NOT any_mismatch THEN hour(first_ts) END::INTEGER AS receipt_hour,
      CASE WHEN any_mismatch THEN 'DATE_MISMATCH' WHEN any_missing THEN 'MISSING' WHEN any_midnight THEN 'DATE_ONLY'
        ELSE 'TIMED' END AS receipt_status
    FROM receipt_day r JOIN target t ON t.product = r.product AND r.business_date BETWEEN t.window_start AND t.window_end""",
)
step(
    "daily",
    "stock target calendar sales price promo receipt",
    f"""SELECT st.product AS "ProductCode", t.product_name AS "ProductName", t.barcode AS "Barcode",
      'NATION_1' AS "LocationCode", 'NATION_1' AS "LocationName", st.business_date AS "Date",
      c.has_sales_record AS "HasSalesRecord",
      CASE WHEN c.has_sales_record THEN coalesce(s.sales_qty, 0::{D}) END AS "SalesQty",
      CASE WHEN c.has_sales_record THEN coalesce(pr.promo_qty, 0::{D}) END AS "PromoSalesQty",
      c.has_sales_record AND pr.product IS NOT NULL AS "IsPromo", st.open_stock AS "OpenStock",
      st.close_stock AS "CloseStock", r.first_receipt_ts AS "FirstReceiptDateTime", p.price AS "Price",
      t.group_id AS "GroupID", t.group_name AS "GroupName", t.group_id2 AS "GroupID2", t.group_name2 AS "GroupName2",
      t.group_id3 AS "GroupID3", t.group_name3 AS "GroupName3", t.group_id4 AS "GroupID4", t.group_name4 AS "GroupName4",
      t.group_id5 AS "GroupID5", t.group_name5 AS "GroupName5", t.brand_code AS "BrandCode", t.brand_name AS "BrandName",
      t.quantitative AS "Quantitative", t.packing_size AS "PackingSize", NULL::VARCHAR AS "HolidayEvent",
      NULL::VARCHAR AS "HolidayGroup", NULL::VARCHAR AS "HolidayRelation"
    FROM stock st JOIN target t ON t.product = st.product JOIN calendar c ON c.business_date = st.business_date
    LEFT JOIN sales s ON s.product = st.product AND s.business_date = st.business_date
    LEFT JOIN price p ON p.product = st.product AND p.business_date = st.business_date
    LEFT JOIN promo pr ON pr.product = st.product AND pr.business_date = st.business_date
    LEFT JOIN receipt r ON r.product = st.product AND r.business_date = st.business_date""",
)

# One expression list for both roll-ups of the dense result.
DAILY_SUMMARY = (
    ("rows", "count(*)"),
    ("open_days", 'count(*) FILTER (WHERE "HasSalesRecord")'),
    ("sales_days", 'count("SalesQty")'),
    ("sales_qty", 'sum("SalesQty")'),
    ("promo_qty", 'sum("PromoSalesQty")'),
    ("promo_days", 'count(*) FILTER (WHERE "IsPromo")'),
    ("known_stock_days", 'count("CloseStock")'),
    ("open_stock", 'sum("OpenStock")'),
    ("close_stock", 'sum("CloseStock")'),
    ("min_close_stock", 'min("CloseStock")'),
    ("max_close_stock", 'max("CloseStock")'),
    ("receipt_days", 'count("FirstReceiptDateTime")'),
    ("first_receipt", 'min("FirstReceiptDateTime")'),
    ("last_receipt", 'max("FirstReceiptDateTime")'),
    ("priced_days", 'count("Price")'),
    ("price_sum", 'sum("Price")'),
    ("holidays", 'count("HolidayEvent") + count("HolidayGroup") + count("HolidayRelation")'),
)
ATTRIBUTE_COLUMNS = (
    ["ProductName", "Barcode", "LocationCode", "LocationName"]
    + [f"Group{kind}{s}" for s in ("", "2", "3", "4", "5") for kind in ("ID", "Name")]
    + ["BrandCode", "BrandName", "Quantitative", "PackingSize"]
)
_SUMMARY = ", ".join(f"{sql} AS {name}" for name, sql in DAILY_SUMMARY)
_ATTRIBUTES = ", ".join(f'"{c}"' for c in ATTRIBUTE_COLUMNS)

_SILENT = ("G1", "G2", "G2b", "G3", "G4", "S5", "S5t", "G7", "G8", "G9", "G10", "G23", "G19")
_ON_RESULT = ("G26", "I-1", "I-2", "I-2b", "I-3", "I-4", "I-5", "I-6", "I-8", "I-9")
_EARLY_GATES = f"""SELECT 'G5' AS gate, (SELECT (count(DISTINCT code) <> 1)::INTEGER FROM config WHERE code IS NOT NULL) AS violations
  UNION ALL SELECT 'G6', (SELECT (count(n_name) = 0)::INTEGER FROM config JOIN nation ON n_nationkey = code)
  UNION ALL SELECT 'K3', (SELECT (count(DISTINCT n_name) > 1)::INTEGER FROM config JOIN nation ON n_nationkey = code)
  UNION ALL SELECT 'K1', (SELECT count(*) FROM (SELECT product FROM product WHERE product IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'K4a', (SELECT count(*) FROM pos_detail JOIN pos_master ON code = pos_master WHERE product IS NOT NULL)
    - (SELECT count(*) FROM pos_detail WHERE product IS NOT NULL AND pos_master IN (SELECT code FROM pos_master))
  UNION ALL SELECT 'K4b', (SELECT count(*) FROM imex_detail JOIN imex_master ON code = document_no WHERE product IS NOT NULL)
    - (SELECT count(*) FROM imex_detail WHERE product IS NOT NULL AND document_no IN (SELECT code FROM imex_master))
  UNION ALL SELECT 'G22', (SELECT ((SELECT count(*) FROM pos_dated) < count(*))::INTEGER FROM pos_detail WHERE product IS NOT NULL)
  UNION ALL SELECT 'G11', (SELECT (count(*) = 0)::INTEGER FROM candidate)
  UNION ALL SELECT 'G12', (SELECT count(*) FROM pos_daily JOIN candidate USING (product) WHERE business_date IS NULL)
  UNION ALL SELECT 'G13', (SELECT count(*) FROM (SELECT DISTINCT product FROM imex JOIN candidate USING (product)
    WHERE business_date IS NULL))
  UNION ALL SELECT 'G14', (SELECT (max(window_end) IS NULL)::INTEGER FROM win)
  UNION ALL SELECT 'G15', (SELECT count(*) FROM pos_daily JOIN candidate USING (product), win
    WHERE has_null_qty AND business_date BETWEEN window_start AND window_end)
  UNION ALL SELECT 'G16', (SELECT ({CUTOFF} > max(window_end))::INTEGER FROM win)
  UNION ALL SELECT 'G17', (SELECT ({INACTIVE_FROM} < max(window_start))::INTEGER FROM win)
  UNION ALL SELECT 'G18', (SELECT (count(*) = 0)::INTEGER FROM target)
  UNION ALL SELECT 'G24', (SELECT count(*) FROM (SELECT discount FROM bundle JOIN (SELECT DISTINCT discount FROM lines) u
    USING (discount) GROUP BY 1 HAVING count(DISTINCT promotion) > 1))
  UNION ALL SELECT 'K2', (SELECT count(*) FROM (SELECT promotion FROM promotion WHERE promotion IN
    (SELECT promotion FROM resolution WHERE promotion_found) GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'G25', (SELECT (count(*) <> max(window_end - window_start) + 1)::INTEGER FROM calendar, win)
  UNION ALL SELECT 'I-7', (SELECT count(*) FROM target WHERE product NOT IN (SELECT product FROM pos_daily))"""
_EARLY_READS = (
    "config product pos_detail pos_master pos_dated imex_detail imex_master pos_daily candidate imex win bundle promotion lines "
    "resolution calendar target"
)
_RESULT_GATES = """SELECT 'G26' AS gate, (SELECT count(*) FROM (SELECT open_stock, lag(close_stock) OVER (PARTITION BY product
    ORDER BY business_date) AS previous FROM stock) WHERE abs(open_stock - previous) > 0.000001) AS violations
  UNION ALL SELECT 'I-1', (SELECT count(*) FROM daily WHERE "HasSalesRecord" <> ("SalesQty" IS NOT NULL)
    OR "HasSalesRecord" <> ("PromoSalesQty" IS NOT NULL))
  UNION ALL SELECT 'I-2', (SELECT count(*) FROM (SELECT product, business_date, sales_qty FROM sales WHERE sales_qty <> 0) s
    FULL JOIN (SELECT * FROM daily WHERE "SalesQty" <> 0) d ON s.product = "ProductCode" AND s.business_date = "Date"
    WHERE sales_qty IS DISTINCT FROM "SalesQty")
  UNION ALL SELECT 'I-2b', (SELECT count(*) FROM daily WHERE "SalesQty" < 0 OR "PromoSalesQty" < 0
    OR "PromoSalesQty" > "SalesQty")
  UNION ALL SELECT 'I-3', (SELECT count(*) FROM daily WHERE "IsPromo" AND NOT "HasSalesRecord")
  UNION ALL SELECT 'I-4', (SELECT ((SELECT count(*) FROM daily) <> (SELECT count(*) FROM target)
    * (SELECT count(*) FROM calendar))::INTEGER)
  UNION ALL SELECT 'I-5', (SELECT count(*) FROM daily) - (SELECT count(*) FROM (SELECT DISTINCT "ProductCode", "Date" FROM daily))
  UNION ALL SELECT 'I-6', (SELECT count(*) FROM daily WHERE "Barcode" IS NULL OR "Barcode" LIKE 'H%')
  UNION ALL SELECT 'I-8', (SELECT ((SELECT sum(qty) FROM lines WHERE NOT is_return)
    <> (SELECT sum("SalesQty") FROM daily))::INTEGER)
  UNION ALL SELECT 'I-9', (SELECT ((SELECT sum(promo_qty) FROM promo)
    <> (SELECT sum("PromoSalesQty") FROM daily))::INTEGER)"""


def _gate_report(gate_codes: list[str], silent: tuple[str, ...], counts: str) -> str:
    names = ", ".join(f"('{g}')" for g in gate_codes)
    return f"""SELECT gate, evaluated, CASE WHEN evaluated THEN coalesce(violations, 0)::BIGINT END AS violations
FROM (SELECT gate, gate NOT IN {silent} AS evaluated FROM (VALUES {names}) n(gate)) LEFT JOIN ({counts}) v USING (gate)"""


# Sources that break gates, as the steps that differ.
FAULTY = {
    "pos_detail": STEPS["pos_detail"][1]
    .replace("p_size = 29 AND l_linenumber = 7", "p_size IN (29, 7) AND l_linenumber = 7")
    .replace("p_size = 29 AND l_linenumber = 1", "p_size IN (29, 3) AND l_linenumber = 1"),
    "imex_detail": STEPS["imex_detail"][1]
    .replace("p_size = 29 AND l_linenumber = 7", "p_size IN (29, 11) AND l_linenumber = 7")
    .replace("CASE WHEN l_tax = 0.08", "CASE WHEN p_size = 19 AND l_linenumber = 5 THEN NULL WHEN l_tax = 0.08"),
    "pos_master": f"SELECT * FROM ({STEPS['pos_master'][1]}), range(CASE WHEN code % 64 = 1 THEN 2 ELSE 1 END)",
    "imex_master": f"SELECT * FROM ({STEPS['imex_master'][1]}), range(CASE WHEN code % 64 = 2 THEN 2 ELSE 1 END)",
    "bundle": f"""{STEPS['bundle'][1]} UNION ALL
      SELECT n_nationkey, (n_regionkey + 1) % 5 + 1 FROM nation WHERE n_nationkey = 7""",
    "promotion": f"{STEPS['promotion'][1]} UNION ALL {STEPS['promotion'][1]}",
}


def _digest(rows: str, product: str, day: str, columns) -> str:
    """Every cell of every day of a product, in one hash."""
    cells = ", ".join(f"""coalesce("{name}"::VARCHAR, '~')""" for name in sorted(columns))
    return f"""SELECT {product} AS product, count(*) AS days, md5(string_agg(row, '' ORDER BY day)) AS digest
    FROM (SELECT {product}, {day} AS day, md5(concat_ws('|', {cells})) AS row FROM {rows}) GROUP BY 1"""


def oracle_queries(gate_codes: list[str]) -> dict[str, str]:
    ledger = f"""SELECT product, business_date, discount, is_return, sum(qty) AS qty, count(*) AS line_count,
      bool_or(qty IS NULL) AS has_null_qty,
      min(CASE WHEN regular THEN price END) AS min_price, max(CASE WHEN regular THEN price END) AS max_price
    FROM (SELECT *, NOT is_return AND discount IS NULL AND qty > 0 AND amount IS NOT NULL AS regular,
        (((20000 * cents + whole_qty) // (2 * whole_qty))::DECIMAL(30,0) * 0.000001::DECIMAL(7,6))::{D} AS price
      FROM pos_dated) GROUP BY 1, 2, 3, 4"""
    imex_daily = """SELECT product, business_date, sum(net_qty) AS net_qty, bool_or(net_qty IS NULL) AS has_unknown_qty,
      bool_or(is_internal_receipt) AS has_receipt,
      min(raw_receipt_ts::DATE) FILTER (WHERE is_internal_receipt) AS first_receipt_date,
      min(receipt_candidate_ts) FILTER (WHERE is_internal_receipt) AS first_candidate_ts,
      bool_or(is_internal_receipt AND raw_receipt_ts IS NULL) AS any_missing_receipt,
      bool_or(is_internal_receipt AND raw_receipt_ts IS NOT NULL AND raw_receipt_ts::DATE <> business_date) AS any_receipt_mismatch,
      bool_or(is_internal_receipt AND raw_receipt_ts IS NOT NULL AND raw_receipt_ts = date_trunc('day', raw_receipt_ts))
        AS any_date_only_receipt
    FROM imex GROUP BY 1, 2"""
    audit_counts = """count(*) AS "ProductsInSALPoSDetails",
      count(*) FILTER (WHERE missing_from_master) AS "ProductsNotInProductMaster",
      count(*) FILTER (WHERE NOT missing_from_master AND missing_barcode) AS "ProductsWithMissingBarcode",
      count(DISTINCT CASE WHEN NOT missing_barcode THEN barcode END) AS "SourceBarcodeBeforePrefixRule",
      count(DISTINCT CASE WHEN has_h_prefix THEN barcode END) AS "HPrefixExcludedBarcodeCount",
      count(*) FILTER (WHERE has_h_prefix) AS "HPrefixExcludedProductCount",
      count(*) FILTER (WHERE NOT missing_from_master AND NOT missing_barcode AND NOT has_h_prefix)
        AS "RetailCandidateProductBeforeInactivity" """
    dropped = """SELECT count(*) FROM (SELECT DISTINCT product FROM imex WHERE product NOT IN (SELECT product FROM audit)) i
      JOIN product p ON p.product = i.product WHERE trim(p.barcode) <> '' AND p.barcode NOT LIKE 'H%'"""
    inactive_counts = """count(*) FILTER (WHERE NOT has_positive_sales) AS "InactiveNoPositiveSales",
      count(*) FILTER (WHERE max_open_stock <= 0) AS "InactiveNoPositiveOpenStock",
      count(*) FILTER (WHERE max_close_stock <= 0) AS "InactiveNoPositiveCloseStock",
      count(*) FILTER (WHERE NOT has_receipt) AS "InactiveNoReceipt",
      count(*) FILTER (WHERE has_untrusted_stock) AS "InactiveUntrustedStockKept",
      count(*) FILTER (WHERE is_long_term_inactive) AS "LongTermInactiveExcludedProductCount",
      count(DISTINCT CASE WHEN is_long_term_inactive THEN barcode END) AS "LongTermInactiveExcludedBarcodeCount" """
    metadata = f"""SELECT window_end AS "LatestAvailableSourceDate", NULL::DATE AS "LatestConfirmedCompleteDate",
      {CUTOFF} AS "SalesDataCutoffDate", window_start AS "DataStartDate", window_end AS "DataEndDate",
      24 AS "InactivityWindowMonths", {INACTIVE_FROM} AS "InactivityWindowStartDate", a.*,
      ({dropped}) AS "PosOnlyRuleDroppedStockedProductCount", e.*,
      (SELECT count(DISTINCT barcode) FROM target) AS "RetailBarcodeBeforeTestMode",
      (SELECT count(*) FROM target) AS "FinalExportProductCount",
      (SELECT count(DISTINCT barcode) FROM target) AS "ExportedBarcodeCount",
      (SELECT count(*) FROM (SELECT barcode FROM target GROUP BY 1 HAVING count(*) > 1)) AS "BarcodeSharedByMultipleProductCode",
      (SELECT count(*) FROM price WHERE distinct_unit_prices > 1) AS "PriceConflictSkuDayCount",
      NULL::INTEGER AS "TestModeMaxBarcodes"
    FROM win, (SELECT {audit_counts} FROM audit) a, (SELECT {inactive_counts} FROM evidence) e"""
    sql = {
        "pos_ledger": ("pos_dated", ledger),
        "pos_daily": ("pos_daily", "SELECT * FROM pos_daily"),
        "store_activity_days": ("activity", "SELECT * FROM activity"),
        "imex_ledger": ("imex", "SELECT * FROM imex"),
        "imex_ledger_in_progress": ("imex_progress", "SELECT * FROM imex_progress"),
        "imex_daily": ("imex", imex_daily),
        "store_identity": (
            "",
            "SELECT n_name AS location_code, n_name AS location_name FROM nation WHERE n_nationkey = 1",
        ),
        "group_path": ("group_path", "SELECT * FROM group_path"),
        "brand_names": ("brand", "SELECT * FROM brand"),
        "population_audit": ("audit", f"SELECT {audit_counts} FROM audit"),
        "retail_candidates": (
            "candidate product",
            """SELECT c.product, c.barcode, false AS missing_from_master, false AS missing_barcode, false AS has_h_prefix,
              p.product_name, p.group_code, p.brand_code, p.quantitative, p.packing_size
            FROM candidate c JOIN product p ON p.product = c.product""",
        ),
        "pos_only_dropped": (
            "imex audit product",
            f'SELECT ({dropped}) AS "PosOnlyRuleDroppedStockedProductCount"',
        ),
        "export_window": ("win", "SELECT window_start, window_end FROM win"),
        "inactivity_evidence": ("evidence", "SELECT * FROM evidence"),
        "inactivity_audit": ("evidence", f"SELECT {inactive_counts} FROM evidence"),
        "target_products": ("target", "SELECT * FROM target"),
        "barcode_sample_size": (
            "target",
            "SELECT count(*)::BIGINT AS barcodes FROM (SELECT DISTINCT barcode FROM target LIMIT 50)",
        ),
        "barcode_sample_members": (
            "target",
            """SELECT count(*)::BIGINT AS barcodes, 0::BIGINT AS products_left_out, 0::BIGINT AS products_too_many
            FROM (SELECT DISTINCT barcode FROM target LIMIT 50)""",
        ),
        "stock_seed": ("seed", "SELECT * FROM seed"),
        "pos_lines": ("lines", "SELECT product, business_date, qty, amount, discount, is_return FROM lines"),
        "scan_totals": (
            "lines",
            """SELECT sum(qty) FILTER (WHERE NOT is_return) AS sale_qty, sum(qty) FILTER (WHERE is_return) AS return_qty
            FROM lines""",
        ),
        "daily_sales": ("sales", "SELECT * FROM sales"),
        "daily_price": (
            "price",
            "SELECT product, business_date, price, distinct_unit_prices > 1 AS is_conflict FROM price",
        ),
        "price_conflicts": (
            "price",
            "SELECT product, business_date, distinct_unit_prices FROM price WHERE distinct_unit_prices > 1",
        ),
        "discount_resolution": ("resolution", "SELECT * FROM resolution"),
        "discount_audit": (
            "resolution",
            """SELECT count(*) FILTER (WHERE NOT bundle_found) AS "DiscountMappingMissing",
              count(*) FILTER (WHERE bundle_found AND NOT promotion_found) AS "DiscountPromotionMissing",
              count(*) FILTER (WHERE promotion_found AND promotion_type NOT IN (2, 7)) AS "DiscountTypeNotEligible"
            FROM resolution""",
        ),
        "daily_promo": ("promo", "SELECT * FROM promo"),
        "daily_movement": ("movement", "SELECT * FROM movement"),
        "store_calendar": ("calendar", "SELECT * FROM calendar"),
        "projected_rows": (
            "target calendar",
            "SELECT (SELECT count(*) FROM target) * (SELECT count(*) FROM calendar) AS projected_rows",
        ),
        "stock_event_days": (
            "stock movement sales",
            """SELECT s.product, s.business_date, s.open_stock, s.close_stock, s.daily_net_movement, s.stock_status
            FROM stock s JOIN movement m ON m.product = s.product AND m.business_date = s.business_date""",
        ),
        "stock_by_product": (
            "stock",
            """SELECT product, count(*) AS days, sum(open_stock) AS open_stock, sum(close_stock) AS close_stock,
              sum(daily_net_movement) AS net_movement,
              count(*) FILTER (WHERE stock_status = 'VALID') AS valid_days,
              count(*) FILTER (WHERE stock_status = 'NEGATIVE') AS negative_days,
              count(*) FILTER (WHERE stock_status = 'UNKNOWN_QUANTITY') AS unknown_days FROM stock GROUP BY 1""",
        ),
        "stock_continuity": (
            "stock",
            """SELECT count(previous) AS compared_days,
              count(*) FILTER (WHERE abs(open_stock - previous) > 0.000001) AS breaks
            FROM (SELECT open_stock, lag(close_stock) OVER (PARTITION BY product ORDER BY business_date) AS previous
              FROM stock)""",
        ),
        "first_receipt": ("receipt", "SELECT * FROM receipt"),
        "daily_source_by_product": (
            "daily",
            f'SELECT "ProductCode", {_ATTRIBUTES}, min("Date") AS first_date, max("Date") AS last_date, {_SUMMARY} '
            f'FROM daily GROUP BY "ProductCode", {_ATTRIBUTES}',
        ),
        "daily_source_by_date": (
            "daily",
            f'SELECT "Date", "HasSalesRecord", {_SUMMARY} FROM daily GROUP BY "Date", "HasSalesRecord"',
        ),
        "daily_source_event_days": (
            "daily",
            """SELECT * FROM daily WHERE "SalesQty" > 0 OR "PromoSalesQty" > 0 OR "Price" IS NOT NULL
              OR "FirstReceiptDateTime" IS NOT NULL OR "OpenStock" <> "CloseStock" """,
        ),
        "daily_source_digest": ("daily", _digest("daily", '"ProductCode"', '"Date"', DAILY_COLUMNS)),
        "stock_digest": (
            "stock",
            _digest(
                "stock",
                "product",
                "business_date",
                ("product", "business_date", "open_stock", "close_stock", "daily_net_movement", "stock_status"),
            ),
        ),
        "metadata": ("win audit imex product evidence target price", metadata),
        "gate_report": (
            f"{_EARLY_READS} stock daily sales promo",
            _gate_report(gate_codes, _SILENT, f"{_EARLY_GATES} UNION ALL {_RESULT_GATES}"),
        ),
    }
    texts = "SELECT count(*) FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size = 19 AND l_linenumber = 5"
    faulty = _gate_report(gate_codes, _SILENT + _ON_RESULT, f"{_EARLY_GATES} UNION ALL SELECT 'S5v', ({texts})")
    return {name: with_steps(reads, text) for name, (reads, text) in sql.items()} | {
        "gate_report_faulty": with_steps(_EARLY_READS, faulty, FAULTY)
    }
