"""Independent DuckDB SQL for every catalogued query (the correctness oracle).

The SQL is written from the warehouse semantics, not generated from the Spark plans.
Shared layers are CTEs; ``build(select, ...)`` prepends the CTEs a query needs in
dependency order. Tables ``lineitem orders customer nation region part`` are views
over the same parquet files the Spark side reads.
"""

from __future__ import annotations

from shelfmart.config import PIPELINE_VERSION
from shelfmart.plans.warehouse import DEMO_RUN
from shelfmart.sources.fixture import BATCH_MODULUS, BATCH_TIMES, VANISHING_RESIDUE

RUN_ID = DEMO_RUN.run_id
RUN_TS = DEMO_RUN.ingested_at
SOURCE_FILE = DEMO_RUN.source_file

SRC_COLS = ['"Row ID"', '"Order ID"', '"Order Date"', '"Ship Date"', '"Ship Mode"', '"Customer ID"',
            '"Customer Name"', '"Segment"', '"Country"', '"City"', '"State"', '"Postal Code"', '"Region"',
            '"Product ID"', '"Category"', '"Sub-Category"', '"Product Name"', '"Sales"', '"Quantity"',
            '"Discount"', '"Profit"']


def _dedup(source: str) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in SRC_COLS[1:])
    return f"""SELECT * EXCLUDE (_rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY "Row ID" ORDER BY {order}) AS _rn FROM {source}
    ) WHERE _rn = 1"""


def _silver_select(source: str, where: str = "", run_id: str = RUN_ID, ts: str = RUN_TS,
                   source_file: str = SOURCE_FILE) -> str:
    return f"""SELECT CAST("Row ID" AS BIGINT) AS row_id, "Order ID" AS order_id,
      CAST(strptime("Order Date", '%m/%d/%Y') AS DATE) AS order_date,
      CAST(strptime("Ship Date", '%m/%d/%Y') AS DATE) AS ship_date,
      "Ship Mode" AS ship_mode, "Customer ID" AS customer_id, trim("Customer Name") AS customer_name,
      "Segment" AS segment, "Country" AS country, "City" AS city, "State" AS state,
      coalesce("Postal Code", '00000') AS postal_code, "Region" AS region, "Product ID" AS product_id,
      "Category" AS category, "Sub-Category" AS sub_category, "Product Name" AS product_name,
      CAST("Sales" AS DECIMAL(18,4)) AS sales, CAST("Quantity" AS INTEGER) AS quantity,
      CAST("Discount" AS DECIMAL(18,4)) AS discount, CAST("Profit" AS DECIMAL(18,4)) AS profit,
      TIMESTAMP '{ts}' AS ingested_at, '{run_id}' AS run_id, '{source_file}' AS source_file,
      '{PIPELINE_VERSION}' AS pipeline_version
    FROM {source} WHERE "Order ID" IS NOT NULL {where}"""


def silver_select(source: str, where: str = "", **kw) -> str:
    return _silver_select(source, where, **kw)


def dedup(source: str) -> str:
    return _dedup(source)


def _latest(source: str, key: str, attrs: str) -> str:
    return f"""SELECT {key}, {attrs} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ingested_at DESC, row_id DESC) AS _rn
      FROM {source}) WHERE _rn = 1"""


def _batch(k: int) -> str:
    seg = f"CASE WHEN CAST(substr(customer_id, 3) AS BIGINT) % {BATCH_MODULUS} = {k} THEN segment || '/{k}' ELSE segment END"
    where = (f"WHERE CAST(substr(customer_id, 3) AS BIGINT) % {BATCH_MODULUS} <> {VANISHING_RESIDUE}"
             if k == 3 else "")
    return f"""SELECT {k} AS batch, customer_id, customer_name, {seg} AS segment,
      TIMESTAMP '{BATCH_TIMES[k - 1]}' AS ingested_at FROM dim_customers {where}"""


def _scd2_step(prev: str, snap: str) -> str:
    """History after merging snapshot ``snap`` into history ``prev``."""
    return f"""
      SELECT h.customer_key, h.customer_id, h.customer_name, h.segment, h.valid_from,
             CASE WHEN s.customer_id IS NOT NULL AND h.is_current
                       AND (h.customer_name, h.segment) IS DISTINCT FROM (s.customer_name, s.segment)
                  THEN s.ingested_at ELSE h.valid_to END AS valid_to,
             CASE WHEN s.customer_id IS NOT NULL AND h.is_current
                       AND (h.customer_name, h.segment) IS DISTINCT FROM (s.customer_name, s.segment)
                  THEN FALSE ELSE h.is_current END AS is_current
      FROM {prev} h LEFT JOIN {snap} s ON h.customer_id = s.customer_id
      UNION ALL
      SELECT (SELECT coalesce(max(customer_key), 0) FROM {prev})
               + row_number() OVER (ORDER BY s.customer_id NULLS LAST) AS customer_key,
             s.customer_id, s.customer_name, s.segment, s.ingested_at AS valid_from,
             CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
      FROM {snap} s LEFT JOIN (SELECT * FROM {prev} WHERE is_current) c ON s.customer_id = c.customer_id
      WHERE c.customer_id IS NULL
         OR (c.customer_name, c.segment) IS DISTINCT FROM (s.customer_name, s.segment)"""


CTES: dict[str, tuple[list[str], str]] = {
    "src_base": ([], """
      SELECT l_orderkey * 10 + l_linenumber AS rid, l_orderkey, l_partkey, l_shipdate, o_orderdate,
             o_orderpriority, c_custkey, c_name, c_mktsegment, n_name, r_name, p_name, p_brand, p_type,
             CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS sales,
             CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
               - CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS INTEGER) AS profit,
             CAST(l_quantity AS INTEGER) AS qty, CAST(l_discount AS DECIMAL(4,2)) AS disc
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           JOIN part ON l_partkey = p_partkey"""),
    "src": (["src_base"], """
      SELECT CAST(rid AS VARCHAR) AS "Row ID",
             CASE WHEN rid % 1009 = 0 THEN NULL ELSE 'O-' || CAST(l_orderkey AS VARCHAR) END AS "Order ID",
             strftime(CAST(o_orderdate AS DATE), '%-m/%-d/%Y') AS "Order Date",
             strftime(CAST(l_shipdate AS DATE), '%-m/%-d/%Y') AS "Ship Date",
             o_orderpriority AS "Ship Mode", 'C-' || CAST(c_custkey AS VARCHAR) AS "Customer ID",
             ' ' || c_name || '  ' AS "Customer Name", c_mktsegment AS "Segment", n_name AS "Country",
             'CITY_' || CAST(c_custkey % 100 AS VARCHAR) AS "City",
             'STATE_' || CAST(c_custkey % 10 AS VARCHAR) AS "State",
             CASE WHEN c_custkey % 50 = 0 THEN NULL
                  ELSE lpad(CAST(c_custkey % 1000 AS VARCHAR), 5, '0') END AS "Postal Code",
             r_name AS "Region", 'P-' || CAST(l_partkey AS VARCHAR) AS "Product ID",
             p_type AS "Category", p_brand AS "Sub-Category", p_name AS "Product Name",
             CAST(CASE WHEN rid % 983 = 0 THEN -sales ELSE sales END AS VARCHAR) AS "Sales",
             CAST(CASE WHEN rid % 997 = 0 THEN -qty ELSE qty END AS VARCHAR) AS "Quantity",
             CAST(CASE WHEN rid % 991 = 0 THEN CAST(1.5 AS DECIMAL(4,2)) ELSE disc END AS VARCHAR) AS "Discount",
             CAST(profit AS VARCHAR) AS "Profit"
      FROM src_base"""),
    "bronze": (["src"], _dedup("src")),
    "silver": (["bronze"], _silver_select("bronze")),
    "dim_customers": (["silver"], f"""
      SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS LAST) AS BIGINT) AS customer_key,
             customer_id, customer_name, segment, ingested_at
      FROM ({_latest('silver', 'customer_id', 'customer_name, segment, ingested_at')})"""),
    "dim_products": (["silver"], f"""
      SELECT CAST(row_number() OVER (ORDER BY product_id NULLS LAST) AS BIGINT) AS product_key,
             product_id, product_name, category, sub_category, ingested_at
      FROM ({_latest('silver', 'product_id', 'product_name, category, sub_category, ingested_at')})"""),
    "dim_location": (["silver"], """
      SELECT CAST(row_number() OVER (ORDER BY country NULLS LAST, region NULLS LAST, state NULLS LAST,
                                     city NULLS LAST, postal_code NULLS LAST) AS BIGINT) AS location_id,
             country, region, state, city, postal_code
      FROM (SELECT DISTINCT country, region, state, city, postal_code FROM silver)"""),
    "dim_date": (["silver"], """
      SELECT date_key, CAST(year(date_key) AS INTEGER) AS year, CAST(month(date_key) AS INTEGER) AS month,
             CAST(day(date_key) AS INTEGER) AS day, CAST(quarter(date_key) AS INTEGER) AS quarter,
             dayname(date_key) AS day_name, monthname(date_key) AS month_name,
             dayofweek(date_key) IN (0, 6) AS is_weekend
      FROM (SELECT order_date AS date_key FROM silver UNION SELECT ship_date FROM silver)
      WHERE date_key IS NOT NULL"""),
    "scd2": (["dim_customers"], """
      SELECT customer_key, customer_id, customer_name, segment, ingested_at AS valid_from,
             CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM dim_customers"""),
    "scd2_current": (["scd2"], """
      SELECT customer_id, customer_key AS scd2_customer_key FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from DESC, customer_key DESC) AS _rn
        FROM scd2 WHERE is_current) WHERE _rn = 1"""),
    "fact": (["silver", "dim_customers", "dim_products", "dim_location", "scd2_current"], """
      SELECT s.row_id, s.order_id, s.order_date, s.ship_date, c.customer_key, k.scd2_customer_key,
             p.product_key, l.location_id, s.ship_mode, s.sales, s.quantity, s.discount, s.profit,
             s.run_id, s.ingested_at
      FROM silver s JOIN dim_customers c ON s.customer_id = c.customer_id
      LEFT JOIN scd2_current k ON s.customer_id = k.customer_id
      JOIN dim_products p ON s.product_id = p.product_id
      LEFT JOIN dim_location l ON s.country = l.country AND s.region = l.region AND s.state = l.state
                              AND s.city = l.city AND s.postal_code = l.postal_code"""),
    "daily": (["fact"], """
      SELECT order_date, customer_key, product_key, location_id, sum(sales) AS sales,
             CAST(sum(quantity) AS BIGINT) AS quantity, sum(profit) AS profit, count(*) AS transaction_count
      FROM fact GROUP BY order_date, customer_key, product_key, location_id"""),
    "monthly": (["daily"], """
      SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_key, customer_key, product_key, location_id,
             sum(sales) AS sales, CAST(sum(quantity) AS BIGINT) AS quantity, sum(profit) AS profit,
             CAST(sum(transaction_count) AS BIGINT) AS transaction_count
      FROM daily GROUP BY 1, customer_key, product_key, location_id"""),
    "fulfillment": (["silver"], """
      SELECT order_id, min(order_date) AS order_date, max(ship_date) AS ship_date,
             CAST(datediff('day', min(order_date), max(ship_date)) AS INTEGER) AS days_to_ship,
             count(*) AS line_count, sum(sales) AS sales, CAST(sum(quantity) AS BIGINT) AS quantity,
             sum(profit) AS profit
      FROM silver GROUP BY order_id"""),
    # ---- scenario inputs: previous stored snapshot and the incoming delivery ----
    "previous": (["src"], _dedup('(SELECT * FROM src WHERE CAST("Row ID" AS BIGINT) % 13 <> 0)')),
    "incoming": (["src"], """
      SELECT * REPLACE (CASE WHEN CAST("Row ID" AS BIGINT) % 7 = 0
                             THEN CAST(CAST("Quantity" AS INTEGER) + 1 AS VARCHAR) ELSE "Quantity" END AS "Quantity")
      FROM src WHERE CAST("Row ID" AS BIGINT) % 10 <> 3"""),
    "incoming_dedup": (["incoming"], _dedup("incoming")),
    "batches": (["dim_customers"], " UNION ALL ".join(f"({_batch(k)})" for k in (1, 2, 3))),
    "b1": (["batches"], "SELECT * FROM batches WHERE batch = 1"),
    "b2": (["batches"], "SELECT * FROM batches WHERE batch = 2"),
    "b3": (["batches"], "SELECT * FROM batches WHERE batch = 3"),
    "h1": (["b1"], """
      SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS LAST) AS BIGINT) AS customer_key,
             customer_id, customer_name, segment, ingested_at AS valid_from,
             CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM b1"""),
    "h2": (["h1", "b2"], _scd2_step("h1", "b2")),
    "h3": (["h2", "b3"], _scd2_step("h2", "b3")),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def build(select: str, *needs: str) -> str:
    names = _order(needs)
    if not names:
        return select.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in names)
    sel = select.strip()
    if sel[:5].upper() == "WITH ":
        return f"WITH {body},\n{sel[5:]}"
    return f"WITH {body}\n{sel}"
