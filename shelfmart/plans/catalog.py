"""Query catalogue: name -> Spark plan over the driver tables, and its DuckDB oracle.

Every entry reads the tables under ``sf_dir`` (through the source adapter) and runs
over all of their rows. Exact decimals are exposed as doubles at the very end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmart.functions.columns import decimals_to_double
from shelfmart.operators import bi
from shelfmart.plans.oracle import build
from shelfmart.plans.warehouse import Warehouse, shared

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
BODIES: dict[str, Callable[[Warehouse], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def run_on(name: str, w: Warehouse) -> DataFrame:
    """Run a catalogue query against a given build."""
    return decimals_to_double(BODIES[name](w))


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(fn(shared(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        BODIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def _dbl(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


SILVER_OUT = f"SELECT * REPLACE ({_dbl('sales', 'discount', 'profit')}) FROM silver"
FACT_OUT = f"SELECT * REPLACE ({_dbl('sales', 'discount', 'profit')}) FROM fact"

# ---- layers ------------------------------------------------------------------------


@query("dedup_latest", build("SELECT * FROM bronze", "bronze"))
def dedup_latest(w: Warehouse) -> DataFrame:
    """The stored bronze snapshot, one row per Row ID."""
    return w.bronze


@query("silver_clean", build(SILVER_OUT, "silver"))
def silver_clean(w: Warehouse) -> DataFrame:
    """Typed, trimmed, defaulted silver rows with audit columns."""
    return w.silver


@query("parse_dates", build("""
    SELECT row_id, order_date, ship_date, CAST(year(order_date) AS INTEGER) AS order_year
    FROM silver""", "silver"))
def parse_dates(w: Warehouse) -> DataFrame:
    """V5: M/d/yyyy text parsed to dates (one- and two-digit parts)."""
    return w.silver.select("row_id", "order_date", "ship_date", F.year("order_date").alias("order_year"))


# ---- dimensions ------------------------------------------------------------------------


@query("dim_customers", build("SELECT * FROM dim_customers", "dim_customers"))
def dim_customers(w: Warehouse) -> DataFrame:
    """G1 + G3: SCD1 customers with dense keys."""
    return w.dim_customers


@query("dim_products", build("SELECT * FROM dim_products", "dim_products"))
def dim_products(w: Warehouse) -> DataFrame:
    """G2 + G3: SCD1 products with dense keys."""
    return w.dim_products


@query("dim_location", build("SELECT * FROM dim_location", "dim_location"))
def dim_location(w: Warehouse) -> DataFrame:
    """Distinct locations with dense keys."""
    return w.dim_location


@query("dim_date", build("SELECT * FROM dim_date", "dim_date"))
def dim_date(w: Warehouse) -> DataFrame:
    """G5 + G6: order and ship dates with calendar attributes and weekend flag."""
    return w.dim_date


# ---- facts and rollups ---------------------------------------------------------------------


@query("fact_sales", build(FACT_OUT, "fact"))
def fact_sales(w: Warehouse) -> DataFrame:
    """the sales fact with all surrogate keys."""
    return w.fact


@query("sales_daily", build(f"SELECT * REPLACE ({_dbl('sales', 'profit')}) FROM daily", "daily"))
def sales_daily(w: Warehouse) -> DataFrame:
    """daily rollup by date, customer, product and location."""
    return w.daily


@query("sales_monthly", build(f"SELECT * REPLACE ({_dbl('sales', 'profit')}) FROM monthly", "monthly"))
def sales_monthly(w: Warehouse) -> DataFrame:
    """monthly rollup re-aggregated from the daily rollup."""
    return w.monthly


@query("order_fulfillment", build(f"SELECT * REPLACE ({_dbl('sales', 'profit')}) FROM fulfillment",
                                  "fulfillment"))
def order_fulfillment(w: Warehouse) -> DataFrame:
    """F8: one row per order with lead time and totals."""
    return w.fulfillment


# ---- BI --------------------------------------------------------------------------------------


@query("sales_by_segment", build("""
    SELECT c.segment, count(f.order_id) AS num_orders,
           CAST(round(sum(f.sales), 2) AS DOUBLE) AS total_sales,
           round(CAST(sum(f.profit) AS DOUBLE) / count(f.profit), 2) AS avg_profit
    FROM fact f JOIN dim_customers c ON f.customer_key = c.customer_key
    GROUP BY c.segment ORDER BY total_sales DESC, c.segment""", "fact", "dim_customers"))
def sales_by_segment(w: Warehouse) -> DataFrame:
    """A1: lines, revenue and average profit per segment."""
    return bi.sales_by_segment(w.fact, w.dim_customers)


@query("sales_by_region_month", build("""
    SELECT l.region, d.year, d.month, d.month_name,
           CAST(round(sum(f.sales), 2) AS DOUBLE) AS total_sales,
           CAST(round(sum(f.profit), 2) AS DOUBLE) AS total_profit
    FROM fact f JOIN dim_location l ON f.location_id = l.location_id
         JOIN dim_date d ON f.order_date = d.date_key
    GROUP BY l.region, d.year, d.month, d.month_name
    ORDER BY d.year, d.month, l.region LIMIT 10""", "fact", "dim_location", "dim_date"))
def sales_by_region_month(w: Warehouse) -> DataFrame:
    """A2: first ten (year, month, region) cells (a top-k report)."""
    cells = w._layer("report/sales_by_region_month", lambda: bi.sales_by_region_month(w.fact, w.dim_location, w.dim_date))
    return cells.orderBy("year", "month", "region")


@query("top_products", build("""
    SELECT product_name, category, sub_category, num_sales, total_sales, total_profit, avg_profit_per_sale
    FROM (
      SELECT p.product_id, p.product_name, p.category, p.sub_category, count(f.order_id) AS num_sales,
             CAST(round(sum(f.sales), 2) AS DOUBLE) AS total_sales,
             CAST(round(sum(f.profit), 2) AS DOUBLE) AS total_profit,
             round(CAST(sum(f.profit) AS DOUBLE) / count(f.profit), 2) AS avg_profit_per_sale
      FROM fact f JOIN dim_products p ON f.product_key = p.product_key
      GROUP BY p.product_id, p.product_name, p.category, p.sub_category
      ORDER BY total_profit DESC, p.product_id LIMIT 10)""", "fact", "dim_products"))
def top_products(w: Warehouse) -> DataFrame:
    """A3: ten most profitable products (a top-k report)."""
    return bi.top_products(w.fact, w.dim_products)


@query("sales_by_region", build("""
    SELECT l.region, CAST(round(sum(f.sales), 2) AS DOUBLE) AS total_sales, count(*) AS lines
    FROM fact f JOIN dim_location l ON f.location_id = l.location_id
    GROUP BY l.region ORDER BY l.region""", "fact", "dim_location"))
def sales_by_region(w: Warehouse) -> DataFrame:
    """A4: region revenue summary, from its stored table."""
    return bi.sales_by_region(w.region_totals)


@query("sales_by_weekend", build("""
    SELECT d.is_weekend, count(*) AS lines, CAST(round(sum(f.sales), 2) AS DOUBLE) AS total_sales,
           CAST(round(sum(f.profit), 2) AS DOUBLE) AS total_profit
    FROM fact f JOIN dim_date d ON f.order_date = d.date_key
    GROUP BY d.is_weekend ORDER BY d.is_weekend""", "fact", "dim_date"))
def sales_by_weekend(w: Warehouse) -> DataFrame:
    """A5: weekday versus weekend revenue."""
    return bi.sales_by_weekend(w.fact, w.dim_date)


from shelfmart.plans import q_changes, q_gold, q_ingest, q_profile  # noqa: E402,F401  (register their entries)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
