"""Silver: profile, type, clean, filter, quarantine and reconcile against bronze."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmart.config import (
    DEFAULT_POSTAL_CODE, MONEY_TYPE, PIPELINE_VERSION, PROFILE_METRICS, REASON_DISCOUNT,
    REASON_QUANTITY, REASON_SALES, SOURCE_COLUMNS, SOURCE_DATE_FORMAT, SOURCE_FILE, SOURCE_KEY,
)
from shelfmart.errors import KeyIntegrityError, ReconciliationError
from shelfmart.functions.columns import col, count_if, parse_source_date, side_by_side
from shelfmart.operators.bronze import CHANGE, DELETE, LIVE, ORDER_DAY, ORDER_YEAR


@dataclass(frozen=True)
class RunContext:
    """Parameters injected into a build; no operator reads the clock."""
    run_id: str
    ingested_at: str          # 'yyyy-MM-dd HH:mm:ss', session-time-zone free
    source_file: str
    start_date: str | None = None
    end_date: str | None = None


# ---- V1/V2 profile -------------------------------------------------------------

def profile(bronze: DataFrame, key: str = SOURCE_KEY) -> DataFrame:
    """One row: total_rows, null_order_ids, duplicate_row_ids (null keys count as duplicates)."""
    return bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(col("Order ID").isNull()).alias("null_order_ids"),
        (F.count(F.lit(1)) - F.countDistinct(col(key))).alias("duplicate_row_ids"),
    )


def profile_long(metrics: DataFrame, run_id: str) -> DataFrame:
    """Unpivot the profile to (run_id, metric_name, metric_value)."""
    return (metrics.unpivot([], PROFILE_METRICS, "metric_name", "metric_value")
                   .select(F.lit(run_id).alias("run_id"), "metric_name",
                           F.col("metric_value").cast("long").alias("metric_value")))


# ---- V8-V10 row selection shared by silver, the source-window count and reconcile -----

def _day(df: DataFrame, lenient: bool = False) -> Column:
    if ORDER_DAY in df.columns:
        return F.col(ORDER_DAY)
    return F.try_to_date(col("Order Date"), SOURCE_DATE_FORMAT) if lenient else parse_source_date(col("Order Date"))


def _window_condition(df: DataFrame, start: str | None, end: str | None, lenient: bool = False) -> Column:
    return in_window(_day(df, lenient), start, end)


def _window_filter(df: DataFrame, start: str | None, end: str | None, lenient: bool = False) -> DataFrame:
    """Only set bounds become predicates; a null date drops once any bound is set. A table
    stored with its typed order day is pruned by year partition and by day statistics."""
    typed_day = ORDER_DAY in df.columns
    day = _day(df, lenient)
    for bound, at_least in ((start, True), (end, False)):
        if bound is None:
            continue
        limit = F.lit(bound).cast("date")
        df = df.filter(day >= limit if at_least else day <= limit)
        if typed_day and ORDER_YEAR in df.columns:
            year = F.lit(int(bound[:4]))
            df = df.filter(F.col(ORDER_YEAR) >= year if at_least else F.col(ORDER_YEAR) <= year)
    return df


def in_window(day: Column, start: str | None, end: str | None) -> Column:
    """The window's condition on a typed date (null for a null date once a bound is set)."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (day >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (day <= F.lit(end).cast("date"))
    return inside


def in_days(extract: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Landed rows with an order date in the window; a date that cannot be read is in none."""
    return _window_filter(extract, start, end, lenient=True)


def selectable(bronze: DataFrame, run_id: str | None = None, deletions: DataFrame | None = None,
               start: str | None = None, end: str | None = None,
               key: str = SOURCE_KEY, lenient: bool = False) -> DataFrame:
    """Bronze rows that silver keeps: order id present, not deleted in this run, in window.

    A stored classified stream (``bronze.changes``) marks the rows its load deleted itself;
    the log of deletions is needed for other forms of bronze only."""
    df = bronze.filter(col("Order ID").isNotNull())
    if CHANGE in bronze.columns:
        df = df.filter(F.col(LIVE) & (F.col(CHANGE) != DELETE))
    if deletions is not None and run_id is not None:
        gone = deletions.filter(F.col("run_id") == F.lit(run_id)).select(F.col("row_id").alias("_gone"))
        df = df.join(gone, col(key).cast("string") == F.col("_gone"), "left_anti")
    return _window_filter(df, start, end, lenient)


def window_count(bronze: DataFrame, run_id: str | None = None, deletions: DataFrame | None = None,
                 start: str | None = None, end: str | None = None, lenient: bool = False) -> DataFrame:
    """Rows of bronze in the requested window (one row, ``source_rows``)."""
    return selectable(bronze, run_id, deletions, start, end, lenient=lenient).agg(
        F.count(F.lit(1)).alias("source_rows"))


# ---- V3-V12 the typed table ------------------------------------------------------------

def _cells(lenient: bool) -> dict[str, Column]:
    """The typed columns that a source text can fail to give, by source column."""
    cast = (lambda c, t: col(c).try_cast(t)) if lenient else (lambda c, t: col(c).cast(t))
    day = (lambda c: F.try_to_date(col(c), SOURCE_DATE_FORMAT)) if lenient else (lambda c: parse_source_date(col(c)))
    return {"Row ID": cast("Row ID", "long"), "Order Date": day("Order Date"), "Ship Date": day("Ship Date"),
            "Sales": cast("Sales", MONEY_TYPE), "Quantity": cast("Quantity", "int"),
            "Discount": cast("Discount", MONEY_TYPE), "Profit": cast("Profit", MONEY_TYPE)}


def typed(bronze_rows: DataFrame, ctx: RunContext, lenient: bool = False) -> DataFrame:
    """Rename, cast and trim the 21 text columns and add the 4 audit columns.

    Casts are strict (ANSI): a non-numeric quantity fails the build instead of
    silently becoming null. ``lenient`` is for rows whose casts are known to succeed
    (``route_bad_values``). Money stays an exact decimal. The source file is the file the
    row was read from, if the rows name it, else the run's.
    """
    cell = _cells(lenient)
    read_from = F.col(SOURCE_FILE) if SOURCE_FILE in bronze_rows.columns else F.lit(ctx.source_file)
    return bronze_rows.select(
        cell["Row ID"].alias("row_id"),
        col("Order ID").alias("order_id"),
        cell["Order Date"].alias("order_date"),
        cell["Ship Date"].alias("ship_date"),
        col("Ship Mode").alias("ship_mode"),
        col("Customer ID").alias("customer_id"),
        F.trim(col("Customer Name")).alias("customer_name"),
        col("Segment").alias("segment"),
        col("Country").alias("country"),
        col("City").alias("city"),
        col("State").alias("state"),
        F.coalesce(col("Postal Code").cast("string"), F.lit(DEFAULT_POSTAL_CODE)).alias("postal_code"),
        col("Region").alias("region"),
        col("Product ID").alias("product_id"),
        col("Category").alias("category"),
        col("Sub-Category").alias("sub_category"),
        col("Product Name").alias("product_name"),
        cell["Sales"].alias("sales"),
        cell["Quantity"].alias("quantity"),
        cell["Discount"].alias("discount"),
        cell["Profit"].alias("profit"),
        F.lit(ctx.ingested_at).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(ctx.run_id).alias("run_id"),
        read_from.alias("source_file"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
    )


def bad_columns() -> Column:
    """Source columns (sorted, comma-joined) whose text is there but is no value of the column's
    type; empty for a row that can be typed."""
    return F.array_join(F.array_compact(F.array(*[
        F.when(col(name).isNotNull() & cell.isNull(), F.lit(name)) for name, cell in sorted(_cells(True).items())])), ", ")


def route_bad_values(bronze: DataFrame, ctx: RunContext, deletions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """V4 that keeps the run going: (silver rows, rejected rows).

    A row with a value that cannot be cast is rejected as it was delivered, with
    ``failed_columns`` and the audit columns; all other rows make silver as ``clean`` does.
    A row whose order date cannot be read is in no window, so every window rejects it.
    Every selectable row of the window is on exactly one side.
    """
    rows = selectable(bronze, ctx.run_id, deletions)
    marked = rows.withColumn("failed_columns", bad_columns())
    good = _window_filter(marked.filter(F.col("failed_columns") == ""), ctx.start_date, ctx.end_date, lenient=True)
    no_day = col("Order Date").isNotNull() & _cells(True)["Order Date"].isNull()
    held = _window_condition(rows, ctx.start_date, ctx.end_date, lenient=True) | no_day
    names = [c for c in SOURCE_COLUMNS if c in bronze.columns]
    rejected = marked.filter((F.col("failed_columns") != "") & F.coalesce(held, F.lit(False))).select(
        *[col(c) for c in names], "failed_columns", F.lit(ctx.run_id).alias("run_id"),
        F.lit(ctx.ingested_at).cast("timestamp_ntz").alias("rejected_at"))
    return typed(good, ctx, lenient=True), rejected


def reconcile_routed(bronze: DataFrame, silver: DataFrame, rejected: DataFrame, ctx: RunContext,
                     deletions: DataFrame | None = None) -> DataFrame:
    """V13 for routed casts: bronze rows of the window = silver + rejected rows (one row)."""
    rows = selectable(bronze, ctx.run_id, deletions)
    no_day = col("Order Date").isNotNull() & _cells(True)["Order Date"].isNull()
    held = F.coalesce(_window_condition(rows, ctx.start_date, ctx.end_date, lenient=True) | no_day, F.lit(False))
    return side_by_side(rows.filter(held).agg(F.count(F.lit(1)).alias("bronze_rows")),
                        silver.agg(F.count(F.lit(1)).alias("silver_rows")),
                        rejected.agg(F.count(F.lit(1)).alias("rejected_rows"))).withColumn(
        "passed", F.col("bronze_rows") == F.col("silver_rows") + F.col("rejected_rows"))


def clean(bronze: DataFrame, ctx: RunContext, deletions: DataFrame | None = None,
          windowed: bool = True) -> DataFrame:
    """The silver table: V8 not-null, V9 soft deletes of this run, V10 window, then V3-V12."""
    start, end = (ctx.start_date, ctx.end_date) if windowed else (None, None)
    return typed(selectable(bronze, ctx.run_id, deletions, start, end), ctx)


# ---- V11 quarantine ----------------------------------------------------------------

def quarantine_reason() -> Column:
    """First matching reason; a NULL measure never matches."""
    return (F.when(F.col("quantity") <= 0, REASON_QUANTITY)
             .when(~F.col("discount").between(0, 1), REASON_DISCOUNT)
             .when(F.col("sales") < 0, REASON_SALES))


def quarantine(silver: DataFrame) -> DataFrame:
    """Copies of invalid silver rows with their reason (rows stay in silver)."""
    return silver.withColumn("reason", quarantine_reason()).filter(F.col("reason").isNotNull())


def quarantine_summary(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


# ---- V13 reconcile, V15 keys -----------------------------------------------------------

def reconcile_bronze_silver(bronze: DataFrame, silver: DataFrame, ctx: RunContext,
                            deletions: DataFrame | None = None, windowed: bool = True) -> DataFrame:
    """(bronze_rows, silver_rows, passed) from two one-row aggregates."""
    start, end = (ctx.start_date, ctx.end_date) if windowed else (None, None)
    b = window_count(bronze, ctx.run_id, deletions, start, end).withColumnRenamed("source_rows", "bronze_rows")
    s = silver.agg(F.count(F.lit(1)).alias("silver_rows"))
    return side_by_side(b, s).withColumn("passed", F.col("bronze_rows") == F.col("silver_rows"))


def assert_reconciled(recon: DataFrame) -> tuple[int, int]:
    r = recon.first()
    if not r["passed"]:
        raise ReconciliationError(
            f"silver holds {r['silver_rows']} rows where bronze has {r['bronze_rows']} to keep")
    return r["bronze_rows"], r["silver_rows"]


def lost_by_replay(bronze: DataFrame, before: DataFrame, after: DataFrame, ctx: RunContext,
                   routed: bool = False) -> DataFrame:
    """V13 for a replayed window, over all rows: bronze rows that silver held before, at whatever
    date, or that lie in the window, and that silver holds no more (one row, ``lost_rows``).
    Rows that are set aside for a bad value (``routed``) are not owed."""
    kept = selectable(bronze, ctx.run_id)
    rows = (kept.filter(bad_columns() == "") if routed else kept).select(
        col(SOURCE_KEY).try_cast("long").alias("row_id"),
        F.coalesce(_window_condition(bronze, ctx.start_date, ctx.end_date, lenient=True), F.lit(False)).alias("inside"))
    owed = rows.filter("inside").select("row_id").unionByName(
        rows.filter("not inside").select("row_id").join(before.select("row_id"), "row_id", "left_semi"))
    return owed.join(after.select("row_id"), "row_id", "left_anti").agg(F.count(F.lit(1)).alias("lost_rows"))


def key_violations(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """One row per (table, key): null key rows and keys held by more than one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
        count_if(~any_null & (F.col("_n") > 1)).alias("duplicate_keys"),
    )


def assert_keys(violations: DataFrame) -> None:
    bad = violations.filter((F.col("null_keys") > 0) | (F.col("duplicate_keys") > 0)).collect()
    if bad:
        raise KeyIntegrityError("; ".join(
            f"{r['table_name']}({r['key_columns']}): {r['null_keys']} null, {r['duplicate_keys']} duplicated"
            for r in bad))
