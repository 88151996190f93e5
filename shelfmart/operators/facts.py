"""Gold facts: sales fact, rollups, order-fulfillment snapshot, referential integrity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmart.config import LOCATION_COLUMNS
from shelfmart.functions.columns import count_if, side_by_side

FACT_COLUMNS = ["row_id", "order_id", "order_date", "ship_date", "customer_key",
                "scd2_customer_key", "product_key", "location_id", "ship_mode", "sales",
                "quantity", "discount", "profit", "run_id", "ingested_at"]


def fact_sales(silver: DataFrame, customers: DataFrame, products: DataFrame,
               locations: DataFrame, scd2_current: DataFrame | None = None) -> DataFrame:
    """One row per silver row: inner customer and product lookups, left location and
    SCD2 lookups. The location key is a null-rejecting 5-column equi-join.

    The SCD2 key is looked up on the customer side first, so the fact is joined by
    ``customer_id`` once. The five location columns are looked up first, so that no later
    exchange carries them. No join is hinted: dimension sizes are known to AQE in bytes,
    which broadcasts the small ones and splits skewed shuffle joins."""
    keys = customers.select("customer_id", "customer_key")
    if scd2_current is not None:
        keys = keys.join(scd2_current, "customer_id", "left")
    else:
        keys = keys.withColumn("scd2_customer_key", F.lit(None).cast("long"))
    return (silver.join(locations, LOCATION_COLUMNS, "left").drop(*LOCATION_COLUMNS)
                  .join(keys, "customer_id")
                  .join(products.select("product_id", "product_key"), "product_id")
                  .select(*FACT_COLUMNS))


def with_order_year(fact: DataFrame) -> DataFrame:
    """Partition column for the year-partitioned sink (null dates -> default partition).

    Rows are sorted by (order_year, order_date) inside each task before the write: the
    writer needs the partition-column order anyway, and the date order makes Parquet
    row-group min/max statistics selective for date predicates (in place of indexes).
    No shuffle is added.
    """
    return (fact.withColumn("order_year", F.year("order_date"))
                .sortWithinPartitions("order_year", "order_date"))


def fact_sales_natural(silver: DataFrame, locations: DataFrame) -> DataFrame:
    """Notebook form: natural keys, only the location is looked up."""
    return silver.join(locations, LOCATION_COLUMNS, "left").select(
        "row_id", "order_id", "order_date", "ship_date", "customer_id", "product_id",
        "location_id", "ship_mode", "sales", "quantity", "discount", "profit")


def fact_scd2_asof(silver: DataFrame, history: DataFrame) -> DataFrame:
    """Customer version valid on each order date (valid_from <= d < valid_to), null if none is.

    A merge by time instead of a join of every row with all versions of its customer: rows
    and versions are laid out by customer and month, in the order of time, and the last
    version before a row is carried to it. A month starts with the versions that are valid
    when it does, which are looked up per customer and month, not per row. So a customer
    with many rows is split by months, and a row meets one version.

    Versions of one customer do not overlap. Rows without a customer or a date have none."""
    month = lambda c: F.trunc(c, "month")
    at = F.col("order_date").cast("timestamp_ntz")
    f = silver.select("row_id", "customer_id", "order_date", month("order_date").alias("_month"), at.alias("_at"))
    h = history.select(F.col("customer_id").alias("_cid"), F.struct(
        F.col("customer_key").alias("key"), F.col("valid_to").alias("until")).alias("_version"), "valid_from", "valid_to")
    months = f.filter(F.col("customer_id").isNotNull() & F.col("_month").isNotNull()).select(
        "customer_id", "_month").distinct()
    # the versions that some day of a customer's month can need, each at its start or the month's
    begins, ends = F.col("_month").cast("timestamp_ntz"), F.add_months("_month", 1).cast("timestamp_ntz")
    reach = months.join(h, (F.col("customer_id") == F.col("_cid")) & (F.col("valid_from") < ends)
                        & (F.col("valid_to").isNull() | (F.col("valid_to") > begins)))
    starts = reach.select(F.lit(None).cast("long").alias("row_id"), "customer_id", F.lit(None).cast("date").alias("order_date"),
                          "_month", F.greatest("valid_from", begins).alias("_at"), "_version")
    laid = starts.unionByName(f.withColumn("_version", F.lit(None).cast(h.schema["_version"].dataType)))
    in_time = (Window.partitionBy("customer_id", "_month").orderBy("_at", F.col("_version").isNull())
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carried = laid.withColumn("_last", F.last("_version", ignorenulls=True).over(in_time)).filter(F.col("_version").isNull())
    until = F.col("_last.until")
    valid = F.col("customer_id").isNotNull() & F.col("_at").isNotNull() & (until.isNull() | (F.col("_at") < until))
    return carried.select("row_id", "customer_id", "order_date", F.when(valid, F.col("_last.key")).alias("asof_customer_key"))


MEASURES = ["sales", "quantity", "profit", "transaction_count"]
DAILY_KEYS = ["order_date", "customer_key", "product_key", "location_id"]


def totals() -> list[Column]:
    """The measures of fact rows."""
    return [F.sum("sales").alias("sales"), F.sum("quantity").cast("long").alias("quantity"),
            F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("transaction_count")]


def merged_totals() -> list[Column]:
    """The measures of rows that hold measures already."""
    return [F.sum("sales").alias("sales"), F.sum("quantity").cast("long").alias("quantity"),
            F.sum("profit").alias("profit"), F.sum("transaction_count").cast("long").alias("transaction_count")]


def sales_daily(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*DAILY_KEYS).agg(*totals())


def sales_monthly(daily: DataFrame) -> DataFrame:
    """Monthly rollup re-aggregated from the daily one (never from the fact)."""
    month = F.trunc("order_date", "month").alias("month_key")
    return daily.groupBy(month, *DAILY_KEYS[1:]).agg(*merged_totals())


# ---- incremental rollups ------------------------------------------------------------------------

def _summed(rows: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """Measures by ``keys``; with ``partitions`` in so many, however the session shuffles. Fewer
    keys than partitions are left to the map-side sums."""
    if partitions is not None and len(keys) > 1:
        rows = rows.repartition(partitions, *keys)
    return rows.groupBy(*keys).agg(*merged_totals())


def rollup_delta(before: DataFrame, after: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """What changed fact rows do to a rollup by ``keys``: the rows as they were count negative, the
    rows as they are positive. Its size follows the change, not the fact."""
    sign = lambda df, n: df.select(*keys, *[(F.col(m) * n).alias(m) for m in MEASURES[:3]],
                                   F.lit(n).cast("long").alias("transaction_count"))
    return _summed(sign(before, -1).unionByName(sign(after, 1)), keys, partitions).filter(
        " or ".join(f"{m} <> 0 or {m} is null" for m in MEASURES))


def merge_rollup(stored: DataFrame, delta: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """The rollup after the change. Sums are exact, so a group without rows left has none of its
    measures left and goes. With ``partitions`` the stored rows go into the partitions that a
    delta made with as many lies in, so it is not exchanged a second time."""
    before, change = stored.select(*keys, *MEASURES), delta.select(*keys, *MEASURES)
    if partitions is not None and len(keys) > 1:
        before = before.repartition(partitions, *keys)
    return _summed(before.unionByName(change), keys, None).filter("transaction_count <> 0")


def monthly_delta(daily_delta: DataFrame) -> DataFrame:
    """The change of the monthly rollup from that of the daily one."""
    return sales_monthly(daily_delta)


def order_fulfillment(silver: DataFrame) -> DataFrame:
    """Accumulating snapshot: one row per order."""
    return (silver.groupBy("order_id").agg(
                F.min("order_date").alias("order_date"), F.max("ship_date").alias("ship_date"),
                F.count(F.lit(1)).alias("line_count"), F.sum("sales").alias("sales"),
                F.sum("quantity").cast("long").alias("quantity"), F.sum("profit").alias("profit"))
            .withColumn("days_to_ship", F.datediff("ship_date", "order_date"))
            .select("order_id", "order_date", "ship_date", "days_to_ship", "line_count",
                    "sales", "quantity", "profit"))


def fk_violations(fact: DataFrame, customers: DataFrame, scd2: DataFrame, products: DataFrame,
                  locations: DataFrame, dates: DataFrame) -> DataFrame:
    """Per foreign key: non-null fact values with no parent row (one row per FK)."""
    checks = [
        ("customer_key", customers, "customer_key"),
        ("scd2_customer_key", scd2, "customer_key"),
        ("product_key", products, "product_key"),
        ("location_id", locations, "location_id"),
        ("order_date", dates, "date_key"),
        ("ship_date", dates, "date_key"),
    ]
    names = [fk for fk, _, _ in checks]
    # one scan of the fact: its rows collapse to (foreign key, value, rows) on the map side
    pairs = F.explode(F.array(*[F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).cast("string").alias("value"))
                                for fk in names]))
    used = (fact.select(pairs.alias("p")).select("p.*").filter(F.col("value").isNotNull())
                .groupBy("foreign_key", "value").agg(F.count(F.lit(1)).alias("rows")))
    held = None
    for fk, parent, pk in checks:
        keys = parent.select(F.lit(fk).alias("foreign_key"), F.col(pk).cast("string").alias("value"))
        held = keys if held is None else held.unionByName(keys)
    orphans = used.join(held, ["foreign_key", "value"], "left_anti").groupBy("foreign_key").agg(
        F.sum("rows").alias("rows"))
    every = fact.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("foreign_key"))
    return every.join(orphans, "foreign_key", "left").select(
        "foreign_key", F.coalesce("rows", F.lit(0)).cast("long").alias("orphan_rows"))


def year_touched(year: int, start: str | None, end: str | None, more: Iterable[int] = ()) -> bool:
    """A year that the window [start, end] reaches, or one of ``more``."""
    return (start is None or year >= int(start[:4])) and (end is None or year <= int(end[:4])) or year in set(more)


def years_touched(day: Column, start: str | None, end: str | None, more: list[int] = ()) -> Column:
    """``year_touched`` for a column of dates; a null date counts as touched."""
    year = F.year(day)
    inside = F.lit(True)
    if start is not None:
        inside = inside & (year >= int(start[:4]))
    if end is not None:
        inside = inside & (year <= int(end[:4]))
    return F.coalesce(inside | year.isin(list(more)) if more else inside, F.lit(True))


def reconcile_fact_daily(fact: DataFrame, daily: DataFrame, tol: float) -> DataFrame:
    """Q1: totals of the fact and of the daily rollup must agree (NULL -> fail)."""
    f = fact.agg(F.sum("sales").alias("fact_sales"), F.sum("profit").alias("fact_profit"),
                 F.sum("quantity").cast("long").alias("fact_quantity"), F.count(F.lit(1)).alias("fact_rows"))
    d = daily.agg(F.sum("sales").alias("daily_sales"), F.sum("profit").alias("daily_profit"),
                  F.sum("quantity").cast("long").alias("daily_quantity"),
                  F.sum("transaction_count").cast("long").alias("daily_rows"))
    z = F.lit(0)
    passed = ((F.abs(F.coalesce("fact_sales", z) - F.coalesce("daily_sales", z)) <= tol) &
              (F.abs(F.coalesce("fact_profit", z) - F.coalesce("daily_profit", z)) <= tol) &
              (F.coalesce("fact_quantity", z) == F.coalesce("daily_quantity", z)) &
              (F.col("fact_rows") == F.col("daily_rows")))
    return side_by_side(f, d).withColumn("passed", F.coalesce(passed, F.lit(False)))
