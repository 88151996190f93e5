"""Business queries on the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.operators import facts
from shelfmart.functions.columns import avg2, round2


def sales_by_segment(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Lines, revenue and average profit per customer segment, revenue descending.
    ``num_orders`` counts fact lines (non-null order ids), as the report always has."""
    j = fact.join(customers.select("customer_key", "segment"), "customer_key")
    return (j.groupBy("segment")
             .agg(F.count("order_id").alias("num_orders"), F.sum("sales").alias("_s"),
                  F.sum("profit").alias("_p"), F.count("profit").alias("_n"))
             .select("segment", "num_orders", round2(F.col("_s")).alias("total_sales"),
                     avg2(F.col("_p"), F.col("_n")).alias("avg_profit"))
             .orderBy(F.col("total_sales").desc(), "segment"))


def sales_by_region_month(fact: DataFrame, locations: DataFrame, dates: DataFrame,
                          top: int = 10) -> DataFrame:
    """First ``top`` (year, month, region) cells of revenue and profit (a top-k report)."""
    j = (fact.join(locations.select("location_id", "region"), "location_id")
             .join(dates.select(F.col("date_key").alias("order_date"), "year", "month", "month_name"),
                   "order_date"))
    return (j.groupBy("region", "year", "month", "month_name")
             .agg(round2(F.sum("sales")).alias("total_sales"), round2(F.sum("profit")).alias("total_profit"))
             .orderBy("year", "month", "region").limit(top))


def top_products(fact: DataFrame, products: DataFrame, top: int = 10) -> DataFrame:
    """Top ``top`` products by rounded profit (ties broken by product id)."""
    j = fact.join(products.select("product_key", "product_id", "product_name", "category", "sub_category"),
                  "product_key")
    return (j.groupBy("product_id", "product_name", "category", "sub_category")
             .agg(F.count("order_id").alias("num_sales"), F.sum("sales").alias("_s"),
                  F.sum("profit").alias("_p"), F.count("profit").alias("_n"))
             .select("product_id", "product_name", "category", "sub_category", "num_sales",
                     round2(F.col("_s")).alias("total_sales"), round2(F.col("_p")).alias("total_profit"),
                     avg2(F.col("_p"), F.col("_n")).alias("avg_profit_per_sale"))
             .orderBy(F.col("total_profit").desc(), "product_id").limit(top)
             .drop("product_id"))


def region_totals(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """The stored region summary: exact sums, so that deltas can be merged into it
    (``facts.merge_rollup``)."""
    return fact.join(locations.select("location_id", "region"), "location_id").groupBy("region").agg(*facts.totals())


def sales_by_region(totals: DataFrame) -> DataFrame:
    """The region summary as it is reported."""
    return totals.select("region", round2(F.col("sales")).alias("total_sales"),
                         F.col("transaction_count").alias("lines")).orderBy("region")


def sales_by_weekend(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Weekday versus weekend revenue via the date dimension."""
    j = fact.join(dates.select(F.col("date_key").alias("order_date"), "is_weekend"), "order_date")
    return (j.groupBy("is_weekend").agg(F.count(F.lit(1)).alias("lines"),
                                        round2(F.sum("sales")).alias("total_sales"),
                                        round2(F.sum("profit")).alias("total_profit"))
             .orderBy("is_weekend"))
