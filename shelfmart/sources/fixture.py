"""Source adapter: derive the 21-column retail extract from the driver's tables.

The extract is the shape a point-of-sale export has: every value is text, dates are
``M/d/yyyy``, column names carry spaces. It is rebuilt from ``lineitem`` joined to
its order, customer, nation, region and part, so it grows with the tables.

The variants below are deterministic functions of the row key (or customer number),
so the same rows are perturbed on every engine and at every scale; they never drop
rows to save work, they only shape test scenarios (dirty values, a previous and an
incoming snapshot, three customer batches).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmart.functions.columns import col, render_source_date

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Scenario parameters for the three customer batches (SCD2): batch k perturbs the
# customers whose number is k modulo 11; batch 3 no longer lists numbers = 10 mod 11.
BATCH_TIMES = ["1997-01-01 00:00:00", "1998-07-01 00:00:00", "2000-01-01 00:00:00"]
BATCH_MODULUS = 11
VANISHING_RESIDUE = 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_extract(spark: SparkSession, sf_dir: str, dirty: bool = True, partitions: int | None = None) -> DataFrame:
    """All lineitems as raw text rows; duplicate ``Row ID`` values occur naturally.

    With ``partitions`` the rows come hash-partitioned on ``Row ID`` into so many; they are
    exchanged before they are rendered as text, which is wider."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # nation (25 rows) and region (5 rows) are fixed-size reference tables.
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")

    # Customers go to the orders, not to their lines, of which there are several times more; so
    # the lines are exchanged by part and by order only. orders grows with lineitem, so it is
    # joined by shuffle on the order key at every scale; customer and part are left to AQE's
    # runtime size check.
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("o_custkey")
    j = (li.join(part, li.l_partkey == part.p_partkey).drop("p_partkey")
           .join(placed.hint("merge"), li.l_orderkey == placed.o_orderkey).drop("o_orderkey"))

    row_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    if partitions is not None:
        j = j.repartition(partitions, row_id.cast("string"))
    j = (j.join(nation, F.col("c_nationkey") == nation.n_nationkey)
          .join(region, nation.n_regionkey == region.r_regionkey))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    qty = F.col("l_quantity").cast("int")
    sales = price * (F.lit(1) - disc)
    profit = sales - F.col("p_retailprice").cast("decimal(12,2)") * qty
    order_id: Column = F.concat(F.lit("O-"), F.col("l_orderkey").cast("string"))
    if dirty:
        qty_out = F.when(row_id % 997 == 0, -qty).otherwise(qty)
        disc_out = F.when(row_id % 991 == 0, F.lit(1.5).cast("decimal(4,2)")).otherwise(disc)
        sales_out = F.when(row_id % 983 == 0, -sales).otherwise(sales)
        order_id = F.when(row_id % 1009 == 0, F.lit(None).cast("string")).otherwise(order_id)
    else:
        qty_out, disc_out, sales_out = qty, disc, sales
    custkey = F.col("c_custkey")
    return j.select(
        row_id.cast("string").alias("Row ID"),
        order_id.alias("Order ID"),
        render_source_date(F.col("o_orderdate")).alias("Order Date"),
        render_source_date(F.col("l_shipdate")).alias("Ship Date"),
        F.col("o_orderpriority").alias("Ship Mode"),
        F.concat(F.lit("C-"), custkey.cast("string")).alias("Customer ID"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias("Customer Name"),
        F.col("c_mktsegment").alias("Segment"),
        F.col("n_name").alias("Country"),
        F.concat(F.lit("CITY_"), (custkey % 100).cast("string")).alias("City"),
        F.concat(F.lit("STATE_"), (custkey % 10).cast("string")).alias("State"),
        F.when(custkey % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.lpad((custkey % 1000).cast("string"), 5, "0")).alias("Postal Code"),
        F.col("r_name").alias("Region"),
        F.concat(F.lit("P-"), F.col("l_partkey").cast("string")).alias("Product ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub-Category"),
        F.col("p_name").alias("Product Name"),
        sales_out.cast("string").alias("Sales"),
        qty_out.cast("string").alias("Quantity"),
        disc_out.cast("string").alias("Discount"),
        profit.cast("string").alias("Profit"),
    )


def previous_extract(extract: DataFrame) -> DataFrame:
    """The snapshot already stored: rows whose key is not a multiple of 13."""
    return extract.filter(col("Row ID").cast("long") % 13 != 0)


def incoming_extract(extract: DataFrame) -> DataFrame:
    """The next delivery: keys = 3 (mod 10) are gone, keys = 0 (mod 7) changed quantity."""
    rid = col("Row ID").cast("long")
    return (extract.filter(rid % 10 != 3)
            .withColumn("Quantity", F.when(rid % 7 == 0, (col("Quantity").cast("int") + 1).cast("string"))
                        .otherwise(col("Quantity"))))


#: Keys with this residue move to another day in the correcting delivery.
MOVED_MODULUS, MOVED_RESIDUE, MOVED_TO = 11, 4, "7/4/1997"

#: Texts that are no value of their column's type, on the rows whose key is a multiple.
BAD_VALUES = {"Quantity": (101, "n/a"), "Sales": (103, "12,50"), "Order Date": (107, "2/30/1997"),
              "Ship Date": (109, "soon"), "Discount": (109, "ten percent")}


def corrected_extract(extract: DataFrame) -> DataFrame:
    """The next delivery with some order dates corrected as well."""
    moved = col("Row ID").cast("long") % MOVED_MODULUS == MOVED_RESIDUE
    return incoming_extract(extract).withColumn(
        "Order Date", F.when(moved, F.lit(MOVED_TO)).otherwise(col("Order Date")))


def corrupted_extract(extract: DataFrame) -> DataFrame:
    """The extract with values that cannot be cast (BAD_VALUES)."""
    rid = col("Row ID").cast("long")
    return extract.withColumns({c: F.when(rid % m == 0, F.lit(text)).otherwise(col(c))
                                for c, (m, text) in BAD_VALUES.items()})


def customer_number(customer_id: Column) -> Column:
    return F.substr(customer_id, F.lit(3)).cast("long")


def customer_batches(current_customers: DataFrame) -> DataFrame:
    """Three customer snapshots (batch, customer_id, customer_name, segment, ingested_at)
    from the SCD1 customer rows: in batch k, customers with number = k (mod 11) carry a
    changed segment; batch 3 omits numbers = 10 (mod 11)."""
    frames = []
    for k, ts in enumerate(BATCH_TIMES, start=1):
        n = customer_number(F.col("customer_id"))
        b = current_customers.select(
            F.lit(k).alias("batch"),
            "customer_id", "customer_name",
            F.when(n % BATCH_MODULUS == k, F.concat(F.col("segment"), F.lit(f"/{k}")))
             .otherwise(F.col("segment")).alias("segment"),
            F.lit(ts).cast("timestamp_ntz").alias("ingested_at"),
        )
        if k == 3:
            b = b.filter(n % BATCH_MODULUS != VANISHING_RESIDUE)
        frames.append(b)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
