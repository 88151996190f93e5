"""Gold dimensions: SCD1 customers/products, location, date, SCD2 customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmart.config import LOCATION_COLUMNS
from shelfmart.functions.columns import rows_differ
from shelfmart.operators.keys import dense_key

SCD2_COLUMNS = ["customer_key", "customer_id", "customer_name", "segment",
                "valid_from", "valid_to", "is_current"]


def latest_per_key(df: DataFrame, key: str, attrs: list[str],
                   order: tuple[str, ...] = ("ingested_at", "row_id")) -> DataFrame:
    """One row per key carrying the attributes of its latest row (max of ``order``).

    Rows that share the key, the attributes and all of ``order`` but its last column collapse
    first, by hashing: an aggregate of structs sorts its input, which so is no longer the whole
    table. ``max_by`` is a plain aggregate, so partial aggregation runs before the shuffle and
    a very frequent key costs one buffer per map task, not one giant window partition.
    """
    same = list(dict.fromkeys([key, *attrs, *order[:-1]]))
    if order[-1] not in same:
        df = df.groupBy(*same).agg(F.max(order[-1]).alias(order[-1]))
    picked = df.groupBy(key).agg(
        F.max_by(F.struct(*attrs), F.struct(*order)).alias("_v"))
    return picked.select(key, *[F.col("_v").getField(a).alias(a) for a in attrs])


def dim_customers(silver: DataFrame) -> DataFrame:
    latest = latest_per_key(silver, "customer_id", ["customer_name", "segment", "ingested_at"])
    return dense_key(latest, ["customer_id"], "customer_key").select(
        "customer_key", "customer_id", "customer_name", "segment", "ingested_at")


def dim_products(silver: DataFrame) -> DataFrame:
    latest = latest_per_key(silver, "product_id",
                            ["product_name", "category", "sub_category", "ingested_at"])
    return dense_key(latest, ["product_id"], "product_key").select(
        "product_key", "product_id", "product_name", "category", "sub_category", "ingested_at")


def dim_location(silver: DataFrame) -> DataFrame:
    places = silver.select(*LOCATION_COLUMNS).distinct()
    return dense_key(places, LOCATION_COLUMNS, "location_id").select(
        "location_id", *LOCATION_COLUMNS)


def keep_keys(current: DataFrame, fresh: DataFrame, business: list[str], key: str) -> DataFrame:
    """``fresh`` with the surrogate keys of ``current``: known members keep theirs, new ones
    are numbered after the largest, and members only ``current`` knows stay as they are.

    A replay that rewrites some years uses it, so that the keys in all others stay valid."""
    same = F.lit(True)
    for c in business:
        same = same & F.col(f"f.{c}").eqNullSafe(F.col(f"c.{c}"))
    known = current.select(key, *business)
    joined = fresh.drop(key).alias("f").join(known.alias("c"), same, "left").select(
        *[F.col(f"f.{c}").alias(c) for c in fresh.columns if c != key], F.col(f"c.{key}").alias(key))
    top = current.agg(F.max(key)).first()[0] or 0
    new = dense_key(joined.filter(F.col(key).isNull()).drop(key), business, key, offset=top)
    gone = current.alias("f").join(fresh.select(*business).alias("c"), same, "left_anti")
    return (joined.filter(F.col(key).isNotNull()).unionByName(new).unionByName(gone).select(*fresh.columns))


def dim_date(silver: DataFrame) -> DataFrame:
    days = (silver.select(F.col("order_date").alias("date_key"))
                  .union(silver.select(F.col("ship_date").alias("date_key")))
                  .filter(F.col("date_key").isNotNull()).distinct())
    d = F.col("date_key")
    return days.select(
        d,
        F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),  # Sunday = 1, Saturday = 7
    )


def dim_customers_distinct(silver: DataFrame) -> DataFrame:
    """Notebook form: plain DISTINCT, no key (a changed customer gives two rows)."""
    return silver.select("customer_id", "customer_name", "segment").distinct()


def dim_products_distinct(silver: DataFrame) -> DataFrame:
    return silver.select("product_id", "product_name", "category", "sub_category").distinct()


# ---- SCD2 ------------------------------------------------------------------------

def _snapshot(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows: customer_id, customer_name, segment, ingested_at (one per customer)."""
    return snapshot.select("customer_id", "customer_name", "segment", "ingested_at")


def scd2_closed(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Current history rows whose attributes differ from the snapshot, closed at its time."""
    s = _snapshot(snapshot).alias("s")
    h = history.filter("is_current").alias("h")
    j = h.join(s, F.col("h.customer_id") == F.col("s.customer_id"))
    changed = rows_differ([F.col("h.customer_name"), F.col("h.segment")],
                          [F.col("s.customer_name"), F.col("s.segment")])
    return j.filter(changed).select(
        F.col("h.customer_key").alias("customer_key"), F.col("h.customer_id").alias("customer_id"),
        F.col("h.customer_name").alias("customer_name"), F.col("h.segment").alias("segment"),
        F.col("h.valid_from").alias("valid_from"), F.col("s.ingested_at").alias("valid_to"),
        F.lit(False).alias("is_current"))


def scd2_opened(history: DataFrame | None, snapshot: DataFrame) -> DataFrame:
    """New current rows for customers that are new or changed; keys continue after the max."""
    s = _snapshot(snapshot)
    if history is None:
        fresh, offset = s, F.lit(0).cast("long")
        base = fresh.withColumn("_off", offset)
    else:
        cur = history.filter("is_current").select(
            "customer_id", F.col("customer_name").alias("_hn"), F.col("segment").alias("_hs"),
            F.lit(True).alias("_has"))
        j = s.join(cur, "customer_id", "left")
        fresh = j.filter(F.col("_has").isNull() |
                         rows_differ([F.col("_hn"), F.col("_hs")],
                                     [F.col("customer_name"), F.col("segment")]))
        fresh = fresh.drop("_hn", "_hs", "_has")
        top = history.agg(F.max("customer_key")).first()[0] or 0   # one scalar
        base = fresh.withColumn("_off", F.lit(int(top)).cast("long"))
    keyed = dense_key(base, ["customer_id"], "customer_key", offset=F.col("_off"))
    return keyed.select(
        "customer_key", "customer_id", "customer_name", "segment",
        F.col("ingested_at").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))


def scd2_merge(history: DataFrame | None, snapshot: DataFrame) -> DataFrame:
    """History after one batch: unchanged rows, closed rows and opened rows.

    Customers missing from the snapshot keep their open row.
    """
    opened = scd2_opened(history, snapshot)
    if history is None:
        return opened
    closed = scd2_closed(history, snapshot)
    untouched = history.join(closed.select("customer_key"), "customer_key", "left_anti")
    return untouched.select(*SCD2_COLUMNS).unionByName(closed).unionByName(opened)


def scd2_backfill(snapshots: DataFrame) -> DataFrame:
    """Set-based equivalent of merging every batch in time order.

    A version starts where a customer's attributes differ from its previous present
    snapshot (or at its first appearance); it ends where the next version starts.
    """
    s = snapshots.select("customer_id", "customer_name", "segment", "ingested_at")
    w = Window.partitionBy("customer_id").orderBy("ingested_at")
    first = F.row_number().over(w) == 1
    changed = rows_differ([F.lag("customer_name").over(w), F.lag("segment").over(w)],
                          [F.col("customer_name"), F.col("segment")])
    starts = (s.withColumn("_start", first | changed)
               .filter("_start").drop("_start"))
    versions = starts.withColumn("valid_to", F.lead("ingested_at").over(w)).withColumnRenamed(
        "ingested_at", "valid_from")
    keyed = dense_key(versions, ["valid_from", "customer_id"], "customer_key")
    return keyed.select(
        "customer_key", "customer_id", "customer_name", "segment", "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"))


def scd2_current_keys(history: DataFrame) -> DataFrame:
    """Newest current key per customer (valid_from, then key, descending)."""
    return (history.filter("is_current").groupBy("customer_id")
                   .agg(F.max_by("customer_key", F.struct("valid_from", "customer_key"))
                        .alias("scd2_customer_key")))
