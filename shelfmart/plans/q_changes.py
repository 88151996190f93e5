"""Catalogue entries for changing data: rollups kept by deltas, casts that route bad values,
the snapshot history of several runs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.config import LOCATION_COLUMNS, SOURCE_KEY
from shelfmart.operators import bronze as bronze_ops
from shelfmart.operators import facts
from shelfmart.operators import silver as silver_ops
from shelfmart.plans.catalog import _dbl, query
from shelfmart.plans.oracle import CTES, build, dedup, silver_select
from shelfmart.plans.q_ingest import WINDOW_RUN
from shelfmart.plans.warehouse import DEMO_RUN, Warehouse
from shelfmart.sources import fixture

# ---- incremental rollups (F6, F7, A4) -------------------------------------------------------------

NATURAL_KEYS = ["order_date", "customer_id", "product_id", *LOCATION_COLUMNS]
_SUMS = """sum(sales) AS sales, CAST(sum(quantity) AS BIGINT) AS quantity, sum(profit) AS profit,
           count(*) AS transaction_count"""
_OUT = f"SELECT * REPLACE ({_dbl('sales', 'profit')})"

CTES.update({
    "corrected": (["incoming"], f"""
      SELECT * REPLACE (CASE WHEN CAST("Row ID" AS BIGINT) % {fixture.MOVED_MODULUS} = {fixture.MOVED_RESIDUE}
                             THEN '{fixture.MOVED_TO}' ELSE "Order Date" END AS "Order Date") FROM incoming"""),
    "corrected_silver": (["corrected"], silver_select(f"({dedup('corrected')})")),
})


def _sides(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The changed rows of a correcting full load as they were and as they are, typed. Some rows
    are new, gone, changed in quantity, or moved to another day."""
    before, after = bronze_ops.images(w.correction)
    return silver_ops.clean(before, DEMO_RUN), silver_ops.clean(after, DEMO_RUN)


def _kept(w: Warehouse, name: str, keys: list[str], month: bool = False) -> DataFrame:
    """A rollup stored before the load, and the load's delta merged into it."""
    by = lambda df: df.withColumn("month_key", F.trunc("order_date", "month")) if month else df
    stored = w._layer(f"scenario/{name}_before", lambda: by(silver_ops.clean(w.previous, DEMO_RUN))
                      .groupBy(*keys).agg(*facts.totals()))
    before, after = (by(side) for side in _sides(w))
    tasks = None if w.store is None else w.tasks
    return facts.merge_rollup(stored, facts.rollup_delta(before, after, keys, tasks), keys, tasks)


@query("sales_daily_incremental", build(
    f"{_OUT} FROM (SELECT {', '.join(NATURAL_KEYS)}, {_SUMS} FROM corrected_silver GROUP BY ALL)", "corrected_silver"))
def sales_daily_incremental(w: Warehouse) -> DataFrame:
    """F6 without a rebuild: the stored daily rollup plus the signed change of a load."""
    return _kept(w, "daily", NATURAL_KEYS)


@query("sales_monthly_incremental", build(
    f"""{_OUT} FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_key,
                            {', '.join(NATURAL_KEYS[1:])}, {_SUMS} FROM corrected_silver GROUP BY ALL)""", "corrected_silver"))
def sales_monthly_incremental(w: Warehouse) -> DataFrame:
    """F7 without a rebuild."""
    return _kept(w, "monthly", ["month_key", *NATURAL_KEYS[1:]], month=True)


@query("sales_by_region_incremental", build(
    f"{_OUT} FROM (SELECT region, {_SUMS} FROM corrected_silver GROUP BY region)", "corrected_silver"))
def sales_by_region_incremental(w: Warehouse) -> DataFrame:
    """A4 kept as a stored table by deltas."""
    return _kept(w, "region", ["region"])


# ---- casts that route bad values (V4, V11, V13) -----------------------------------------------------

_TRY = {
    "Discount": 'TRY_CAST("Discount" AS DECIMAL(18,4))', "Order Date": "try_strptime(\"Order Date\", '%m/%d/%Y')",
    "Profit": 'TRY_CAST("Profit" AS DECIMAL(18,4))', "Quantity": 'TRY_CAST("Quantity" AS INTEGER)',
    "Row ID": 'TRY_CAST("Row ID" AS BIGINT)', "Sales": 'TRY_CAST("Sales" AS DECIMAL(18,4))',
    "Ship Date": "try_strptime(\"Ship Date\", '%m/%d/%Y')",
}
_FAILED = "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN \"{c}\" IS NOT NULL AND {x} IS NULL THEN '{c}' END" for c, x in _TRY.items()) + "], lambda c: c IS NOT NULL), ', ')"
_BAD = {c: f"CASE WHEN CAST(\"Row ID\" AS BIGINT) % {m} = 0 THEN '{text}' ELSE \"{c}\" END AS \"{c}\""
        for c, (m, text) in fixture.BAD_VALUES.items()}

CTES.update({
    "corrupted": (["src"], f"SELECT * REPLACE ({', '.join(_BAD.values())}) FROM src"),
    "corrupted_bronze": (["corrupted"], dedup("corrupted")),
    "cast_marked": (["corrupted_bronze"], f"SELECT *, {_FAILED} AS failed_columns FROM corrupted_bronze WHERE \"Order ID\" IS NOT NULL"),
    "cast_good": (["cast_marked"], "SELECT * EXCLUDE (failed_columns) FROM cast_marked WHERE failed_columns = ''"),
})


@query("silver_routed", build(
    f"SELECT * REPLACE ({_dbl('sales', 'discount', 'profit')}) FROM ({silver_select('cast_good')})", "cast_good"))
def silver_routed(w: Warehouse) -> DataFrame:
    """V4 that keeps the run going: silver of an extract with texts that are no numbers or dates."""
    return silver_ops.route_bad_values(w.corrupted_bronze, DEMO_RUN)[0]


@query("cast_rejects", build(f"""
    SELECT *, '{DEMO_RUN.run_id}' AS run_id, TIMESTAMP '{DEMO_RUN.ingested_at}' AS rejected_at
    FROM cast_marked WHERE failed_columns <> ''""", "cast_marked"))
def cast_rejects(w: Warehouse) -> DataFrame:
    """The rows set aside, as delivered, with the columns that could not be cast."""
    return silver_ops.route_bad_values(w.corrupted_bronze, DEMO_RUN)[1]


@query("recon_routed", build("""
    SELECT s.n + r.n AS bronze_rows, s.n AS silver_rows, r.n AS rejected_rows, TRUE AS passed
    FROM (SELECT count(*) AS n FROM cast_good WHERE try_strptime("Order Date", '%m/%d/%Y')
            BETWEEN DATE '1996-01-01' AND DATE '1996-12-31') s,
         (SELECT count(*) AS n FROM cast_marked WHERE failed_columns <> ''
            AND coalesce(try_strptime("Order Date", '%m/%d/%Y') BETWEEN DATE '1996-01-01' AND DATE '1996-12-31',
                         "Order Date" IS NOT NULL)) r""", "cast_good", "cast_marked"))
def recon_routed(w: Warehouse) -> DataFrame:
    """V13 for a window: every bronze row is in silver or set aside. A row whose date cannot be
    read is in no window, and set aside by each."""
    silver, rejected = silver_ops.route_bad_values(w.corrupted_bronze, WINDOW_RUN)
    return silver_ops.reconcile_routed(w.corrupted_bronze, silver, rejected, WINDOW_RUN)


# ---- snapshot history (S4, B12) -----------------------------------------------------------------------

FIRST_SNAPSHOT, SECOND_SNAPSHOT = (replace(DEMO_RUN, run_id=f"00000000-0000-7000-8000-00000000001{k}",
                                           ingested_at=f"2024-02-0{k} 00:00:00") for k in (1, 2))


def _snapshot_sql(source: str, run) -> str:
    return (f"SELECT *, '{run.run_id}' AS snapshot_run_id, TIMESTAMP '{run.ingested_at}' AS snapshot_at FROM {source}")


CTES.update({"first_delivery": (["src"], 'SELECT * FROM src WHERE CAST("Row ID" AS BIGINT) % 13 <> 0')})


@query("bronze_snapshot_append", build(
    f"{_snapshot_sql('first_delivery', FIRST_SNAPSHOT)} UNION ALL {_snapshot_sql('incoming', SECOND_SNAPSHOT)}",
    "first_delivery", "incoming"))
def bronze_snapshot_append(w: Warehouse) -> DataFrame:
    """The stored history after two runs, the second of which was repeated."""
    return w.snapshot_history


@query("load_snapshot", build("""
    SELECT d.*, h.n AS delivered_rows FROM incoming_dedup d
    JOIN (SELECT "Row ID", count(*) AS n FROM incoming GROUP BY "Row ID") h USING ("Row ID")""",
    "incoming_dedup", "incoming"))
def load_snapshot(w: Warehouse) -> DataFrame:
    """The state is replaced by the delivery, one row per key, and the history holds the
    delivery as it came: the rows that this run stored there, per key of the state."""
    # both are stored in the buckets of the key, so that joining them exchanges neither: the state
    # lies in them already, of the history the keys and their counts are exchanged
    state = w._layer("scenario/snapshot_state", lambda: bronze_ops.live(w.changes("snapshot")), bucket_by=SOURCE_KEY)
    own = w._layer("scenario/snapshot_delivered", lambda: w.snapshot_history.filter(
        F.col("snapshot_run_id") == SECOND_SNAPSHOT.run_id).groupBy("`Row ID`").agg(
        F.count(F.lit(1)).alias("delivered_rows")), bucket_by=SOURCE_KEY)
    return state.join(own, "Row ID").select(*[f"`{c}`" for c in state.columns], "delivered_rows")
