"""Catalogue entries for gold: keys, SCD2, fact lookups, partitions, integrity, quality,
reconciliation and incremental control."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmart.config import QUALITY_RULE_VERSION, QUALITY_RULES, RECON_TOLERANCE, REQUIRED_SOURCE_COLUMNS, SOURCE_COLUMNS
from shelfmart.functions.columns import col, round2
from shelfmart.operators import bronze as bronze_ops
from shelfmart.operators import contract, control, dims, facts, quality
from shelfmart.operators import silver as silver_ops
from shelfmart.operators.keys import dense_key
from shelfmart.plans.catalog import _dbl, query
from shelfmart.plans.oracle import CTES, build
from shelfmart.plans.warehouse import DEMO_RUN, Warehouse
from shelfmart.sources import files, store

PIPELINE_NAME = "retail_sales"
CHECKED_AT = "2024-01-01 01:00:00"
LEDGER_BASE = "2024-01-01 00:00:00"
REPLAY_EVERY = 6          # every sixth monthly delivery is a replay
REPLAY_WINDOW = ("1997-03-01", "1997-05-31")

CTES.update({
    "runs": (["bronze", "silver", "fact"], f"""
      SELECT m.month, CAST(row_number() OVER (ORDER BY m.month) AS BIGINT) AS run_seq,
             'run-' || strftime(m.month, '%Y%m') AS run_id, '{PIPELINE_NAME}' AS pipeline_name,
             b.bronze_rows, coalesce(s.silver_rows, 0) AS silver_rows, coalesce(f.gold_rows, 0) AS gold_rows,
             s.max_order_date
      FROM (SELECT DISTINCT CAST(date_trunc('month', CAST(strptime("Order Date", '%m/%d/%Y') AS DATE)) AS DATE) AS month
            FROM bronze) m
      JOIN (SELECT CAST(date_trunc('month', CAST(strptime("Order Date", '%m/%d/%Y') AS DATE)) AS DATE) AS month,
                   count(*) AS bronze_rows FROM bronze GROUP BY 1) b USING (month)
      LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS silver_rows,
                        max(order_date) AS max_order_date FROM silver GROUP BY 1) s USING (month)
      LEFT JOIN (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS gold_rows
                 FROM fact GROUP BY 1) f USING (month)"""),
    "runs_r": (["runs"], f"SELECT *, run_seq % {REPLAY_EVERY} = 0 AS replay FROM runs"),
    "wm": (["runs_r"], """
      SELECT pipeline_name, run_seq, run_id,
             max(CASE WHEN NOT replay THEN max_order_date END) OVER (
               PARTITION BY pipeline_name ORDER BY run_seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
             ) AS watermark_date
      FROM runs_r"""),
    "checks": (["silver", "fact"], f"""
      SELECT s.n = g.n AS "silver/gold row count", g.null_loc = 0 AS "null location keys",
             g.bad = 0 AS "invalid measures",
             coalesce(abs(coalesce(s.sales, 0) - coalesce(g.sales, 0)) <= {RECON_TOLERANCE}
                      AND abs(coalesce(s.profit, 0) - coalesce(g.profit, 0)) <= {RECON_TOLERANCE}
                      AND coalesce(s.qty, 0) = coalesce(g.qty, 0), FALSE) AS "silver/gold totals"
      FROM (SELECT count(*) AS n, sum(sales) AS sales, sum(profit) AS profit,
                   CAST(sum(quantity) AS BIGINT) AS qty FROM silver) s,
           (SELECT count(*) AS n, sum(sales) AS sales, sum(profit) AS profit, CAST(sum(quantity) AS BIGINT) AS qty,
                   count(*) FILTER (WHERE location_id IS NULL) AS null_loc,
                   count(*) FILTER (WHERE sales < 0 OR quantity <= 0 OR discount NOT BETWEEN 0 AND 1) AS bad
            FROM fact) g"""),
    "qres": (["checks"], f"""
      SELECT '{DEMO_RUN.run_id}' AS run_id, rule_name, passed, '{QUALITY_RULE_VERSION}' AS rule_version,
             TIMESTAMP '{CHECKED_AT}' AS checked_at
      FROM (UNPIVOT checks ON COLUMNS(*) INTO NAME rule_name VALUE passed)"""),
})


def _history(w: Warehouse) -> DataFrame:
    return w.scd2_history[2]


# ---- keys and dimensions -----------------------------------------------------------------------

@query("surrogate_keys", build("SELECT customer_key, customer_id FROM dim_customers", "dim_customers"))
def surrogate_keys(w: Warehouse) -> DataFrame:
    """Range-partitioned numbering with partition offsets."""
    latest = dims.latest_per_key(w.silver, "customer_id", ["customer_name"])
    return dense_key(latest, ["customer_id"], "customer_key").select(
        "customer_key", "customer_id")


@query("dim_customers_distinct", build(
    "SELECT DISTINCT customer_id, customer_name, segment FROM silver", "silver"))
def dim_customers_distinct(w: Warehouse) -> DataFrame:
    """Notebook customers (plain DISTINCT)."""
    return dims.dim_customers_distinct(w.silver)


@query("dim_products_distinct", build(
    "SELECT DISTINCT product_id, product_name, category, sub_category FROM silver", "silver"))
def dim_products_distinct(w: Warehouse) -> DataFrame:
    """Notebook products (plain DISTINCT)."""
    return dims.dim_products_distinct(w.silver)


# ---- SCD2 (G7-G10, F3, F4) -----------------------------------------------------------------------

@query("dim_customers_scd2", build("SELECT * FROM h3", "h3"))
def dim_customers_scd2(w: Warehouse) -> DataFrame:
    """History after merging three customer batches one at a time."""
    return _history(w)


@query("scd2_closed", build("""
    SELECT h.customer_key, h.customer_id, h.customer_name, h.segment, h.valid_from,
           s.ingested_at AS valid_to, FALSE AS is_current
    FROM h2 h JOIN b3 s ON h.customer_id = s.customer_id
    WHERE h.is_current AND (h.customer_name, h.segment) IS DISTINCT FROM (s.customer_name, s.segment)""",
    "h2", "b3"))
def scd2_closed(w: Warehouse) -> DataFrame:
    """Current rows closed by batch 3."""
    return dims.scd2_closed(w.scd2_history[1], w.batch(3))


@query("scd2_opened", build("""
    SELECT (SELECT max(customer_key) FROM h2) + row_number() OVER (ORDER BY s.customer_id NULLS LAST) AS customer_key,
           s.customer_id, s.customer_name, s.segment, s.ingested_at AS valid_from,
           CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
    FROM b3 s LEFT JOIN (SELECT * FROM h2 WHERE is_current) c ON s.customer_id = c.customer_id
    WHERE c.customer_id IS NULL OR (c.customer_name, c.segment) IS DISTINCT FROM (s.customer_name, s.segment)""",
    "h2", "b3"))
def scd2_opened(w: Warehouse) -> DataFrame:
    """Rows opened by batch 3 (new or changed customers), keys after the max."""
    return dims.scd2_opened(w.scd2_history[1], w.batch(3))


@query("scd2_backfill", build("SELECT * FROM h3", "h3"))
def scd2_backfill(w: Warehouse) -> DataFrame:
    """The same history computed set-based from all batches at once."""
    return dims.scd2_backfill(w.customer_batches)


@query("fact_scd2_lookup", build("""
    SELECT customer_id, customer_key AS scd2_customer_key FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from DESC, customer_key DESC) AS rn
      FROM h3 WHERE is_current) WHERE rn = 1""", "h3"))
def fact_scd2_lookup(w: Warehouse) -> DataFrame:
    """newest current SCD2 key per customer (the lateral top-1, pre-reduced)."""
    return dims.scd2_current_keys(_history(w))


@query("fact_scd2_asof", build("""
    SELECT s.row_id, s.customer_id, s.order_date, h.customer_key AS asof_customer_key
    FROM silver s LEFT JOIN h3 h ON s.customer_id = h.customer_id
      AND h.valid_from <= CAST(s.order_date AS TIMESTAMP)
      AND (h.valid_to IS NULL OR CAST(s.order_date AS TIMESTAMP) < h.valid_to)""", "silver", "h3"))
def fact_scd2_asof(w: Warehouse) -> DataFrame:
    """customer version valid on each order date."""
    return facts.fact_scd2_asof(w.silver, _history(w))


# ---- fact variants, partitions, integrity ------------------------------------------------------------

@query("fact_location_lookup", build("""
    SELECT s.row_id, s.country, s.region, s.state, s.city, s.postal_code, l.location_id
    FROM silver s LEFT JOIN dim_location l ON s.country = l.country AND s.region = l.region
      AND s.state = l.state AND s.city = l.city AND s.postal_code = l.postal_code""", "silver", "dim_location"))
def fact_location_lookup(w: Warehouse) -> DataFrame:
    """null-rejecting five-column LEFT join to the location key."""
    return w.silver.select("row_id", "country", "region", "state", "city", "postal_code").join(
        w.dim_location, ["country", "region", "state", "city", "postal_code"], "left").select(
        "row_id", "country", "region", "state", "city", "postal_code", "location_id")


@query("fact_sales_natural", build(f"""
    SELECT * REPLACE ({_dbl('sales', 'discount', 'profit')}) FROM (
      SELECT s.row_id, s.order_id, s.order_date, s.ship_date, s.customer_id, s.product_id, l.location_id,
             s.ship_mode, s.sales, s.quantity, s.discount, s.profit
      FROM silver s LEFT JOIN dim_location l ON s.country = l.country AND s.region = l.region
        AND s.state = l.state AND s.city = l.city AND s.postal_code = l.postal_code)""", "silver", "dim_location"))
def fact_sales_natural(w: Warehouse) -> DataFrame:
    """notebook fact with natural keys."""
    return facts.fact_sales_natural(w.silver, w.dim_location)


@query("fact_year_partitions", build("""
    SELECT CAST(year(order_date) AS INTEGER) AS order_year, count(*) AS rows FROM fact GROUP BY 1""", "fact"))
def fact_year_partitions(w: Warehouse) -> DataFrame:
    """Rows per order-year partition of the stored fact (read from the partition column)."""
    return w.fact_partitioned.groupBy("order_year").agg(F.count(F.lit(1)).alias("rows"))


@query("preview_fact", build(f"""
    SELECT * REPLACE ({_dbl('sales', 'discount', 'profit')}) FROM fact ORDER BY row_id LIMIT 3""", "fact"))
def preview_fact(w: Warehouse) -> DataFrame:
    """S3: a three-row preview (the limit is the feature), ordered for determinism."""
    return w.fact.orderBy("row_id").limit(3)


_FK_SQL = " UNION ALL ".join(
    f"SELECT '{fk}' AS foreign_key, count(*) AS orphan_rows FROM fact f WHERE f.{fk} IS NOT NULL "
    f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = f.{fk})"
    for fk, parent, pk in [("customer_key", "dim_customers", "customer_key"),
                           ("scd2_customer_key", "scd2", "customer_key"),
                           ("product_key", "dim_products", "product_key"),
                           ("location_id", "dim_location", "location_id"),
                           ("order_date", "dim_date", "date_key"),
                           ("ship_date", "dim_date", "date_key")])


@query("fk_violations", build(_FK_SQL, "fact", "dim_customers", "scd2", "dim_products", "dim_location", "dim_date"))
def fk_violations(w: Warehouse) -> DataFrame:
    """orphan rows per foreign key of the fact."""
    return w._layer("report/fk_violations", lambda: facts.fk_violations(
        w.fact, w.dim_customers, w.scd2, w.dim_products, w.dim_location, w.dim_date))


_KEYS = quality.TABLE_KEYS
_KEY_CTE = {"silver": "silver", "dim_customers": "dim_customers", "dim_products": "dim_products",
            "dim_location": "dim_location", "dim_date": "dim_date", "fact_sales": "fact",
            "fact_order_fulfillment": "fulfillment"}
_KV_SQL = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{",".join(k)}' AS key_columns,
        CAST(coalesce(sum(CASE WHEN {" OR ".join(f"{c} IS NULL" for c in k)} THEN n END), 0) AS BIGINT) AS null_keys,
        count(*) FILTER (WHERE NOT ({" OR ".join(f"{c} IS NULL" for c in k)}) AND n > 1) AS duplicate_keys
      FROM (SELECT {", ".join(k)}, count(*) AS n FROM {_KEY_CTE[t]} GROUP BY {", ".join(k)})"""
    for t, k in _KEYS)


@query("key_violations", build(_KV_SQL, *sorted(set(_KEY_CTE.values()))))
def key_violations(w: Warehouse) -> DataFrame:
    """Null and duplicated primary / business keys of every table."""
    frames = {"silver": w.silver, "dim_customers": w.dim_customers, "dim_products": w.dim_products,
              "dim_location": w.dim_location, "dim_date": w.dim_date, "fact_sales": w.fact,
              "fact_order_fulfillment": w.fulfillment}
    return w._layer("report/key_violations", lambda: quality.key_report(frames))


# ---- quality and reconciliation (Q1-Q11) ---------------------------------------------------------------

@query("recon_fact_daily", build(f"""
    SELECT CAST(f.sales AS DOUBLE) AS fact_sales, CAST(f.profit AS DOUBLE) AS fact_profit, f.qty AS fact_quantity,
           f.n AS fact_rows, CAST(d.sales AS DOUBLE) AS daily_sales, CAST(d.profit AS DOUBLE) AS daily_profit,
           d.qty AS daily_quantity, d.n AS daily_rows,
           coalesce(abs(coalesce(f.sales, 0) - coalesce(d.sales, 0)) <= {RECON_TOLERANCE}
             AND abs(coalesce(f.profit, 0) - coalesce(d.profit, 0)) <= {RECON_TOLERANCE}
             AND coalesce(f.qty, 0) = coalesce(d.qty, 0) AND f.n = d.n, FALSE) AS passed
    FROM (SELECT sum(sales) AS sales, sum(profit) AS profit, CAST(sum(quantity) AS BIGINT) AS qty,
                 count(*) AS n FROM fact) f,
         (SELECT sum(sales) AS sales, sum(profit) AS profit, CAST(sum(quantity) AS BIGINT) AS qty,
                 CAST(sum(transaction_count) AS BIGINT) AS n FROM daily) d""", "fact", "daily"))
def recon_fact_daily(w: Warehouse) -> DataFrame:
    """Q1: fact and daily rollup totals agree."""
    return facts.reconcile_fact_daily(w.fact, w.daily, RECON_TOLERANCE)


@query("quality_results", build("SELECT * FROM qres", "qres"))
def quality_results(w: Warehouse) -> DataFrame:
    """Q2-Q6: the four rules evaluated in one pass per table, one row per rule."""
    return quality.quality_results(quality.rule_checks(w.silver, w.fact), DEMO_RUN.run_id, CHECKED_AT)


_RULES_VALUES = ", ".join(f"('{n}', '{c}', '{o}', '{s}', '{QUALITY_RULE_VERSION}', '{d}')"
                          for n, c, o, s, d in QUALITY_RULES)


@query("quality_rules", build(f"""
    SELECT r.*, q.passed FROM (VALUES {_RULES_VALUES})
      AS r(rule_name, contract_name, owner, severity, rule_version, description)
    LEFT JOIN qres q USING (rule_name)""", "qres"))
def quality_rules(w: Warehouse) -> DataFrame:
    """Q7: the rule catalogue with owners, severities and this run's outcome."""
    res = quality.quality_results(quality.rule_checks(w.silver, w.fact), DEMO_RUN.run_id, CHECKED_AT)
    return quality.rules_with_results(quality.rule_catalogue(w.spark), res).select(
        "rule_name", "contract_name", "owner", "severity", "rule_version", "description", "passed")


@query("recon_silver_gold", build(f"""
    SELECT '{DEMO_RUN.run_id}' AS run_id, s.n AS silver_rows, g.n AS gold_rows,
           CAST(s.sales AS DOUBLE) AS silver_sales, CAST(g.sales AS DOUBLE) AS gold_sales,
           CAST(s.profit AS DOUBLE) AS silver_profit, CAST(g.profit AS DOUBLE) AS gold_profit,
           s.qty AS silver_quantity, g.qty AS gold_quantity,
           coalesce(abs(coalesce(s.sales, 0) - coalesce(g.sales, 0)) <= {RECON_TOLERANCE}
             AND abs(coalesce(s.profit, 0) - coalesce(g.profit, 0)) <= {RECON_TOLERANCE}
             AND coalesce(s.qty, 0) = coalesce(g.qty, 0), FALSE) AS passed
    FROM (SELECT count(*) AS n, sum(sales) AS sales, sum(profit) AS profit, CAST(sum(quantity) AS BIGINT) AS qty
          FROM silver) s,
         (SELECT count(*) AS n, sum(sales) AS sales, sum(profit) AS profit, CAST(sum(quantity) AS BIGINT) AS qty
          FROM fact) g""", "silver", "fact"))
def recon_silver_gold(w: Warehouse) -> DataFrame:
    """Q8: the reconciliation row (counts and sums on both sides)."""
    return quality.reconciliation_row(w.silver, w.fact, DEMO_RUN.run_id)


@query("integrity_counts", build("""
    SELECT s.n AS silver_rows, f.n AS fact_rows, abs(s.n - f.n) AS difference
    FROM (SELECT count(*) AS n FROM silver) s, (SELECT count(*) AS n FROM fact) f""", "silver", "fact"))
def integrity_counts(w: Warehouse) -> DataFrame:
    """Q10: silver and fact row counts and their difference."""
    return quality.integrity_counts(w.silver, w.fact)


@query("table_counts", build("""
    SELECT 'dim_customers' AS table_name, count(*) AS total_rows FROM dim_customers
    UNION ALL SELECT 'dim_date', count(*) FROM dim_date
    UNION ALL SELECT 'dim_location', count(*) FROM dim_location
    UNION ALL SELECT 'dim_products', count(*) FROM dim_products
    UNION ALL SELECT 'fact_sales', count(*) FROM fact ORDER BY table_name""",
    "dim_customers", "dim_date", "dim_location", "dim_products", "fact"))
def table_counts(w: Warehouse) -> DataFrame:
    """Q11: row counts of the star's tables."""
    return quality.table_counts({"dim_customers": w.dim_customers, "dim_products": w.dim_products,
                                 "dim_location": w.dim_location, "dim_date": w.dim_date, "fact_sales": w.fact})


# ---- incremental control (C1-C7): one delivery per order month -------------------------------------------

def _deliveries(w: Warehouse) -> DataFrame:
    """The monthly deliveries of bronze: one run per order month (a few hundred rows at most,
    since it grows with the date range, not the volume), stored once."""
    month = F.trunc(F.to_date(col("Order Date"), "M/d/yyyy"), "month")
    return w._layer("control/deliveries", lambda: w.bronze.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("bronze_rows")).select(
        "month", F.row_number().over(Window.orderBy("month")).cast("long").alias("run_seq"),
        F.concat(F.lit("run-"), F.date_format("month", "yyyyMM")).alias("run_id"),
        F.lit(PIPELINE_NAME).alias("pipeline_name"), "bronze_rows"))


def _runs(w: Warehouse, gold: bool = False) -> DataFrame:
    """The monthly deliveries with what each left in silver and, if asked for, in gold."""
    deliveries = _deliveries(w)              # stores the extract, of which silver is made too
    s = w.silver.groupBy(F.trunc("order_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.max("order_date").alias("max_order_date"))
    j = deliveries.join(s, "month", "left").withColumn("silver_rows", F.coalesce("silver_rows", F.lit(0)))
    if gold:
        f = w.fact.groupBy(F.trunc("order_date", "month").alias("month")).agg(F.count(F.lit(1)).alias("gold_rows"))
        j = j.join(f, "month", "left").withColumn("gold_rows", F.coalesce("gold_rows", F.lit(0)))
    return j.withColumn("replay", F.col("run_seq") % REPLAY_EVERY == 0)


@query("watermark_advance", build("SELECT * FROM wm", "wm"))
def watermark_advance(w: Warehouse) -> DataFrame:
    """Watermark after each run; GREATEST never moves it back, replays do not advance it."""
    return control.running_watermarks(_runs(w))


def _wm_log(w: Warehouse) -> DataFrame:
    wm = control.running_watermarks(_runs(w)).filter(F.col("watermark_date").isNotNull())
    return wm.select("pipeline_name", "watermark_date",
                     F.timestamp_add("MINUTE", F.col("run_seq"), F.lit(LEDGER_BASE).cast("timestamp_ntz"))
                     .alias("updated_at"))


@query("watermark_current", build("""
    SELECT pipeline_name, watermark_date FROM (
      SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY run_seq DESC) AS rn
      FROM wm WHERE watermark_date IS NOT NULL) WHERE rn = 1""", "wm"))
def watermark_current(w: Warehouse) -> DataFrame:
    """The current watermark per pipeline from the watermark log."""
    return control.watermark(_wm_log(w))


@query("overlap_window", build("""
    SELECT run_id, run_seq,
           CAST(lag(watermark_date) OVER (PARTITION BY pipeline_name ORDER BY run_seq) - INTERVAL 2 DAY AS DATE) AS start_date
    FROM wm""", "wm"))
def overlap_window(w: Warehouse) -> DataFrame:
    """Each incremental run starts two days before the previous run's watermark."""
    wm = control.running_watermarks(_runs(w))
    prev = F.lag("watermark_date").over(Window.partitionBy("pipeline_name").orderBy("run_seq"))
    return wm.select("run_id", "run_seq", control.overlap_start(prev).alias("start_date"))


@query("run_ledger", build(f"""
    SELECT run_id, pipeline_name,
           TIMESTAMP '{LEDGER_BASE}' + to_minutes(CAST(run_seq * 2 AS BIGINT)) AS started_at,
           TIMESTAMP '{LEDGER_BASE}' + to_minutes(CAST(run_seq * 2 + 1 AS BIGINT)) AS finished_at,
           CASE WHEN silver_rows = 0 THEN 'NOOP' ELSE 'SUCCESS' END AS status,
           bronze_rows, silver_rows, gold_rows, CAST(NULL AS VARCHAR) AS error_message
    FROM runs""", "runs"))
def run_ledger(w: Warehouse) -> DataFrame:
    """STARTED then SUCCESS / NOOP events per run, folded to the latest state."""
    r = _runs(w, gold=True)
    base = F.lit(LEDGER_BASE).cast("timestamp_ntz")
    started = r.select("run_id", "pipeline_name", F.timestamp_add("MINUTE", F.col("run_seq") * 2, base).alias("event_at"),
                       F.lit("STARTED").alias("status"), F.lit(None).cast("long").alias("bronze_rows"),
                       F.lit(None).cast("long").alias("silver_rows"), F.lit(None).cast("long").alias("gold_rows"),
                       F.lit(None).cast("string").alias("error_message"))
    done = r.select("run_id", "pipeline_name",
                    F.timestamp_add("MINUTE", F.col("run_seq") * 2 + 1, base).alias("event_at"),
                    F.when(F.col("silver_rows") == 0, "NOOP").otherwise("SUCCESS").alias("status"),
                    "bronze_rows", F.col("silver_rows").cast("long"), F.col("gold_rows").cast("long"),
                    F.lit(None).cast("string").alias("error_message"))
    return control.ledger(started.unionByName(done))


@query("replay_window", build(f"""
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_key, count(*) AS lines,
           CAST(round(sum(sales), 2) AS DOUBLE) AS total_sales
    FROM fact WHERE order_date BETWEEN DATE '{REPLAY_WINDOW[0]}' AND DATE '{REPLAY_WINDOW[1]}' GROUP BY 1""", "fact"))
def replay_window(w: Warehouse) -> DataFrame:
    """An explicit backfill window; the year predicate prunes fact partitions."""
    lo, hi = REPLAY_WINDOW
    f = w.fact_partitioned.filter((F.col("order_year") >= int(lo[:4])) & (F.col("order_year") <= int(hi[:4]))
                                  & F.col("order_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
    return f.groupBy(F.trunc("order_date", "month").alias("month_key")).agg(
        F.count(F.lit(1)).alias("lines"), round2(F.sum("sales")).alias("total_sales"))



# ---- replay of a year (S8, C5), run decisions (B14, C4, C6, Q9) ---------------------------------------
REPLAYED_YEAR = 1996

CTES.update({
    "modes": (["runs"], """
      SELECT run_id, run_seq, CASE run_seq % 6 WHEN 0 THEN 'full' WHEN 1 THEN 'append' WHEN 2 THEN 'upsert'
               WHEN 3 THEN 'snapshot' WHEN 4 THEN 'merge' END AS mode,
             run_seq % 5 = 0 AS replay, month AS start_date, last_day(month) AS end_date,
             CASE WHEN run_seq % 7 = 0 THEN 0 ELSE silver_rows END AS window_rows FROM runs"""),
})


def _mode_runs(w: Warehouse) -> DataFrame:
    """The monthly deliveries with the mode each is asked to load in (one of them unknown, one
    missing), its window, and the rows in it (every seventh delivery came without any)."""
    seq = F.col("run_seq")
    mode = (F.when(seq % 6 == 0, "full").when(seq % 6 == 1, "append").when(seq % 6 == 2, "upsert")
             .when(seq % 6 == 3, "snapshot").when(seq % 6 == 4, "merge"))
    return _runs(w).select("run_id", "run_seq", mode.alias("mode"), (seq % 5 == 0).alias("replay"),
                           F.col("month").alias("start_date"), F.last_day("month").alias("end_date"),
                           F.when(seq % 7 == 0, F.lit(0)).otherwise(F.col("silver_rows")).alias("window_rows"))


@query("fact_partition_overwrite", build(f"""
    SELECT * REPLACE ({_dbl('sales', 'discount', 'profit')}, CASE WHEN year(order_date) = {REPLAYED_YEAR}
                      THEN quantity + 1 ELSE quantity END AS quantity)
    FROM fact WHERE year(order_date) IS DISTINCT FROM {REPLAYED_YEAR} OR row_id % 11 <> 0""", "fact"))
def fact_partition_overwrite(w: Warehouse) -> DataFrame:
    """One year recomputed from a silver in which it changed (quantities one higher, every
    eleventh row gone), written alone; the files of all other years stay where they are."""
    changed = w.silver.filter((F.year("order_date") == REPLAYED_YEAR) & (F.col("row_id") % 11 != 0)).withColumn(
        "quantity", F.col("quantity") + 1)
    fresh = facts.fact_sales(changed, w.dim_customers, w.dim_products, w.dim_location, dims.scd2_current_keys(w.scd2))
    table = f"{w.store}/scenario/replayed_fact"
    if store.current_version(w.spark, table) is None:
        with store.shuffled_into(w.spark, w.tasks):
            whole = store.stage_parts(w.fact_partitioned.sortWithinPartitions("order_year", "order_date"), table, "order_year")
            now = store.stage_parts(facts.with_order_year(fresh), table, "order_year", whole, [str(REPLAYED_YEAR)])
        store.commit(w.spark, table, now)
    return store.read_current(w.spark, table).select(*facts.FACT_COLUMNS)


@query("load_mode_check", build("""
    SELECT run_id, mode, coalesce(mode IN ('full', 'append', 'upsert', 'snapshot'), FALSE) AS accepted FROM modes""",
    "modes"))
def load_mode_check(w: Warehouse) -> DataFrame:
    """Whether each delivery's load mode is a known one."""
    return _mode_runs(w).select("run_id", "mode", bronze_ops.load_mode_known(F.col("mode")).alias("accepted"))


@query("noop_decisions", build("""
    SELECT run_id, mode, replay, CAST(window_rows AS BIGINT) AS window_rows,
           coalesce(window_rows = 0 AND mode IN ('append', 'upsert') AND NOT replay, FALSE) AS noop FROM modes""",
    "modes"))
def noop_decisions(w: Warehouse) -> DataFrame:
    """C4: deliveries that change nothing downstream."""
    runs = _mode_runs(w).select("run_id", "mode", "replay", F.col("window_rows").cast("long"))
    return control.noop_decisions(runs)


@query("rebuild_scopes", build("""
    SELECT run_id, mode, CASE WHEN mode NOT IN ('append', 'upsert') THEN start_date END AS rebuild_start,
           CASE WHEN mode NOT IN ('append', 'upsert') THEN end_date END AS rebuild_end FROM modes""", "modes"))
def rebuild_scopes(w: Warehouse) -> DataFrame:
    """The dates silver is rebuilt for (append and upsert rebuild all of bronze)."""
    return control.rebuild_scopes(_mode_runs(w))


@query("policy_outcomes", build("""
    SELECT run_id, failure_mode, count(*) AS rules, coalesce(string_agg(rule_name, ', ' ORDER BY rule_name) FILTER (WHERE NOT passed), '')
             AS failed_rules,
           CASE WHEN bool_and(passed) THEN 'publish' WHEN failure_mode = 'STOP' THEN 'stop'
                WHEN failure_mode = 'WARN' THEN 'publish_with_warning' ELSE 'publish_with_quarantine' END AS outcome
    FROM qres, (VALUES ('STOP'), ('WARN'), ('QUARANTINE')) m(failure_mode) GROUP BY run_id, failure_mode""", "qres"))
def policy_outcomes(w: Warehouse) -> DataFrame:
    """Q9: what the rule results lead to under each failure mode."""
    results = quality.quality_results(quality.rule_checks(w.silver, w.fact), DEMO_RUN.run_id, CHECKED_AT)
    return quality.policy_outcomes(results)


# ---- schema registry over the monthly deliveries (B2, B3) ----------------------------------------------
# Each monthly delivery carries a header; every tenth adds a column, every tenth offset by
# five drops the optional "Postal Code", and deliveries 7 (mod 20) lack the required
# "Profit" (scenario rule, deterministic in the run sequence).
SOURCE_NAME = "sales_extract.csv"
_STD = ",".join(SOURCE_COLUMNS)
_ADDED = ",".join(SOURCE_COLUMNS + ["Row Note"])
_DROPPED = ",".join(c for c in SOURCE_COLUMNS if c != "Postal Code")
_BROKEN = ",".join(c for c in SOURCE_COLUMNS if c != "Profit")

CTES.update({
    "obs": (["runs"], f"""
      SELECT '{SOURCE_NAME}' AS source_name, run_id, run_seq,
             TIMESTAMP '{LEDGER_BASE}' + to_minutes(CAST(run_seq AS BIGINT)) AS observed_at,
             CASE WHEN run_seq % 10 = 0 THEN '{_ADDED}' WHEN run_seq % 10 = 5 THEN '{_DROPPED}'
                  WHEN run_seq % 20 = 7 THEN '{_BROKEN}' ELSE '{_STD}' END AS columns FROM runs"""),
    "obs_h": (["obs"], """
      SELECT *, lag(schema_hash) OVER w AS previous_hash,
             coalesce(lag(schema_hash) OVER w <> schema_hash, FALSE) AS changed FROM (
        SELECT *, sha256(columns) AS schema_hash FROM obs) WINDOW w AS (PARTITION BY source_name ORDER BY observed_at)"""),
    "obs_v": (["obs_h"], """
      SELECT *, CAST(1 + sum(CAST(changed AS INTEGER)) OVER (PARTITION BY source_name ORDER BY observed_at
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS schema_version FROM obs_h"""),
})


#: The deliveries' headers, and the condition on the run sequence under which each is delivered.
_HEADERS = [(SOURCE_COLUMNS + ["Row Note"], "run_seq % 10 = 0"),
            ([c for c in SOURCE_COLUMNS if c != "Postal Code"], "run_seq % 10 = 5"),
            ([c for c in SOURCE_COLUMNS if c != "Profit"], "run_seq % 20 = 7"),
            (SOURCE_COLUMNS, "not (run_seq % 10 = 0 or run_seq % 10 = 5 or run_seq % 20 = 7)")]


def _deliver(w: Warehouse, path: str) -> None:
    """Write the landed extract as one delivery per order month: gzipped CSV files of bounded size,
    each with the header of its delivery. A task writes the months it reads, so the rows are
    not exchanged."""
    month = F.trunc(F.to_date(col("Order Date"), "M/d/yyyy"), "month")
    runs = F.broadcast(_deliveries(w).select("month", "run_seq"))             # one row per month
    for k, (names, condition) in enumerate(_HEADERS):
        rows = w.extract.withColumn("month", month).join(runs.filter(condition), "month")
        files.write_extract_csv(rows.select("run_seq", *[
            col(c) if c in SOURCE_COLUMNS else F.lit(None).cast("string").alias(c) for c in names]),
            f"{path}/header={k}", "gzip", ["run_seq"])


def _observations(w: Warehouse) -> DataFrame:
    """The header of every delivery, read from the files it consists of."""
    path = f"{w.store}/landing/deliveries"
    if not store.exists(w.spark, f"{path}/_DONE"):
        with store.shuffled_into(w.spark, w.tasks):
            _deliver(w, path)
        store.write_text(w.spark, f"{path}/_DONE", "")
    heads = files.file_headers(w.spark, path).select(F.col("run_seq").cast("long").alias("run_seq"), "columns").distinct()
    return heads.join(_deliveries(w).select("run_id", "run_seq"), "run_seq").select(
        F.lit(SOURCE_NAME).alias("source_name"), "run_id",
        F.timestamp_add("MINUTE", F.col("run_seq"), F.lit(LEDGER_BASE).cast("timestamp_ntz")).alias("observed_at"), "columns")


@query("schema_hash", build("SELECT source_name, run_id, columns, sha256(columns) AS schema_hash FROM obs", "obs"))
def schema_hash(w: Warehouse) -> DataFrame:
    """B2: sha256 of the comma-joined header of every delivery."""
    return contract.with_schema_hash(_observations(w)).select("source_name", "run_id", "columns", "schema_hash")


@query("schema_drift_events", build("""
    SELECT source_name, run_id, previous_hash, schema_hash AS new_hash, observed_at AS detected_at
    FROM obs_h WHERE changed""", "obs_h"))
def schema_drift_events(w: Warehouse) -> DataFrame:
    """A change row whenever a delivery's header hash differs from the previous one."""
    h = contract.drift_history(_observations(w))
    return h.filter("changed").select("source_name", "run_id", "previous_hash",
                                      F.col("schema_hash").alias("new_hash"), F.col("observed_at").alias("detected_at"))


@query("schema_versions", build("""
    SELECT source_name, schema_hash, columns, schema_version, observed_at FROM (
      SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY observed_at DESC) AS rn FROM obs_v)
    WHERE rn = 1""", "obs_v"))
def schema_versions(w: Warehouse) -> DataFrame:
    """The registry (latest hash, columns and version per source; version +1 per change)."""
    return contract.registry(contract.drift_history(_observations(w)))


_REQ_LIST = "[" + ", ".join(f"'{c}'" for c in REQUIRED_SOURCE_COLUMNS) + "]"


@query("contract_check", build(f"""
    SELECT source_name, run_id, len(missing) = 0 AS passed, array_to_string(missing, ', ') AS missing_columns
    FROM (SELECT source_name, run_id,
                 list_sort(list_filter({_REQ_LIST}, lambda c: NOT list_contains(string_split(columns, ','), c))) AS missing
          FROM obs)""", "obs"))
def contract_check(w: Warehouse) -> DataFrame:
    """B1 per delivery: required columns missing from its header (sorted), extras allowed."""
    return contract.contract_report(_observations(w))
