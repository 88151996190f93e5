"""Catalogue entries for bronze and silver: CDC, load modes, snapshots, silver filters,
quarantine, profile, reconciliation, key integrity and the CSV round trip."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.operators import bronze as bronze_ops
from shelfmart.operators import cdc
from shelfmart.operators import silver as silver_ops
from shelfmart.plans.catalog import _dbl, query
from shelfmart.plans.oracle import CTES, SRC_COLS, build, silver_select
from shelfmart.plans.warehouse import DEMO_RUN, Warehouse
from shelfmart.sources import files, store

# Scenario parameters: the second delivery and an explicit silver window.
CDC_RUN = replace(DEMO_RUN, run_id="00000000-0000-7000-8000-000000000002",
                  ingested_at="2024-01-02 00:00:00", source_file="sales_extract_2.csv")
DETECTED_AT = CDC_RUN.ingested_at
WINDOW_RUN = replace(DEMO_RUN, start_date="1996-01-01", end_date="1996-12-31")

_differs = " OR ".join(f"e.{c} IS DISTINCT FROM i.{c}" for c in SRC_COLS[1:])
CTES.update({
    "cdc_all": (["previous", "incoming_dedup"], f"""
      SELECT coalesce(i."Row ID", e."Row ID") AS row_id,
             CASE WHEN e."Row ID" IS NULL THEN 'INSERT' WHEN i."Row ID" IS NULL THEN 'DELETE'
                  WHEN {_differs} THEN 'UPDATE' END AS operation
      FROM previous e FULL OUTER JOIN incoming_dedup i ON e."Row ID" = i."Row ID\""""),
    "cdc_ev": (["cdc_all"], f"""
      SELECT '{CDC_RUN.run_id}' AS run_id, row_id, operation, TIMESTAMP '{DETECTED_AT}' AS detected_at
      FROM cdc_all WHERE operation IS NOT NULL"""),
    "deletions": (["cdc_ev"], "SELECT run_id, row_id, detected_at FROM cdc_ev WHERE operation = 'DELETE'"),
    "upsert_state": (["previous", "incoming", "incoming_dedup"], """
      SELECT * FROM previous p WHERE NOT EXISTS (SELECT 1 FROM incoming i WHERE i."Row ID" = p."Row ID")
      UNION ALL SELECT * FROM incoming_dedup"""),
    "silver_window": (["bronze"], silver_select(
        "bronze", """AND CAST(strptime("Order Date", '%m/%d/%Y') AS DATE) >= DATE '1996-01-01'
                     AND CAST(strptime("Order Date", '%m/%d/%Y') AS DATE) <= DATE '1996-12-31'""")),
})

_SILVER_DBL = _dbl("sales", "discount", "profit")


# ---- CDC (B4-B8) -----------------------------------------------------------------------------

def _events(w: Warehouse, mode: str = "upsert") -> DataFrame:
    return cdc.events(w.changes(mode), CDC_RUN.run_id, DETECTED_AT)


@query("cdc_events", build("SELECT * FROM cdc_ev", "cdc_ev"))
def cdc_events(w: Warehouse) -> DataFrame:
    """The whole change log of the second delivery, one full outer join."""
    return _events(w)


@query("cdc_inserts", build("SELECT * FROM cdc_ev WHERE operation = 'INSERT'", "cdc_ev"))
def cdc_inserts(w: Warehouse) -> DataFrame:
    """Keys that arrive for the first time."""
    return _events(w).filter(F.col("operation") == "INSERT")


@query("cdc_updates", build("SELECT * FROM cdc_ev WHERE operation = 'UPDATE'", "cdc_ev"))
def cdc_updates(w: Warehouse) -> DataFrame:
    """Keys whose row changed (null-safe comparison of every column)."""
    return _events(w).filter(F.col("operation") == "UPDATE")


@query("cdc_deletes", build("SELECT * FROM cdc_ev WHERE operation = 'DELETE'", "cdc_ev"))
def cdc_deletes(w: Warehouse) -> DataFrame:
    """Stored keys missing from the delivery."""
    return _events(w).filter(F.col("operation") == "DELETE")


@query("cdc_summary", build("SELECT operation, count(*) AS events FROM cdc_ev GROUP BY operation", "cdc_ev"))
def cdc_summary(w: Warehouse) -> DataFrame:
    """Events per operation."""
    return cdc.summary(_events(w))


@query("cdc_events_append", build("SELECT * FROM cdc_ev WHERE operation <> 'DELETE'", "cdc_ev"))
def cdc_events_append(w: Warehouse) -> DataFrame:
    """B7 in append mode: a partial file does not delete, so no DELETE events."""
    return _events(w, "append")


@query("source_deletions", build("SELECT * FROM deletions", "deletions"))
def source_deletions(w: Warehouse) -> DataFrame:
    """Deletions recorded by an upsert load."""
    return cdc.source_deletions(_events(w), "upsert")


# ---- load modes (B9-B11) --------------------------------------------

@query("load_full", build("SELECT * FROM incoming_dedup", "incoming_dedup"))
def load_full(w: Warehouse) -> DataFrame:
    """Full load replaces bronze with the deduplicated delivery."""
    return bronze_ops.apply_load(w.previous, w.incoming_dedup, "full", deduplicated=True)


@query("load_append", build("SELECT * FROM upsert_state", "upsert_state"))
def load_append(w: Warehouse) -> DataFrame:
    """Stored rows with an arriving key are replaced, all others kept."""
    return bronze_ops.apply_load(w.previous, w.incoming_dedup, "append", deduplicated=True)


@query("load_upsert", build("SELECT * FROM upsert_state", "upsert_state"))
def load_upsert(w: Warehouse) -> DataFrame:
    """Physically the append result (deletions are recorded, see source_deletions)."""
    return bronze_ops.apply_load(w.previous, w.incoming_dedup, "upsert", deduplicated=True)


# ---- silver filters, quarantine, profile (V1-V15) ----------------------------------------------

@query("silver_soft_delete", build(
    f"SELECT * REPLACE ({_SILVER_DBL}) FROM (" + silver_select(
        "upsert_state", 'AND NOT EXISTS (SELECT 1 FROM deletions d WHERE d.row_id = "Row ID")',
        run_id=CDC_RUN.run_id, ts=CDC_RUN.ingested_at, source_file=CDC_RUN.source_file) + ")",
    "upsert_state", "deletions"))
def silver_soft_delete(w: Warehouse) -> DataFrame:
    """V9: silver after an upsert hides the rows deleted in this run, which the classified stream
    of the load marks."""
    return silver_ops.clean(w.changes("upsert"), CDC_RUN)


@query("silver_window", build(f"SELECT * REPLACE ({_SILVER_DBL}) FROM silver_window", "silver_window"))
def silver_window(w: Warehouse) -> DataFrame:
    """Inclusive optional date window on the typed order date."""
    return silver_ops.clean(w.bronze_dated, WINDOW_RUN)


@query("source_window_count", build("""
    SELECT count(*) AS source_rows FROM bronze WHERE "Order ID" IS NOT NULL
      AND CAST(strptime("Order Date", '%m/%d/%Y') AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
    "bronze"))
def source_window_count(w: Warehouse) -> DataFrame:
    """Bronze rows a windowed silver build must keep."""
    return silver_ops.window_count(w.bronze_dated, start=WINDOW_RUN.start_date, end=WINDOW_RUN.end_date)


@query("recon_bronze_silver", build("""
    SELECT b.n AS bronze_rows, s.n AS silver_rows, b.n = s.n AS passed
    FROM (SELECT count(*) AS n FROM bronze WHERE "Order ID" IS NOT NULL
            AND CAST(strptime("Order Date", '%m/%d/%Y') AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31') b,
         (SELECT count(*) AS n FROM silver_window) s""", "bronze", "silver_window"))
def recon_bronze_silver(w: Warehouse) -> DataFrame:
    """Bronze and silver counts under the same predicate."""
    return silver_ops.reconcile_bronze_silver(
        w.bronze_dated, silver_ops.clean(w.bronze_dated, WINDOW_RUN), WINDOW_RUN)


_REASON = """CASE WHEN quantity <= 0 THEN 'quantity <= 0'
                  WHEN discount NOT BETWEEN 0 AND 1 THEN 'discount outside [0,1]'
                  WHEN sales < 0 THEN 'sales < 0' END"""


@query("quarantine_rows", build(f"""
    SELECT * REPLACE ({_SILVER_DBL}) FROM (SELECT *, {_REASON} AS reason FROM silver)
    WHERE reason IS NOT NULL""", "silver"))
def quarantine_rows(w: Warehouse) -> DataFrame:
    """Copies of invalid rows with the first matching reason."""
    return silver_ops.quarantine(w.silver)


@query("quarantine_summary", build(f"""
    SELECT reason, count(*) AS rows FROM (SELECT {_REASON} AS reason FROM silver)
    WHERE reason IS NOT NULL GROUP BY reason""", "silver"))
def quarantine_summary(w: Warehouse) -> DataFrame:
    """Quarantined rows per reason."""
    return silver_ops.quarantine_summary(silver_ops.quarantine(w.silver))


_PROFILE_SQL = """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE "Order ID" IS NULL) AS null_order_ids,
           count(*) - count(DISTINCT "Row ID") AS duplicate_row_ids FROM src"""


@query("profile_metrics", build(_PROFILE_SQL, "src"))
def profile_metrics(w: Warehouse) -> DataFrame:
    """V1: row count, null order ids and duplicated keys of the landed extract."""
    return silver_ops.profile(w.extract)


@query("profile_metrics_long", build(f"""
    SELECT '{DEMO_RUN.run_id}' AS run_id, metric_name, metric_value FROM (
      UNPIVOT ({_PROFILE_SQL}) ON total_rows, null_order_ids, duplicate_row_ids
      INTO NAME metric_name VALUE metric_value)""", "src"))
def profile_metrics_long(w: Warehouse) -> DataFrame:
    """V2: the profile as (run_id, metric_name, metric_value) rows."""
    return silver_ops.profile_long(silver_ops.profile(w.extract), DEMO_RUN.run_id)


@query("src_csv_scan", build("SELECT * FROM src", "src"))
def src_csv_scan(w: Warehouse) -> DataFrame:
    """The extract written as an ISO-8859-1 CSV with header (gzipped files of bounded size),
    then scanned with the explicit text schema after the header passed the contract."""
    path = f"{w.store}/landing/extract_csv" if w.store else None
    if path is None:
        return w.extract
    with store.shuffled_into(w.spark, w.tasks):
        files.write_extract_csv(w.landing_rows(), path, "gzip")
    return files.read_extract_csv(w.spark, path)


@query("dedup_previous", build("SELECT * FROM previous", "previous"))
def dedup_previous(w: Warehouse) -> DataFrame:
    """B13 on the previous delivery (its own duplicate keys)."""
    return w.previous



@query("ingest_microbatch", build("SELECT * FROM bronze", "bronze"))
def ingest_microbatch(w: Warehouse) -> DataFrame:
    """The extract dealt into files (six, or as many as keep them bounded; a key may be in
    several), landed a third of the files per micro-batch by a Structured Streaming file source
    and merged once after the drain."""
    from shelfmart.streaming.ingest import ingest_microbatch as run_ingest, stage_in_turn
    if w.store is None:
        return w.bronze
    src, table = f"{w.store}/landing/stream_files", f"{w.store}/scenario/stream_bronze"
    if store.current_version(w.spark, table) is None:
        with store.shuffled_into(w.spark, w.tasks):
            n_files = stage_in_turn(w.landing_rows(), src, 6)
            run_ingest(w.spark, f"{src}/*", table, f"{w.store}/scenario/stream_checkpoint", -(-n_files // 3))
    return store.read_current(w.spark, table)


@query("source_fingerprint")
def source_fingerprint(w: Warehouse) -> DataFrame:
    """Length and digest of the landed files (their names differ from run to run, so the
    result is checked against the files themselves in the tests). The digests are those of files
    by key, so the stored extract is landed here."""
    path = f"{w.store}/landing/extract_csv"
    files.write_extract_csv(w.extract, path, "gzip")
    return store.content_fingerprint(w.spark, path).select("length", "sha256")


@query("versioned_replace", build("""
    SELECT *, CAST(2 AS BIGINT) AS version FROM incoming_dedup""", "incoming_dedup"))
def versioned_replace(w: Warehouse) -> DataFrame:
    """The stored snapshot, replaced by a version that was made while reading it."""
    table = f"{w.store}/scenario/replaced"
    if store.current_version(w.spark, table) != 2:
        store.delete(w.spark, table)
        store.publish(w.previous, table)
        live = store.read_current(w.spark, table)
        store.publish(bronze_ops.apply_load(live, w.incoming_dedup, "full", deduplicated=True), table)
    return store.read_current(w.spark, table).withColumn(
        "version", F.lit(store.current_version(w.spark, table)).cast("long"))
