"""Incremental control: watermarks with a late-data overlap, run ledger, windows.

Control state is a set of append-only logs; "current" values are latest-per-key
aggregates over them (``max_by``), never in-place updates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmart.config import DEFAULT_OVERLAP_DAYS

WATERMARK_COLUMNS = ["pipeline_name", "watermark_date", "updated_at"]
LEDGER_COLUMNS = ["run_id", "pipeline_name", "event_at", "status", "bronze_rows", "silver_rows",
                  "gold_rows", "error_message"]


def watermark(log: DataFrame) -> DataFrame:
    """Last watermark per pipeline (the most recently written entry)."""
    return (log.groupBy("pipeline_name")
               .agg(F.max_by("watermark_date", F.struct("updated_at", "watermark_date")).alias("watermark_date")))


def advance(current: DataFrame | None, proposals: DataFrame) -> DataFrame:
    """New log entries; the stored date never moves back (GREATEST skips NULLs).

    ``proposals``: pipeline_name, watermark_date, updated_at, replay (bool). Replays and
    NULL proposals do not advance.
    """
    p = proposals.filter(~F.col("replay") & F.col("watermark_date").isNotNull())
    if current is None:
        return p.select(*WATERMARK_COLUMNS)
    cur = current.select("pipeline_name", F.col("watermark_date").alias("_old"))
    return (p.join(cur, "pipeline_name", "left")
             .select("pipeline_name", F.greatest("_old", "watermark_date").alias("watermark_date"), "updated_at"))


def running_watermarks(runs: DataFrame) -> DataFrame:
    """C2 applied to a run history at once: after run k the watermark is the greatest
    non-replay max_order_date of runs 1..k (``runs``: pipeline_name, run_seq, run_id,
    max_order_date, replay)."""
    w = (Window.partitionBy("pipeline_name").orderBy("run_seq")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    eff = F.when(~F.col("replay"), F.col("max_order_date"))
    return runs.select("pipeline_name", "run_seq", "run_id", F.max(eff).over(w).alias("watermark_date"))


def overlap_start(watermark_date, overlap_days: int = DEFAULT_OVERLAP_DAYS):
    """Incremental runs restart ``overlap_days`` before the watermark (late data)."""
    return F.date_sub(watermark_date, overlap_days)


def noop_decisions(runs: DataFrame) -> DataFrame:
    """C4 over runs (run_id, mode, replay, window_rows): adds ``noop``, true for an incremental run
    that is no replay and whose window is empty. The pipeline asks it for its one run."""
    decided = (F.col("window_rows") == 0) & F.col("mode").isin("append", "upsert") & ~F.col("replay")
    return runs.withColumn("noop", F.coalesce(decided, F.lit(False)))


def rebuild_scopes(runs: DataFrame) -> DataFrame:
    """C6 over runs (run_id, mode, start_date, end_date): the dates that silver is rebuilt for;
    append and upsert rebuild it from all of bronze, full and snapshot keep the window."""
    kept = ~F.col("mode").isin("append", "upsert")
    return runs.select("run_id", "mode", F.when(kept, F.col("start_date")).alias("rebuild_start"),
                       F.when(kept, F.col("end_date")).alias("rebuild_end"))


def ledger(events: DataFrame) -> DataFrame:
    """Latest state per run from STARTED / SUCCESS / NOOP / FAILED events."""
    # at equal times a terminal state (SUCCESS / NOOP / FAILED) follows STARTED
    order = F.struct(F.col("event_at"), (F.col("status") != "STARTED").alias("_terminal"))
    latest = F.max_by(F.struct(*[c for c in LEDGER_COLUMNS if c not in ("run_id",)]), order)
    started = F.min(F.when(F.col("status") == "STARTED", F.col("event_at")))
    finished = F.max(F.when(F.col("status") != "STARTED", F.col("event_at")))
    return (events.groupBy("run_id")
                  .agg(latest.alias("_l"), started.alias("started_at"), finished.alias("finished_at"))
                  .select("run_id", F.col("_l.pipeline_name").alias("pipeline_name"), "started_at",
                          "finished_at", F.col("_l.status").alias("status"),
                          F.col("_l.bronze_rows").alias("bronze_rows"), F.col("_l.silver_rows").alias("silver_rows"),
                          F.col("_l.gold_rows").alias("gold_rows"),
                          F.col("_l.error_message").alias("error_message")))
