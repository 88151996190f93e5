"""Change data capture between the stored bronze snapshot and an incoming extract.

One full outer join on the key classifies every key at once (``bronze.changes``); the
log and the deletions are projections of it, like the new state. The incoming side is
deduplicated first so the log describes exactly the rows that get applied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.config import SOURCE_KEY
from shelfmart.functions.columns import col
from shelfmart.operators.bronze import CHANGE, KEEP, changes, check_load_mode, dedup_by_key

EVENT_COLUMNS = ["run_id", "row_id", "operation", "detected_at"]


def classify(existing: DataFrame, incoming: DataFrame, key: str = SOURCE_KEY,
             deduplicated: bool = False) -> DataFrame:
    """(row_id, operation) for every key that changed; unchanged keys are dropped.
    ``existing`` holds one row per key; so does ``incoming`` when ``deduplicated``."""
    fresh = incoming if deduplicated else dedup_by_key(incoming, key)
    return (changes(existing, fresh, "upsert", key).filter(F.col(CHANGE) != KEEP)
            .select(col(key).cast("string").alias("row_id"), F.col(CHANGE).alias("operation")))


def events(classified: DataFrame, run_id: str, detected_at: str, key: str = SOURCE_KEY) -> DataFrame:
    """The change log of a load (run_id, row_id, operation, detected_at), from its classified stream."""
    return classified.filter(F.col(CHANGE) != KEEP).select(
        F.lit(run_id).alias("run_id"), col(key).cast("string").alias("row_id"), F.col(CHANGE).alias("operation"),
        F.lit(detected_at).cast("timestamp_ntz").alias("detected_at"))


def cdc_events(existing: DataFrame, incoming: DataFrame, run_id: str, detected_at: str,
               mode: str = "full", key: str = SOURCE_KEY, deduplicated: bool = False) -> DataFrame:
    """Change log rows (run_id, row_id, operation, detected_at).

    In append mode a key missing from a partial file is not a deletion, so DELETE
    events are not emitted there.
    """
    fresh = incoming if deduplicated else dedup_by_key(incoming, key)
    return events(changes(existing, fresh, mode, key), run_id, detected_at, key)


def summary(events: DataFrame) -> DataFrame:
    return events.groupBy("operation").agg(F.count(F.lit(1)).alias("events"))


def deleted_keys(existing: DataFrame, incoming: DataFrame, run_id: str, detected_at: str, mode: str,
                 key: str = SOURCE_KEY) -> DataFrame:
    """B8 from keys alone: stored keys absent from the delivery (run_id, row_id, detected_at).

    Equal to the DELETE events, but a key-only anti join: no row comparison and only the
    key column crosses the shuffle. Empty in append mode.
    """
    check_load_mode(mode)
    out = (existing.select(col(key).cast("string").alias("row_id")).filter(F.col("row_id").isNotNull())
                   .join(incoming.select(col(key).cast("string").alias("row_id")), "row_id", "left_anti")
                   .select(F.lit(run_id).alias("run_id"), "row_id",
                           F.lit(detected_at).cast("timestamp_ntz").alias("detected_at")))
    return out.filter(F.lit(False)) if mode == "append" else out


def source_deletions(events: DataFrame, mode: str) -> DataFrame:
    """Deletions recorded for full / upsert / snapshot loads (never for append)."""
    check_load_mode(mode)
    out = events.filter(F.col("operation") == "DELETE").select("run_id", "row_id", "detected_at")
    if mode == "append":
        out = out.filter(F.lit(False))
    return out
