"""Source contract (required columns), schema hash and schema-drift registry."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmart.config import REQUIRED_SOURCE_COLUMNS
from shelfmart.errors import ContractError


def check_columns(columns: Iterable[str], required: Iterable[str] = REQUIRED_SOURCE_COLUMNS) -> None:
    """B1: fail before any action when required columns are missing (extras allowed)."""
    missing = sorted(set(required).difference(columns))
    if missing:
        raise ContractError(f"the extract lacks {len(missing)} required column(s): {', '.join(missing)}")


def check(df: DataFrame, required: Iterable[str] = REQUIRED_SOURCE_COLUMNS) -> DataFrame:
    check_columns(df.columns, required)
    return df


def contract_report(observations: DataFrame, required: Iterable[str] = REQUIRED_SOURCE_COLUMNS) -> DataFrame:
    """B1 as data: per observed header (source_name, run_id, columns) whether it passes and
    which required columns are missing, sorted."""
    req = F.array(*[F.lit(c) for c in sorted(set(required))])
    missing = F.array_sort(F.array_except(req, F.split(F.col("columns"), ",")))
    return observations.select("source_name", "run_id", (F.size(missing) == 0).alias("passed"),
                               F.array_join(missing, ", ").alias("missing_columns"))


def schema_text(columns: Iterable[str]) -> str:
    return ",".join(str(c) for c in columns)


def schema_hash(columns: Iterable[str]) -> str:
    """B2 on the driver: sha256 of the comma-joined ordered column names (types ignored)."""
    return hashlib.sha256(schema_text(columns).encode("utf-8")).hexdigest()


def with_schema_hash(observations: DataFrame) -> DataFrame:
    """B2 over a registry frame (source_name, columns, observed_at): adds schema_hash."""
    return observations.withColumn("schema_hash", F.sha2(F.col("columns"), 256))


def drift_history(observations: DataFrame) -> DataFrame:
    """B3 over the observation history: previous hash, change flag and schema version.

    A change is logged only when a previous hash exists and differs; the version starts
    at 1 and increments on every change.
    """
    order = ["observed_at", "run_id"] if "run_id" in observations.columns else ["observed_at"]
    w = Window.partitionBy("source_name").orderBy(*order)
    h = with_schema_hash(observations)
    prev = F.lag("schema_hash").over(w)
    changed = prev.isNotNull() & (prev != F.col("schema_hash"))
    return (h.withColumn("previous_hash", prev).withColumn("changed", F.coalesce(changed, F.lit(False)))
             .withColumn("schema_version",
                         (1 + F.sum(F.col("changed").cast("int")).over(
                             w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).cast("int")))


def drift_events(history: DataFrame) -> DataFrame:
    """One change row per detected drift."""
    return history.filter("changed").select(
        "source_name", "run_id", "previous_hash", F.col("schema_hash").alias("new_hash"),
        F.col("observed_at").alias("detected_at"))


def registry(history: DataFrame) -> DataFrame:
    """Latest registry row per source (hash, columns, version), in the order of ``drift_history``."""
    order = [c for c in ("observed_at", "run_id") if c in history.columns]
    return (history.groupBy("source_name")
                   .agg(F.max_by(F.struct("schema_hash", "columns", "schema_version", "observed_at"),
                                 F.struct(*order)).alias("_r"))
                   .select("source_name", "_r.*"))
