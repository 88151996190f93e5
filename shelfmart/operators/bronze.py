"""Bronze: deterministic dedup by key and the four load modes (full/append/upsert/snapshot)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmart.config import LOAD_MODES, SOURCE_DATE_FORMAT, SOURCE_FILE, SOURCE_KEY
from shelfmart.functions.columns import col, parse_source_date, rows_differ

ORDER_DAY, ORDER_YEAR = "_order_day", "_order_year"


def check_load_mode(mode: str) -> str:
    if mode not in LOAD_MODES:
        raise ValueError(f"{mode!r} is not a load mode; known are {', '.join(LOAD_MODES)}")
    return mode


def load_mode_known(mode: Column) -> Column:
    """B14 as data."""
    return F.coalesce(mode.isin(*LOAD_MODES), F.lit(False))


def with_order_day(extract: DataFrame, lenient: bool = False) -> DataFrame:
    """The landed text rows with their typed order date and its year, by which the stored
    table is partitioned so that date windows prune files and row groups. ``lenient``: a text
    that is no date gives a null day instead of an error."""
    day = (F.try_to_date(col("Order Date"), SOURCE_DATE_FORMAT) if lenient else parse_source_date(col("Order Date")))
    return extract.withColumn(ORDER_DAY, day).withColumn(ORDER_YEAR, F.year(day))


def dedup_by_key(df: DataFrame, key: str = SOURCE_KEY) -> DataFrame:
    """One row per key: the greatest full row (columns compared in order, null lowest).

    Written as an aggregation, not a window: the map side keeps one candidate per key
    before the shuffle, so a key repeated across a third of the input still reaches the
    reducer as one row per map task.
    """
    others = [c for c in df.columns if c != key]
    agg = df.groupBy(col(key).alias(key)).agg(
        F.max(F.struct(*[col(c) for c in others])).alias("_row"))
    return agg.select(*[col(key) if c == key else F.col("_row").getField(c).alias(c)
                        for c in df.columns])


def snapshot_rows(extract: DataFrame, run_id: str, snapshot_at: str) -> DataFrame:
    """Rows appended to the snapshot history: the extract plus run id and time."""
    return (extract.withColumn("snapshot_run_id", F.lit(run_id))
                   .withColumn("snapshot_at", F.lit(snapshot_at).cast("timestamp_ntz")))


# ---- one classified stream per load (B4-B12) ----------------------------------------------------

CHANGE, LIVE, OLD = "_change", "_live", "_old"
KEEP, INSERT, UPDATE, DELETE = "KEEP", "INSERT", "UPDATE", "DELETE"


def changes(existing: DataFrame | None, delivery: DataFrame, mode: str, key: str = SOURCE_KEY,
            window: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Every key of the stored state or the delivery, once, with what the load does to it.

    Columns: the row as it is after the load (of a deleted key, as it was), then CHANGE
    (KEEP, INSERT, UPDATE, DELETE), LIVE (in the state after the load) and OLD (the stored
    row that an UPDATE replaced, else null). Events, deletions, the new state and the rows
    before and after are projections of it, so one full outer join serves them all; when
    both sides are bucketed by the key it needs no exchange.

    Both sides hold one row per key and no null key. Rows are compared null-safe in all
    columns but the name of the file they came in; a changed set of columns changes every row.
    full / snapshot: a key that does not arrive is a DELETE and leaves the state.
    upsert: it is a DELETE, recorded and hidden for this run, and stays in the state.
    append: a partial file deletes nothing; it is a KEEP.
    With a ``window`` of order dates the delivery speaks for that window alone: a stored row
    outside it that does not arrive is a KEEP in every mode.
    """
    check_load_mode(mode)
    if existing is None:
        none = F.lit(None).cast(delivery.schema)
        return delivery.select("*", F.lit(INSERT).alias(CHANGE), F.lit(True).alias(LIVE), none.alias(OLD))
    before, after = existing.columns, delivery.columns
    e = existing.select(*[col(c).alias(f"e_{n}") for n, c in enumerate(before)])
    d = delivery.select(*[col(c).alias(f"d_{n}") for n, c in enumerate(after)])
    e_of, d_of = ({c: F.col(f"{side}_{n}") for n, c in enumerate(names)} for side, names in (("e", before), ("d", after)))
    arrived, stored = d_of[key].isNotNull(), e_of[key].isNotNull()
    compared, others = ([c for c in names if c != SOURCE_FILE] for names in (before, after))
    differs = rows_differ([e_of[c] for c in compared], [d_of[c] for c in compared]) if compared == others else F.lit(True)
    missing, spoken_for = (KEEP if mode == "append" else DELETE), F.lit(True)
    for bound, at_least in zip(window, (True, False)):
        if bound is not None:
            day, limit = F.try_to_date(e_of["Order Date"], SOURCE_DATE_FORMAT), F.lit(bound).cast("date")
            spoken_for = spoken_for & F.coalesce(day >= limit if at_least else day <= limit, F.lit(False))
    change = F.when(~stored, INSERT).when(~arrived, F.when(spoken_for, missing).otherwise(KEEP)).when(differs, UPDATE).otherwise(KEEP)
    nothing = F.lit(None)
    row = [F.when(arrived, d_of.get(c, nothing)).otherwise(e_of.get(c, nothing)).alias(c)
           for c in [*before, *[c for c in after if c not in before]]]
    image = F.struct(*[e_of[c].alias(c) for c in before])
    return e.join(d, e_of[key] == d_of[key], "full_outer").select(
        *row, change.alias(CHANGE), (F.lit(True) if mode in ("append", "upsert") else arrived | ~spoken_for).alias(LIVE),
        F.when(stored & arrived & differs, image).alias(OLD))


def live(stored: DataFrame) -> DataFrame:
    """The state of a stored classified stream: its live rows, without its bookkeeping columns."""
    rows = stored.filter(F.col(LIVE)) if LIVE in stored.columns else stored
    return rows.drop(CHANGE, LIVE, OLD, ORDER_DAY, ORDER_YEAR)


def years_to_load(stored: DataFrame, delivery: DataFrame, window: tuple[str | None, str | None], mode: str,
                  key: str = SOURCE_KEY) -> DataFrame:
    """(year): the order years whose stored rows an incremental load can change. Those of the
    delivered rows, of stored rows with a delivered key (keys and years alone are read), of
    rows that the last load hid, and, where missing rows are deletions, of the window."""
    year = F.col(ORDER_YEAR).alias("year")
    delivered = with_order_day(delivery, lenient=True).select(year)
    keys = delivery.select(col(key).alias("_k"))
    matched = stored.filter(F.col(LIVE)).join(keys, col(key) == F.col("_k"), "left_semi").select(year)
    hidden = stored.filter(F.col(LIVE) & (F.col(CHANGE) == DELETE)).select(year)
    out = delivered.unionByName(matched).unionByName(hidden)
    if mode == "upsert":
        held = stored.select(year)
        for bound, at_least in zip(window, (True, False)):
            if bound is not None:
                held = held.filter(F.col("year") >= int(bound[:4]) if at_least else F.col("year") <= int(bound[:4]))
        out = out.unionByName(held)
    return out.distinct()


def images(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(before, after): the changed rows of a classified stream as they were and as they are."""
    names = [c for c in stored.columns if c not in (CHANGE, LIVE, OLD, ORDER_DAY, ORDER_YEAR)]
    row = [col(c) for c in names]
    kind, kept = F.col(CHANGE), {f.name for f in stored.schema[OLD].dataType.fields}
    old = [F.when(kind == UPDATE, F.col(OLD).getField(c) if c in kept else F.lit(None)).otherwise(col(c)).alias(c)
           for c in names]
    return (stored.filter(kind.isin(UPDATE, DELETE)).select(*old), stored.filter(kind.isin(INSERT, UPDATE)).select(*row))


def apply_load(existing: DataFrame | None, incoming: DataFrame, mode: str,
               key: str = SOURCE_KEY, deduplicated: bool = False) -> DataFrame:
    """New bronze state after one load.

    full / snapshot: the deduplicated extract replaces everything.
    append / upsert: stored rows whose key arrives again are replaced, the rest kept
    (``changes`` tells the two apart by what it records).
    ``deduplicated`` says ``incoming`` already holds one row per key.
    """
    check_load_mode(mode)
    fresh = incoming if deduplicated else dedup_by_key(incoming, key)
    if mode in ("full", "snapshot") or existing is None:
        return fresh
    return live(changes(existing, fresh, mode, key))
