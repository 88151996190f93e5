"""End-to-end run: source -> bronze -> silver -> gold -> validation -> control state.

Every table a run makes is staged beside the live version; one write of the warehouse
manifest publishes them together after all checks passed. A failed or stopped run leaves
every published table as it was. Logs hold one part per run, which a repeated run
replaces, and a repeated run starts from the versions its first attempt started from, so
running twice under one run id gives the state of running once. The driver only sees
counts, the rule results and the years a replay touches.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmart.config import DEFAULT_OVERLAP_DAYS, LOCATION_COLUMNS, RECON_TOLERANCE, SOURCE_KEY
from shelfmart.errors import KeyIntegrityError, ReconciliationError
from shelfmart.functions.columns import col
from shelfmart.operators import bronze as bronze_ops
from shelfmart.operators import bi, cdc, contract, control, dims, facts, quality
from shelfmart.operators import silver as silver_ops
from shelfmart.operators.silver import RunContext
from shelfmart.plans.warehouse import run_concurrently
from shelfmart.sources import files, store

LOGGER = logging.getLogger(__name__)
SILVER_READ = "bronze/sales read by silver"      # manifest entry: the bronze version of each year that silver holds
YEAR = "order_year"                 # partition column of the tables that a replay changes year by year


@dataclass(frozen=True)
class PipelineConfig:
    root: str                       # warehouse root (shared storage)
    source_path: str                # CSV extract (file or directory)
    run_id: str
    now: str                        # injected clock, 'yyyy-MM-dd HH:mm:ss'
    load_mode: str = "full"
    start_date: str | None = None
    end_date: str | None = None
    replay: bool = False
    overlap_days: int = DEFAULT_OVERLAP_DAYS
    failure_mode: str = "STOP"
    bad_values: str = "fail"        # a value that cannot be cast fails the run, or 'route': its row is set aside
    pipeline_name: str = "retail_sales"
    source_name: str = field(default="")
    incremental: bool = False       # append and upsert change only the order years they touch; an upsert's
    #                                 delivery then speaks for the window that starts at the overlap alone
    deep_fingerprint: bool = False  # hash source bytes (small sources) instead of listing metadata

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def log(self, name: str) -> str:
        return self.table("control", name)


@dataclass
class RunResult:
    run_id: str
    status: str
    bronze_rows: int = 0
    silver_rows: int = 0
    gold_rows: int = 0
    rejected_rows: int = 0
    failed_rules: list[str] = field(default_factory=list)


def _ledger_event(spark: SparkSession, cfg: PipelineConfig, status: str, at: str, bronze=None, silver=None,
                  gold=None, error: str | None = None) -> None:
    row = [(cfg.run_id, cfg.pipeline_name, status, bronze, silver, gold, error)]
    df = spark.createDataFrame(row, "run_id string, pipeline_name string, status string, bronze_rows long, "
                                    "silver_rows long, gold_rows long, error_message string")
    store.write_log(df.withColumn("event_at", F.lit(at).cast("timestamp_ntz")), cfg.log("pipeline_runs"),
                    f"{cfg.run_id}.{'started' if status == 'STARTED' else 'ended'}")


def run_ledger(spark: SparkSession, root: str) -> DataFrame | None:
    log = store.read_log(spark, f"{root.rstrip('/')}/control/pipeline_runs")
    return None if log is None else control.ledger(log)


def current_watermark(spark: SparkSession, cfg: PipelineConfig):
    log = store.read_log(spark, cfg.log("pipeline_watermarks"))
    if log is None:
        return None
    r = control.watermark(log).filter(F.col("pipeline_name") == cfg.pipeline_name).first()
    return None if r is None else r["watermark_date"]


def _observe_schema(spark: SparkSession, cfg: PipelineConfig, columns: list[str]) -> None:
    """Log this run's header and its drift events, and store the registry."""
    obs = spark.createDataFrame([(cfg.source_name, contract.schema_text(columns))],
                                "source_name string, columns string").withColumn(
        "observed_at", F.lit(cfg.now).cast("timestamp_ntz")).withColumn("run_id", F.lit(cfg.run_id))
    log = cfg.log("source_schema_observations")
    store.write_log(obs, log, cfg.run_id)
    history = contract.drift_history(store.read_log(spark, log))
    store.write_log(contract.drift_events(history).filter(F.col("run_id") == cfg.run_id),
                    cfg.log("source_schema_changes"), cfg.run_id)
    store.write_log(contract.registry(history).filter(F.col("source_name") == cfg.source_name),
                    cfg.log("source_schema_registry"), cfg.source_name)


def run(spark: SparkSession, cfg: PipelineConfig) -> RunResult:
    bronze_ops.check_load_mode(cfg.load_mode)
    if cfg.bad_values not in ("fail", "route"):
        raise ValueError(f"bad_values is 'fail' or 'route', not {cfg.bad_values!r}")
    if not cfg.source_name:
        cfg = replace(cfg, source_name=cfg.source_path.rstrip("/").split("/")[-1])
    start, end = cfg.start_date, cfg.end_date
    if cfg.load_mode in ("append", "upsert") and not cfg.replay and start is None:
        wm = current_watermark(spark, cfg)
        if wm is not None:
            start = (wm - timedelta(days=cfg.overlap_days)).isoformat()        # C3
    _ledger_event(spark, cfg, "STARTED", cfg.now)
    try:
        return _run(spark, cfg, start, end)
    except Exception as err:  # noqa: BLE001 - recorded, then re-raised
        _ledger_event(spark, cfg, "FAILED", cfg.now, error=str(err))
        raise


class _Stage:
    """The tables of one run: reads what was live before it, stages new versions."""

    def __init__(self, spark: SparkSession, cfg: PipelineConfig):
        self.spark, self.cfg = spark, cfg
        self.base = store.base_versions(spark, cfg.root, cfg.run_id)
        self.versions: dict[str, int] = {}

    def before(self, layer: str, name: str) -> DataFrame | None:
        return store.read_version(self.spark, self.cfg.table(layer, name), self.base.get(f"{layer}/{name}"))

    def put(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        t = self.cfg.table(layer, name)
        v = self.versions[f"{layer}/{name}"] = store.stage(df, t)
        return store.read_version(self.spark, t, v)

    def put_bronze(self, df: DataFrame, key: str, buckets: int, replaced: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """Stage the classified stream of a load, in buckets of the key; (table, what was written). With
        ``replaced`` it holds those order years alone and the others stay in the files they are in."""
        t, before, by = self.cfg.table("bronze", "sales"), self.base.get("bronze/sales"), bronze_ops.ORDER_YEAR
        v = store.next_version(self.spark, t)
        store.write_bucketed(df, f"{t}/v={v}", key, buckets, [by, bronze_ops.CHANGE], bronze_ops.ORDER_DAY)
        now = v if replaced is None else store.parts_map(
            self.spark, t, v, by, store.layout(self.spark, f"{t}/v={v}")["columns"], before, replaced)
        self.versions["bronze/sales"] = now
        return store.read_version(self.spark, t, now), store.read_version(self.spark, t, v)

    def put_years(self, layer: str, name: str, df: DataFrame, day: str, touched=None) -> DataFrame:
        """Stage a table by the years of ``day``. With ``touched`` (years as a condition) ``df`` holds
        the rows of those years alone, and all other years stay in the files they are in."""
        t, before = self.cfg.table(layer, name), self.base.get(f"{layer}/{name}")
        replaced = None
        if touched is not None and before is not None:
            held = store.live_parts(self.spark, t, before, YEAR)
            replaced = [p for p in held if not p.isdigit() or touched(int(p))]
        by_year = df.withColumn(YEAR, F.year(day)).sortWithinPartitions(YEAR, day)
        v = self.versions[f"{layer}/{name}"] = store.stage_parts(by_year, t, YEAR, before, replaced)
        return store.read_version(self.spark, t, v)

    def publish(self) -> None:
        store.publish_all(self.spark, self.cfg.root, self.cfg.run_id, self.versions)


def _run(spark: SparkSession, cfg: PipelineConfig, start: str | None, end: str | None) -> RunResult:
    mode, stage = cfg.load_mode, _Stage(spark, cfg)
    log = lambda df, name: store.write_log(df, cfg.log(name), cfg.run_id)
    at = lambda name: F.lit(cfg.now).cast("timestamp_ntz").alias(name)
    # ---- bronze ------------------------------------------------------------------------------
    extract, _fp = files.guarded_read(spark, cfg.source_path,                 # S1, S2, B1
                                      cfg.table("bronze", f"sales_stage/run={cfg.run_id}"), cfg.deep_fingerprint)
    _observe_schema(spark, cfg, files.header_columns(spark, cfg.source_path))   # B2, B3 (as delivered)
    if not extract.filter(col(SOURCE_KEY).isNull()).isEmpty():
        raise KeyIntegrityError(f"source rows with a null {SOURCE_KEY!r} cannot be keyed")
    bronze_rows = extract.count()
    if mode == "snapshot":                                              # S4
        store.write_log(bronze_ops.snapshot_rows(extract, cfg.run_id, cfg.now),
                        cfg.table("bronze", "sales_snapshots"), cfg.run_id)
    # the delivery is deduplicated once and stored in the buckets of the stored state, so the one
    # join that classifies every key exchanges neither side; all that follows reads its result
    table, live = cfg.table("bronze", "sales"), stage.base.get("bronze/sales")
    stored, route = stage.before("bronze", "sales"), cfg.bad_values == "route"
    laid = None if live is None else store.layout(spark, f"{table}/v={live['latest'] if isinstance(live, dict) else live}")
    buckets = laid["buckets"] if laid else int(spark.conf.get("spark.sql.shuffle.partitions"))
    delivered = cfg.table("bronze", f"sales_delivery/run={cfg.run_id}")
    few = cfg.incremental and mode in ("append", "upsert") and stored is not None and not cfg.replay
    window = (start, end) if few and mode == "upsert" else (None, None)
    loaded: list[str] | None = None
    with store.shuffled_into(spark, buckets):
        store.write_bucketed(silver_ops.in_days(bronze_ops.dedup_by_key(extract), *window), delivered, SOURCE_KEY, buckets)  # B13
        delivery = store.read_table(spark, delivered)
        if few:                                                         # C3: only the order years it can change
            years = [r["year"] for r in bronze_ops.years_to_load(stored, delivery, window, mode).collect()]
            loaded = [store.NO_VALUE if y is None else str(y) for y in years]
            stored = store.read_version(spark, table, store.only_parts(
                store.as_map(spark, table, live, bronze_ops.ORDER_YEAR), loaded))
        existing = None if stored is None else bronze_ops.live(stored)
        classified = bronze_ops.changes(existing, delivery, mode, window=window)           # B4-B12
        bronze, written = stage.put_bronze(bronze_ops.with_order_day(classified, route), SOURCE_KEY, buckets, loaded)
    log(cdc.events(written, cfg.run_id, cfg.now), "cdc_events")              # B7, from the changed partitions
    log(cdc.source_deletions(store.read_run_log(spark, cfg.log("cdc_events"), cfg.run_id), mode), "source_deletions")   # B8

    # ---- NOOP decision (C4) -------------------------------------------------------------------
    asked = silver_ops.window_count(bronze, cfg.run_id, None, start, end, lenient=route).select(
        F.lit(cfg.run_id).alias("run_id"), F.lit(mode).alias("mode"), F.lit(cfg.replay).alias("replay"),
        F.col("source_rows").alias("window_rows"), F.lit(start).cast("string").alias("start_date"),
        F.lit(end).cast("string").alias("end_date"))
    if control.noop_decisions(asked).first()["noop"]:
        stage.publish()                                                 # the new bronze alone
        fact = stage.before("gold", "fact_sales")
        gold_rows = 0 if fact is None else fact.count()
        _ledger_event(spark, cfg, "NOOP", cfg.now, bronze_rows, 0, gold_rows)
        return RunResult(cfg.run_id, "NOOP", bronze_rows, 0, gold_rows)

    # ---- silver ------------------------------------------------------------------------------
    scope = control.rebuild_scopes(asked).first()                       # C6
    s_start, s_end = scope["rebuild_start"], scope["rebuild_end"]
    ctx = RunContext(cfg.run_id, cfg.now, cfg.source_name, s_start, s_end)
    log(silver_ops.profile_long(silver_ops.profile(extract), cfg.run_id).withColumn("profiled_at", at("x")),   # V1, V2
        "data_profile_results")
    # silver last read these versions of the order years; an incremental load rebuilds the years that
    # were written since, by this run or by one that stopped at bronze
    years_now = store.as_map(spark, table, stage.versions["bronze/sales"], bronze_ops.ORDER_YEAR)
    read_before = stage.base.get(SILVER_READ)
    few = few and read_before is not None and stage.before("silver", "sales") is not None
    source, changed = bronze, []
    if few:
        now, then = years_now["parts"], read_before["parts"]
        changed = [p for p in {*now, *then} if now.get(p) != then.get(p)]
        source = store.read_version(spark, table, store.only_parts(years_now, changed))
    fresh, rejected = silver_ops.route_bad_values(source, ctx) if route else (silver_ops.clean(source, ctx), None)
    built = stage.put("silver", "sales_window", fresh)
    n_rejected = 0
    if route:                                                           # V4, V11, V13
        set_aside = cfg.table("quarantine", "sales_rejected")
        store.write_log(rejected, set_aside, cfg.run_id)
        counts = silver_ops.reconcile_routed(source, built, store.read_run_log(spark, set_aside, cfg.run_id), ctx)
        n_rejected = counts.first()["rejected_rows"]
        silver_ops.assert_reconciled(counts)
    else:
        silver_ops.assert_reconciled(silver_ops.reconcile_bronze_silver(source, built, ctx))     # V13
    stored_silver = stage.before("silver", "sales")
    # a replay of a window keeps every row outside it
    partial = cfg.replay and stored_silver is not None and (s_start is not None or s_end is not None)
    touched, in_years = None, lambda day: F.lit(True)
    if few:
        numbers = [int(y) for y in changed if y != store.NO_VALUE]
        touched = lambda y: y in numbers
        in_years = lambda day: F.coalesce(F.year(day).isin(numbers), F.lit(True))
    if partial:
        old = stored_silver.drop(YEAR)
        outside = ~F.coalesce(silver_ops.in_window(F.col("order_date"), s_start, s_end), F.lit(False))
        # rows whose date moved out of the window are rebuilt under the new date, rows that moved in leave
        # their year: both years are touched beside those of the window
        everywhere = replace(ctx, start_date=None, end_date=None)
        everything = silver_ops.route_bad_values(bronze, everywhere)[0] if route else silver_ops.clean(bronze, everywhere)
        left = everything.filter(outside).join(old.filter(~outside).select("row_id"), "row_id", "left_semi")
        built = stage.put("silver", "sales_replayed", built.unionByName(left))
        rest = old.filter(outside)
        moved = [r[0] for r in rest.join(built.select("row_id"), "row_id", "left_semi").select("order_date")
                 .unionByName(built.filter(outside).select("order_date"))
                 .select(F.year("order_date")).filter("order_date is not null").distinct().collect()]   # years
        touched = lambda y: facts.year_touched(y, s_start, s_end, moved)
        in_years = lambda day: facts.years_touched(day, s_start, s_end, moved)
        built = (rest.filter(in_years(F.col("order_date"))).join(built.select("row_id"), "row_id", "left_anti")
                     .unionByName(built))
    silver = stage.put_years("silver", "sales", built, "order_date", touched).drop(YEAR)
    if partial:
        lost = silver_ops.lost_by_replay(bronze, old, silver, ctx, route).first()["lost_rows"]
        if lost:
            raise ReconciliationError(f"the replay would lose {lost} rows that bronze still has")
    s_rows = silver.count()
    store.write_log(silver_ops.quarantine(silver), cfg.table("quarantine", "sales_invalid"), cfg.run_id)      # V11

    # ---- gold (staged, published after validation) -----------------------------------------------
    def dimension(name: str, df: DataFrame, business: list[str], key: str) -> DataFrame:
        old = stage.before("gold", name) if partial or few else None
        return stage.put("gold", name, df if old is None else dims.keep_keys(old, df, business, key))

    # independent tables are written concurrently (their small jobs overlap)
    customers, products, locations, dates, fulfillment = run_concurrently([
        lambda: dimension("dim_customers", dims.dim_customers(silver), ["customer_id"], "customer_key"),
        lambda: dimension("dim_products", dims.dim_products(silver), ["product_id"], "product_key"),
        lambda: dimension("dim_location", dims.dim_location(silver), LOCATION_COLUMNS, "location_id"),
        lambda: stage.put("gold", "dim_date", dims.dim_date(silver)),
        lambda: stage.put("gold", "fact_order_fulfillment", facts.order_fulfillment(silver)),
    ])
    snap = customers.select("customer_id", "customer_name", "segment", "ingested_at")
    scd2 = stage.put("gold", "dim_customers_scd2",
                     dims.scd2_merge(stage.before("gold", "dim_customers_scd2"), snap))

    fresh_fact = facts.fact_sales(silver.filter(in_years(F.col("order_date"))), customers, products, locations,
                                  dims.scd2_current_keys(scd2))
    fact = stage.put_years("gold", "fact_sales", fresh_fact, "order_date", touched).select(*facts.FACT_COLUMNS)   # S7, S8
    daily = stage.put_years("gold", "sales_daily", facts.sales_daily(fact.filter(in_years(F.col("order_date")))),
                            "order_date", touched).drop(YEAR)
    stage.put_years("gold", "sales_monthly", facts.sales_monthly(daily.filter(in_years(F.col("order_date")))),
                    "month_key", touched)
    stage.put("gold", "sales_by_region", bi.region_totals(fact, locations))          # A4

    # ---- validation (V15, F9, Q1-Q9) -----------------------------------------------------------------
    silver_ops.assert_keys(quality.key_report({
        "silver": silver, "dim_customers": customers, "dim_products": products, "dim_location": locations,
        "dim_date": dates, "fact_sales": fact, "fact_order_fulfillment": fulfillment}))
    recon = facts.reconcile_fact_daily(fact, daily, RECON_TOLERANCE).first()
    if not recon["passed"]:
        raise ReconciliationError(f"run {cfg.run_id}: the daily rollup does not add up to the fact: {recon.asDict()}")
    orphans = facts.fk_violations(fact, customers, scd2, products, locations, dates)
    bad_fk = orphans.filter(F.col("orphan_rows") > 0).collect()
    if bad_fk:
        raise KeyIntegrityError("foreign keys without parent: " + ", ".join(r["foreign_key"] for r in bad_fk))
    gold_rows = fact.count()
    log(quality.quality_results(quality.rule_checks(silver, fact), cfg.run_id, cfg.now), "data_quality_results")
    results = store.read_run_log(spark, cfg.log("data_quality_results"), cfg.run_id)
    quality.rule_catalogue(spark).withColumn("updated_at", at("x")).write.mode("overwrite").parquet(
        cfg.log("data_contract_rules"))
    log(quality.reconciliation_row(silver, fact, cfg.run_id).withColumn("checked_at", at("x")),
        "reconciliation_results")
    failed = quality.enforce(results, cfg.failure_mode)                 # raises under STOP

    # ---- publish all tables, watermark, ledger --------------------------------------------------------
    if partial:                             # the other years of silver are not of this bronze
        then = (read_before or {"parts": {}})["parts"]
        years_now = {**years_now, "parts": {y: v if not y.isdigit() or touched(int(y)) else then.get(y, -1)
                                            for y, v in years_now["parts"].items()}}
    stage.versions[SILVER_READ] = years_now
    stage.publish()
    if not cfg.replay:                                                   # C2
        max_date = silver.agg(F.max("order_date")).first()[0]
        if max_date is not None:
            prop = spark.createDataFrame([(cfg.pipeline_name, max_date, False)],
                                         "pipeline_name string, watermark_date date, replay boolean") \
                .withColumn("updated_at", at("x"))
            marks = store.read_log(spark, cfg.log("pipeline_watermarks"))
            current = None if marks is None else control.watermark(marks.filter(F.col("written_by") != cfg.run_id))
            log(control.advance(current, prop).withColumn("written_by", F.lit(cfg.run_id)), "pipeline_watermarks")
    _ledger_event(spark, cfg, "SUCCESS", cfg.now, bronze_rows, s_rows, gold_rows)
    LOGGER.info("run %s: bronze=%s silver=%s gold=%s", cfg.run_id, bronze_rows, s_rows, gold_rows)
    return RunResult(cfg.run_id, "SUCCESS", bronze_rows, s_rows, gold_rows, n_rejected, failed)
