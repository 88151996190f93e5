"""The layer graph for one build: extract -> bronze -> silver -> gold.

Each property is one DataFrame plan. Without a store the graph stays lazy (one big
plan per query, used by unit tests on tiny inputs). With a store (``shared``), each
layer is written once as Parquet under the shared checkpoint folder and read back,
as a warehouse publishes its tables: lineage is cut at every layer, a lost executor
recomputes from the last written table, and downstream queries scan Parquet with
column pruning and pushed filters. ``plans.pipeline`` uses the same operators with
versioned tables and control state.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmart import __version__
from shelfmart.config import SOURCE_KEY
from shelfmart.operators import bi, dims, eda, facts
from shelfmart.operators import bronze as bronze_ops
from shelfmart.operators import silver as silver_ops
from shelfmart.operators.silver import RunContext
from shelfmart.session import ensure_checkpoint_dir
from shelfmart.sources import fixture, store as store_ops

# Parameters of the demonstration build used by the query catalogue (no clock reads).
DEMO_RUN = RunContext(
    run_id="00000000-0000-7000-8000-000000000001",
    ingested_at="2024-01-01 00:00:00",
    source_file="sales_extract.csv",
)

#: Rows of the extract per task, bucket or shuffle partition of a build: what a task holds stays the
#: same however large the tables are.
ROWS_PER_TASK = 250_000

INPUT_TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")

# Layers in dependency waves; the layers of one wave are independent of each other.
BUILD_WAVES = {
    "bronze": [["extract"], ["bronze"]],
    "silver": [["silver"]],
    "gold": [["dim_customers", "dim_products", "dim_location", "dim_date", "fulfillment"],
             ["scd2"], ["fact_partitioned"], ["daily", "region_totals"], ["monthly"]],
    "profile": [["quartiles"]],
    "scenarios": [["previous", "incoming_dedup", "customer_batches"], ["scd2_history"]],
    # inputs of the queries on changing data, which are not among the headline queries
    "changing": [["previous"], ["correction", "corrupted_bronze", "snapshot_history"]],
}


def run_concurrently(tasks: list[Callable[[], object]], max_workers: int = 8) -> list[object]:
    """Run independent driver-side actions from parallel threads; Spark schedules their
    jobs side by side, so small stages of different tables overlap instead of queueing."""
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _lock(key: str) -> threading.Lock:
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(key, threading.Lock())


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, ctx: RunContext = DEMO_RUN,
                 store: str | None = None):
        self.spark, self.sf_dir, self.ctx, self.store = spark, sf_dir, ctx, store

    @cached_property
    def tasks(self) -> int:
        """Partitions of the build's exchanges and buckets of the extract: more for more rows (the
        count is read from the file footers)."""
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        lines = fixture.read_table(self.spark, self.sf_dir, "lineitem").count()
        return max(least, -(-lines // ROWS_PER_TASK))

    def _layer(self, name: str, build, partition_by: list[str] | None = None, bucket_by: str | None = None) -> DataFrame:
        """A stored layer; ``bucket_by`` a key it is in ``tasks`` buckets, so that joins and
        aggregations on the key read it without an exchange."""
        if self.store is None:
            return build()
        path = f"{self.store}/{name}"
        with _lock(path):            # one writer per table, even if callers run in threads
            if not store_ops.committed(self.spark, path):
                tasks = self.tasks
                with store_ops.shuffled_into(self.spark, tasks):
                    if bucket_by is None:
                        store_ops.write_table(build(), path, partition_by)
                    else:
                        store_ops.write_bucketed(build(), path, bucket_by, tasks)
            return store_ops.read_table(self.spark, path)

    def build(self, phase: str) -> None:
        """Materialise one phase's layers wave by wave, a wave's layers concurrently."""
        for wave in BUILD_WAVES[phase]:
            run_concurrently([lambda n=n: getattr(self, n) for n in wave])

    # ---- bronze ------------------------------------------------------------------
    @cached_property
    def extract(self) -> DataFrame:
        """The landing copy of the raw extract (all text), in buckets of its key: every table that
        has one row per key of the extract is made from it without an exchange."""
        if self.store is None:
            return fixture.source_extract(self.spark, self.sf_dir)
        return self._layer("landing/extract", lambda: fixture.source_extract(
            self.spark, self.sf_dir, partitions=self.tasks), bucket_by=SOURCE_KEY)

    def landing_rows(self, by_key: bool = False) -> DataFrame:
        """The rows of the extract for one reader: the landing copy if a layer has stored it, else
        made from the tables without storing them. Rows not ``by_key`` are not exchanged by key."""
        if self.store is None or store_ops.committed(self.spark, f"{self.store}/landing/extract"):
            return self.extract
        return fixture.source_extract(self.spark, self.sf_dir, partitions=self.tasks if by_key else None)

    @cached_property
    def bronze_dated(self) -> DataFrame:
        """Bronze with its typed order day, partitioned by order year."""
        return self._layer("bronze/sales", lambda: bronze_ops.with_order_day(
            self.bronze).sortWithinPartitions(bronze_ops.ORDER_YEAR, bronze_ops.ORDER_DAY),
            partition_by=[bronze_ops.ORDER_YEAR])

    @cached_property
    def bronze(self) -> DataFrame:
        """One row per key, taken from the buckets of the extract as they are read."""
        return bronze_ops.dedup_by_key(self.extract)

    # ---- silver ------------------------------------------------------------------
    @cached_property
    def silver(self) -> DataFrame:
        """Deduplicated as the extract's rows come by key, without a landing copy if there is none."""
        return self._layer("silver/sales", lambda: silver_ops.clean(
            bronze_ops.dedup_by_key(self.landing_rows(by_key=True)), self.ctx))

    @cached_property
    def quartiles(self) -> DataFrame:
        """Quartiles of the numeric columns of the extract, shared by E5, E7 and E8."""
        return self._layer("profile/quartiles", lambda: eda.quartiles(eda.numeric_long(eda.profile_frame(self.extract))))

    # ---- gold dimensions ------------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._layer("gold/dim_customers",
                           lambda: dims.dim_customers(self.silver))

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._layer("gold/dim_products",
                           lambda: dims.dim_products(self.silver))

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._layer("gold/dim_location",
                           lambda: dims.dim_location(self.silver))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._layer("gold/dim_date", lambda: dims.dim_date(self.silver))

    @cached_property
    def scd2(self) -> DataFrame:
        """SCD2 history after this build's single batch (empty history before it)."""
        return self._layer("gold/dim_customers_scd2", lambda: dims.scd2_merge(
            None, self.dim_customers))

    # ---- gold facts -----------------------------------------------------------------
    @cached_property
    def fact_partitioned(self) -> DataFrame:
        """The fact with its ``order_year`` partition column."""
        return self._layer("gold/fact_sales", lambda: facts.with_order_year(facts.fact_sales(
            self.silver, self.dim_customers, self.dim_products, self.dim_location,
            dims.scd2_current_keys(self.scd2))), partition_by=["order_year"])

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_partitioned.select(*facts.FACT_COLUMNS)

    @cached_property
    def daily(self) -> DataFrame:
        return self._layer("gold/sales_daily", lambda: facts.sales_daily(self.fact))

    @cached_property
    def monthly(self) -> DataFrame:
        return self._layer("gold/sales_monthly", lambda: facts.sales_monthly(self.daily))

    @cached_property
    def region_totals(self) -> DataFrame:
        """A4 as a stored table."""
        return self._layer("gold/sales_by_region", lambda: bi.region_totals(self.fact, self.dim_location))

    @cached_property
    def fulfillment(self) -> DataFrame:
        return self._layer("gold/fact_order_fulfillment", lambda: facts.order_fulfillment(self.silver))

    # ---- scenario inputs ----------------------------------------------------------------
    @cached_property
    def previous(self) -> DataFrame:
        """Bronze before the next delivery."""
        return bronze_ops.dedup_by_key(fixture.previous_extract(self.extract))

    @cached_property
    def incoming(self) -> DataFrame:
        """The next delivery as files come: read without the buckets of the extract."""
        landed = self.extract
        if self.store is not None:
            landed = self.spark.read.parquet(f"{self.store}/landing/extract")
        return fixture.incoming_extract(landed)

    @cached_property
    def incoming_dedup(self) -> DataFrame:
        """The next delivery, one row per key."""
        return bronze_ops.dedup_by_key(fixture.incoming_extract(self.extract))

    def changes(self, mode: str) -> DataFrame:
        """The classified stream of loading the next delivery in a mode."""
        return bronze_ops.changes(self.previous, self.incoming_dedup, mode)

    @cached_property
    def correction(self) -> DataFrame:
        """The changed rows in the classified stream of a full load that corrects, adds, removes and
        moves rows, stored once."""
        return self._layer("scenario/correction", lambda: bronze_ops.changes(
            self.previous, bronze_ops.dedup_by_key(fixture.corrected_extract(self.extract)), "full").filter(
            F.col(bronze_ops.CHANGE) != bronze_ops.KEEP), partition_by=[bronze_ops.CHANGE])

    @cached_property
    def corrupted_bronze(self) -> DataFrame:
        return bronze_ops.dedup_by_key(fixture.corrupted_extract(self.extract))

    @cached_property
    def snapshot_history(self) -> DataFrame:
        """The history table after two snapshot runs, the second one repeated."""
        from shelfmart.plans.q_changes import FIRST_SNAPSHOT, SECOND_SNAPSHOT
        first, second = fixture.previous_extract(self.extract), self.incoming
        runs = [bronze_ops.snapshot_rows(df, r.run_id, r.ingested_at)
                for df, r in ((first, FIRST_SNAPSHOT), (second, SECOND_SNAPSHOT), (second, SECOND_SNAPSHOT))]
        if self.store is None:
            return runs[0].unionByName(runs[1])
        path = f"{self.store}/scenario/snapshots"
        with _lock(path):
            if not store_ops.exists(self.spark, f"{path}/_DONE"):
                for rows, r in zip(runs, (FIRST_SNAPSHOT, SECOND_SNAPSHOT, SECOND_SNAPSHOT)):
                    store_ops.write_log(rows, path, r.run_id)
                store_ops.write_text(self.spark, f"{path}/_DONE", "")
        return store_ops.read_log(self.spark, path)

    @cached_property
    def customer_batches(self) -> DataFrame:
        return self._layer("scenario/customer_batches",
                           lambda: fixture.customer_batches(self.dim_customers))

    def batch(self, k: int) -> DataFrame:
        return self.customer_batches.filter(F.col("batch") == k)

    @cached_property
    def scd2_history(self) -> list[DataFrame]:
        """History after batch 1, 2 and 3, merged one batch at a time."""
        out, h = [], None
        for k in (1, 2, 3):
            prev = h
            h = self._layer(f"scenario/scd2_after_batch{k}", lambda prev=prev, k=k: dims.scd2_merge(
                prev, self.batch(k)))
            out.append(h)
        return out


_SHARED: dict[tuple, Warehouse] = {}


def _code_digest() -> str:
    """Digest of this package's source, so a code change never reuses an older build."""
    import hashlib
    import pathlib
    h = hashlib.sha256(__version__.encode())
    for p in sorted(pathlib.Path(__file__).resolve().parents[1].rglob("*.py")):
        h.update(p.read_bytes())
    return h.hexdigest()


def shared(spark: SparkSession, sf_dir: str, ctx: RunContext = DEMO_RUN, fresh: bool = False) -> Warehouse:
    """The stored build for (input files, code, run parameters).

    Tables live under the shared folder named by ``spark.checkpoint.dir`` (falling back to
    the session's checkpoint directory), keyed by a fingerprint of the input files, the
    package source and the run parameters; a committed build is reused by later sessions.
    ``fresh`` salts the key with the application id, forcing a new build (bench).
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), ctx, fresh)
    with _lock(f"shared:{key}"):
        return _SHARED[key] if key in _SHARED else _new_shared(spark, sf_dir, ctx, fresh, key)


def _new_shared(spark: SparkSession, sf_dir: str, ctx: RunContext, fresh: bool, key: tuple) -> Warehouse:
    session_dir = ensure_checkpoint_dir(spark)
    base = (spark.conf.get("spark.checkpoint.dir", None) or session_dir).rstrip("/")
    salt = f"{_code_digest()}|{ctx}" + (f"|{spark.sparkContext.applicationId}" if fresh else "")
    fp = store_ops.input_fingerprint(
        spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in INPUT_TABLES], salt=salt)
    w = Warehouse(spark, sf_dir, ctx, store=f"{base}/shelfmart-store/{fp}")
    _SHARED[key] = w
    return w
