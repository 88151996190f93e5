"""Layers whose tasks stay the same size and that are not exchanged more often than needed."""

import os
import threading
import time

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelfmart.operators import bronze as bronze_ops
from shelfmart.operators import dims, facts
from shelfmart.operators import silver as silver_ops
from shelfmart.plans import catalog, warehouse
from shelfmart.sources import files, fixture, store


@pytest.fixture(scope="module")
def w(spark, tmp_path_factory):
    before, warehouse.ROWS_PER_TASK = warehouse.ROWS_PER_TASK, 500
    try:
        made = warehouse.Warehouse(spark, SF_SMALL, store=str(tmp_path_factory.mktemp("store")))
        assert made.tasks == 12                             # 6,000 lines; the session shuffles into 8
        yield made
    finally:
        warehouse.ROWS_PER_TASK = before


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _same(got, want):
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_tables_by_key_come_from_the_buckets_of_the_extract(spark, w):
    plain = fixture.source_extract(spark, SF_SMALL)
    assert _same(w.extract, plain)
    assert store.layout(spark, f"{w.store}/landing/extract")["buckets"] == 12
    for got, want in ((w.bronze, plain), (w.previous, fixture.previous_extract(plain)),
                      (w.incoming_dedup, fixture.incoming_extract(plain)), (w.corrupted_bronze, fixture.corrupted_extract(plain))):
        assert "Exchange" not in _plan(got)
        assert _same(got, bronze_ops.dedup_by_key(want))
    assert "Exchange" not in _plan(catalog.run_on("load_upsert", w))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_landed_csv_is_made_from_the_tables_without_the_extract(spark, tmp_path):
    w = warehouse.Warehouse(spark, SF_SMALL, store=str(tmp_path))
    want = fixture.source_extract(spark, SF_SMALL)
    got = catalog.run_on("src_csv_scan", w)
    assert not store.exists(spark, f"{w.store}/landing/extract")
    assert _same(got, want)
    assert w.extract.count() == want.count()                # once a layer has stored it, it is read
    assert "shelfmart_" in _plan(w.landing_rows())
    assert _same(catalog.run_on("src_csv_scan", w), want)


def test_lines_are_exchanged_by_part_order_and_key_only(spark):
    joined = fixture.source_extract(spark, SF_SMALL, partitions=4)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    rendered = plan.index("STATE_")
    assert rendered < plan.index("RepartitionByExpression")  # the plan is printed from its top


def test_overlapping_builds_leave_the_settings_as_they_were(spark):
    name, entered, leave = "spark.sql.shuffle.partitions", threading.Event(), threading.Event()
    before = spark.conf.get(name)

    def other():
        with store.shuffled_into(spark, 30):
            entered.set()
            leave.wait(20)

    thread = threading.Thread(target=other)
    with store.shuffled_into(spark, 20):
        thread.start()
        assert entered.wait(20) and spark.conf.get(name) == "30"
    assert spark.conf.get(name) == "30"
    leave.set()
    thread.join()
    assert spark.conf.get(name) == before


def test_latest_rows_are_picked_without_sorting_the_table(spark):
    rows = spark.createDataFrame(
        [("a", "x", 1, 5), ("a", "y", 2, 1), ("a", "z", 2, None), ("b", None, None, 9), (None, "n", 3, 3), (None, "m", 3, 4)],
        "k string, v string, ingested_at int, row_id long")
    got = dims.latest_per_key(rows, "k", ["v"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", "y"), ("b", None), (None, "m")], key=str)
    scanned = _plan(got).splitlines()
    last = max(i for i, line in enumerate(scanned) if "Aggregate" in line)   # the one next to the rows
    assert "HashAggregate" in scanned[last] and "Sort" not in "".join(scanned[last + 1:])


def test_rollups_are_merged_into_their_own_number_of_partitions(spark):
    rows = spark.createDataFrame([(1, "a", 2, 3, 4, 1), (1, "b", 1, 1, 1, 1)],
                                 "d int, c string, sales int, quantity int, profit int, transaction_count long")
    gone = rows.filter("c = 'b'")
    merged = facts.merge_rollup(rows, facts.rollup_delta(gone, gone.limit(0), ["d", "c"], 5), ["d", "c"], 5)
    assert [tuple(r)[:2] for r in merged.collect()] == [(1, "a")]
    assert _plan(merged).count(", 5), REPARTITION_BY_NUM") >= 2


def test_deliveries_hold_every_row_under_their_own_header(spark, w):
    from shelfmart.plans import q_gold
    heads = {r["run_id"]: r["columns"] for r in q_gold._observations(w).collect()}
    lines = spark.read.text(f"{w.store}/landing/deliveries")
    n_files = lines.select(lines.metadataColumn("_metadata")["file_path"]).distinct().count()
    assert lines.count() - n_files == w.extract.count()     # a header per file
    runs = {r["run_id"]: r["run_seq"] for r in q_gold._deliveries(w).collect()}
    assert heads.keys() == runs.keys()
    for run, seq in runs.items():
        kind = 0 if seq % 10 == 0 else 1 if seq % 10 == 5 else 2 if seq % 20 == 7 else 3
        assert heads[run] == ",".join(q_gold._HEADERS[kind][0])


def test_duplicates_are_counted_in_the_buckets(spark, w):
    plain = fixture.source_extract(spark, SF_SMALL).cache()
    got = catalog.run_on("eda_duplicates", w).first()
    assert got["total_rows"] == plain.count() and got["distinct_rows"] == plain.distinct().count()
    from shelfmart.operators import eda
    from shelfmart.functions.columns import col
    keyed = eda.profile_frame(w.extract.select("*", col("Row ID").alias("_key"))).distinct()
    assert "Exchange" not in _plan(keyed)


def test_correction_stores_changed_rows_only(w):
    assert w.correction.filter(F.col(bronze_ops.CHANGE) == bronze_ops.KEEP).isEmpty()
    assert not w.correction.isEmpty()


def test_exchanged_rows_go_when_a_layer_is_stored(spark, tmp_path):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {n for n in files.getAllFiles().mkString("|").split("|") if "/shuffle_" in n}
    before, w = held(), warehouse.Warehouse(spark, SF_SMALL, store=str(tmp_path))
    assert w.fact_partitioned.count() > 0
    left = held() - before
    for _ in range(50):                                     # they are removed in the background
        if not left:
            break
        time.sleep(0.1)
        left = held() - before
    assert not {n for n in left if n.endswith(".data") and os.path.getsize(n) > 10_000}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_silver_needs_no_landing_copy(spark, tmp_path):
    w = warehouse.Warehouse(spark, SF_SMALL, store=str(tmp_path))
    want = bronze_ops.dedup_by_key(fixture.source_extract(spark, SF_SMALL))
    with store.shuffled_into(spark, w.tasks):
        rows = bronze_ops.dedup_by_key(w.landing_rows(by_key=True))
        plan = _plan(rows)
        assert plan[:plan.index("REPARTITION_BY_NUM")].count("Exchange") == 1   # the aggregate adds none
        assert _same(rows, want)
    assert w.silver.count() == silver_ops.clean(want, warehouse.DEMO_RUN).count()
    assert not store.exists(spark, f"{w.store}/landing/extract")
    from shelfmart.plans import q_gold
    q_gold._runs(warehouse.Warehouse(spark, SF_SMALL, store=str(tmp_path / "other")))   # of both: made of the copy
    assert store.committed(spark, f"{tmp_path}/other/landing/extract")


def test_a_changed_rollup_is_exchanged_once(spark):
    rows = spark.createDataFrame([(1, "a", 2, 3, 4, 1), (1, "b", 1, 1, 1, 1)],
                                 "d int, c string, sales int, quantity int, profit int, transaction_count long")
    merged = facts.merge_rollup(rows, facts.rollup_delta(rows.limit(0), rows.filter("c = 'b'"), ["d", "c"], 5), ["d", "c"], 5)
    assert _plan(merged).count("Exchange hashpartitioning") == 2
    assert sorted((r["c"], r["transaction_count"]) for r in merged.collect()) == [("a", 1), ("b", 2)]


def test_snapshot_state_and_history_are_joined_in_their_buckets(spark, w):
    small, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(small, "-1")
    try:
        got = catalog.run_on("load_snapshot", w)
        assert "Exchange" not in _plan(got)
    finally:
        spark.conf.set(small, before)
    lazy = catalog.run_on("load_snapshot", warehouse.Warehouse(spark, SF_SMALL))
    assert _same(got, lazy)


def test_a_replayed_year_is_exchanged_into_the_partitions_of_a_build(spark, w, monkeypatch):
    seen, real = [], store.stage_parts
    monkeypatch.setattr(store, "stage_parts", lambda *a: (seen.append(spark.conf.get("spark.sql.shuffle.partitions")), real(*a))[1])
    assert catalog.run_on("fact_partition_overwrite", w).count() > 0
    assert seen == ["12", "12"]


def test_files_of_the_stream_are_dealt_without_an_exchange(spark, tmp_path):
    from shelfmart.streaming.ingest import stage_in_turn
    row = fixture.source_extract(spark, SF_SMALL).limit(1)
    copies = spark.createDataFrame(row.collect() * 12, row.schema).repartition(2)
    assert stage_in_turn(copies, f"{tmp_path}/in", 3) == 6  # each of two tasks deals to three folders
    per_file = [r["count"] for r in files.read_extract_csv(spark, f"{tmp_path}/in/*").groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 6 and sum(per_file) == 12 and max(per_file) <= 3
    w = warehouse.Warehouse(spark, SF_SMALL, store=str(tmp_path / "store"))
    assert _same(catalog.run_on("ingest_microbatch", w), bronze_ops.dedup_by_key(fixture.source_extract(spark, SF_SMALL)))
    assert not store.exists(spark, f"{w.store}/landing/extract")
    assert len(store.partitions(spark, f"{w.store}/landing/stream_files", "folder")) == 6


def test_logs_are_stored_compactly(spark, tmp_path):
    store.write_log(spark.range(5), str(tmp_path / "log"), "r1")
    assert [p.name for p in tmp_path.glob("log/run=r1/part-*") if ".zstd." not in p.name] == []
    assert store.read_log(spark, str(tmp_path / "log")).count() == 5
