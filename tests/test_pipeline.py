"""Scenario tests of the end-to-end run on the sf0.001 tables."""
import pytest
from pyspark.sql import functions as F

from shelfmart.errors import DataQualityError
from shelfmart.operators import bronze as bronze_ops
from shelfmart.plans import pipeline
from shelfmart.plans.pipeline import PipelineConfig
from shelfmart.sources import files, fixture, store

from conftest import SF_SMALL


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Whole runs on a few thousand rows: their time is the number of tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("src")
    clean = fixture.source_extract(spark, SF_SMALL, dirty=False)
    paths = {"clean": f"{d}/clean", "dirty": f"{d}/dirty", "partial": f"{d}/partial", "reordered": f"{d}/reordered"}
    files.write_extract_csv(clean, paths["clean"])
    files.write_extract_csv(fixture.source_extract(spark, SF_SMALL), paths["dirty"])
    files.write_extract_csv(fixture.incoming_extract(clean), paths["partial"])
    files.write_extract_csv(clean.select(*[f"`{c}`" for c in reversed(clean.columns)]), paths["reordered"])
    return paths


def cfg(root, src, run, **kw):
    return PipelineConfig(root=root, source_path=src, run_id=run, now=f"2024-01-0{run[-1]} 00:00:00",
                          source_name="sales.csv", **kw)


def gold_count(spark, root, name="fact_sales"):
    df = store.read_current(spark, f"{root}/gold/{name}")
    return None if df is None else df.count()


def years(spark, root):
    f = store.read_current(spark, f"{root}/gold/fact_sales").groupBy("order_year").agg(
        F.count(F.lit(1)), F.sum("quantity"), F.sum("sales"), F.sum("customer_key"), F.sum("product_key"))
    return {r[0]: tuple(r)[1:] for r in f.collect()}


def totals_agree(spark, root):
    sums = lambda n: tuple(store.read_current(spark, f"{root}/gold/{n}").agg(F.sum("sales"), F.sum("quantity")).first())
    assert sums("fact_sales") == sums("sales_daily") == sums("sales_monthly")
    silver = store.read_current(spark, f"{root}/silver/sales").agg(F.sum("sales"), F.sum("quantity")).first()
    assert sums("fact_sales") == tuple(silver)


def test_full_runs_are_idempotent(spark, sources, tmp_path):
    root = str(tmp_path / "wh")
    r1 = pipeline.run(spark, cfg(root, sources["clean"], "run1"))
    assert r1.status == "SUCCESS" and r1.silver_rows == r1.gold_rows > 0 and not r1.failed_rules
    fact1 = store.read_current(spark, f"{root}/gold/fact_sales").drop("run_id", "ingested_at")
    scd1 = gold_count(spark, root, "dim_customers_scd2")
    r2 = pipeline.run(spark, cfg(root, sources["clean"], "run2"))
    fact2 = store.read_current(spark, f"{root}/gold/fact_sales").drop("run_id", "ingested_at")
    assert fact1.exceptAll(fact2).count() == 0 and fact2.exceptAll(fact1).count() == 0
    assert gold_count(spark, root, "dim_customers_scd2") == scd1        # unchanged customers: no new versions
    ev = spark.read.parquet(f"{root}/control/cdc_events")
    assert ev.filter("run_id = 'run2'").count() == 0
    led = {r["run_id"]: r["status"] for r in pipeline.run_ledger(spark, root).collect()}
    assert led == {"run1": "SUCCESS", "run2": "SUCCESS"}
    # Σ daily = Σ monthly = Σ fact
    tot = lambda n: float(store.read_current(spark, f"{root}/gold/{n}").agg(F.sum("sales")).first()[0])
    assert tot("fact_sales") == tot("sales_daily") == tot("sales_monthly")
    wm = pipeline.current_watermark(spark, cfg(root, sources["clean"], "run3"))
    assert wm == store.read_current(spark, f"{root}/silver/sales").agg(F.max("order_date")).first()[0]

    # upsert of a partial delivery: deletions recorded and hidden for that run only
    r3 = pipeline.run(spark, cfg(root, sources["partial"], "run3", load_mode="upsert"))
    dels = spark.read.parquet(f"{root}/control/source_deletions").filter("run_id = 'run3'").count()
    assert dels > 0 and r3.status == "SUCCESS"
    assert r3.silver_rows == store.read_current(spark, f"{root}/bronze/sales").count() - dels

    # append with a window after every order: nothing to do
    r4 = pipeline.run(spark, cfg(root, sources["partial"], "run4", load_mode="append", start_date="2030-01-01"))
    assert r4.status == "NOOP" and r4.gold_rows == r3.gold_rows

    # replay with explicit dates does not move the watermark and keeps all other years
    before_years = years(spark, root)
    before = pipeline.current_watermark(spark, cfg(root, sources["clean"], "run5"))
    r5 = pipeline.run(spark, cfg(root, sources["clean"], "run5", start_date="1996-01-01", end_date="1996-12-31",
                                 replay=True))
    assert r5.status == "SUCCESS" and pipeline.current_watermark(spark, cfg(root, sources["clean"], "run6")) == before
    after_years = years(spark, root)
    assert len(before_years) > 2 and set(after_years) == set(before_years)
    assert all(after_years[y] == before_years[y] for y in before_years if y != 1996)
    totals_agree(spark, root)

    # the reordered header is a schema change for the same source
    pipeline.run(spark, cfg(root, sources["reordered"], "run6"))
    ch = spark.read.parquet(f"{root}/control/source_schema_changes").collect()
    assert [r["run_id"] for r in ch] == ["run6"]


def test_stop_policy_keeps_gold_unpublished(spark, sources, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(DataQualityError, match="invalid measures"):
        pipeline.run(spark, cfg(root, sources["dirty"], "run1"))
    assert gold_count(spark, root) is None                     # staged, never published
    led = pipeline.run_ledger(spark, root).first()
    assert led["status"] == "FAILED" and "invalid measures" in led["error_message"]
    r = pipeline.run(spark, cfg(root, sources["dirty"], "run2", failure_mode="WARN"))
    assert r.status == "SUCCESS" and r.failed_rules == ["invalid measures"]
    q = spark.read.parquet(f"{root}/quarantine/sales_invalid")
    assert q.count() > 0 and set(r["reason"] for r in q.select("reason").distinct().collect()) <= {
        "quantity <= 0", "discount outside [0,1]", "sales < 0"}


def test_replay_of_changed_years(spark, sources, tmp_path):
    """A replayed window takes the delivery's rows: one year changed, one vanished, rows moved in."""
    root = str(tmp_path / "wh")
    pipeline.run(spark, cfg(root, sources["clean"], "run1"))
    before = years(spark, root)
    row_ids = lambda: {r[0] for r in store.read_current(spark, f"{root}/gold/fact_sales").select("row_id").collect()}
    all_ids = row_ids()
    extract = files.read_extract_csv(spark, sources["clean"])
    year = F.split("`Order Date`", "/")[2]
    other = max(y for y in before if y not in (1996, 1997))
    moved = (year == str(other)) & (F.col("`Row ID`").cast("long") % 5 == 0)
    changed = (extract.filter(year != "1997")
               .withColumn("Quantity", F.when(year == "1996", F.col("Quantity").cast("int") + 1)
                           .otherwise(F.col("Quantity").cast("int") + 100).cast("string"))
               .withColumn("Customer ID", F.when((year == "1996") & (F.col("`Row ID`").cast("long") % 7 == 0), "C-0new")
                           .otherwise(F.col("`Customer ID`")))
               .withColumn("Order Date", F.when(moved, F.lit("6/15/1996")).otherwise(F.col("`Order Date`"))))
    files.write_extract_csv(changed, str(tmp_path / "changed"))
    r = pipeline.run(spark, cfg(root, str(tmp_path / "changed"), "run2", start_date="1996-01-01", end_date="1997-12-31",
                                replay=True))
    assert r.status == "SUCCESS"
    after = years(spark, root)
    assert 1997 not in after and 1996 in after and after[1996] != before[1996]
    assert after[other][0] < before[other][0]                # rows that moved into the window left their year
    assert all(after[y] == before[y] for y in before if y not in (other, 1996, 1997))
    gone = {r[0] for r in extract.filter(year == "1997").select(F.col("`Row ID`").cast("long")).collect()}
    assert row_ids() == all_ids - gone
    totals_agree(spark, root)
    c = store.read_current(spark, f"{root}/gold/dim_customers")
    assert c.filter("customer_id = 'C-0new'").first()["customer_key"] == c.agg(F.max("customer_key")).first()[0]


def part_files(root, table):
    """Data files of a published year-partitioned table, by year, with their modification times."""
    import glob
    import json
    import os
    live = json.load(open(f"{root}/_PUBLISHED"))["tables"][table]
    return {int(y): {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/{table}/v={v}/order_year={y}/*.parquet")}
            for y, v in live["parts"].items()}


def test_replay_keeps_rows_that_move_out_of_the_window(spark, sources, tmp_path):
    root = str(tmp_path / "wh")
    pipeline.run(spark, cfg(root, sources["clean"], "run1"))
    before, files_before = years(spark, root), {t: part_files(root, t) for t in (
        "gold/fact_sales", "gold/sales_daily", "gold/sales_monthly", "silver/sales")}
    extract = files.read_extract_csv(spark, sources["clean"])
    out = (F.split("`Order Date`", "/")[2] == "1996") & (F.col("`Row ID`").cast("long") % 5 == 0)
    n_out = extract.filter(out).select("Row ID").distinct().count()
    files.write_extract_csv(extract.withColumn("Order Date", F.when(out, F.lit("6/15/1997")).otherwise(F.col("`Order Date`"))),
                            str(tmp_path / "moved"))
    r = pipeline.run(spark, cfg(root, str(tmp_path / "moved"), "run2", start_date="1996-01-01", end_date="1996-12-31",
                                replay=True))
    after = years(spark, root)
    assert r.status == "SUCCESS" and n_out > 5 and r.silver_rows == r.gold_rows == r.bronze_rows - (
        extract.count() - extract.select("Row ID").distinct().count())
    assert after[1996][0] == before[1996][0] - n_out and after[1997][0] == before[1997][0] + n_out
    assert all(after[y] == before[y] for y in before if y not in (1996, 1997))
    totals_agree(spark, root)
    daily = store.read_current(spark, f"{root}/gold/sales_daily").filter("order_date = date'1997-06-15'")
    assert daily.agg(F.sum("transaction_count")).first()[0] >= n_out
    for t, old in files_before.items():                     # other years are the very files of the first run
        now = part_files(root, t)
        assert set(now) == set(old) and all(now[y] == old[y] for y in old if y not in (1996, 1997)), t
        assert all(not set(now[y]) & set(old[y]) for y in (1996, 1997)), t


def test_a_replay_that_would_lose_rows_is_refused(spark, sources, tmp_path, monkeypatch):
    from shelfmart.errors import ReconciliationError
    from shelfmart.operators import silver as silver_ops
    root = str(tmp_path / "wh")
    pipeline.run(spark, cfg(root, sources["clean"], "run1"))
    before = years(spark, root)
    extract = files.read_extract_csv(spark, sources["clean"])
    late = (F.split("`Order Date`", "/")[2] == "1996") & (F.col("`Row ID`").cast("long") % 5 == 0)
    files.write_extract_csv(extract.withColumn("Order Date", F.when(late, F.lit("6/15/1997")).otherwise(F.col("`Order Date`"))),
                            str(tmp_path / "moved"))
    # a fault as it was before: rows that left the window are not rebuilt under their new date
    plain = silver_ops.clean
    monkeypatch.setattr(silver_ops, "clean", lambda rows, ctx, *a: plain(rows, ctx, *a).filter(F.lit(ctx.start_date is not None)))
    with pytest.raises(ReconciliationError, match="would lose"):
        pipeline.run(spark, cfg(root, str(tmp_path / "moved"), "run2", start_date="1996-01-01", end_date="1996-12-31",
                                replay=True))
    assert years(spark, root) == before


def test_bad_values_fail_the_run_or_are_set_aside(spark, sources, tmp_path):
    root = str(tmp_path / "wh")
    bad = str(tmp_path / "bad")
    files.write_extract_csv(fixture.corrupted_extract(fixture.source_extract(spark, SF_SMALL, dirty=False)), bad)
    with pytest.raises(Exception):
        pipeline.run(spark, cfg(root, bad, "run1"))
    assert gold_count(spark, root) is None
    r = pipeline.run(spark, cfg(root, bad, "run2", bad_values="route"))
    rejected = spark.read.parquet(f"{root}/quarantine/sales_rejected")
    bronze = bronze_ops.live(store.read_current(spark, f"{root}/bronze/sales"))
    assert r.status == "SUCCESS" and r.rejected_rows == rejected.count() > 0
    assert r.silver_rows == r.gold_rows == bronze.count() - r.rejected_rows
    assert rejected.filter("failed_columns = ''").isEmpty()
    totals_agree(spark, root)
    names = {x[0] for x in store.read_current(spark, f"{root}/silver/sales").select("source_file").distinct().collect()}
    assert names and all(n.startswith("part-") for n in names)       # the file each row came in
    # the stored region summary is that of the fact
    region = store.read_current(spark, f"{root}/gold/sales_by_region").agg(F.sum("sales"), F.sum("transaction_count")).first()
    fact = store.read_current(spark, f"{root}/gold/fact_sales").agg(F.sum("sales"), F.count(F.lit(1))).first()
    assert tuple(region) == tuple(fact)
    # a replayed year of the same extract, still with bad values, loses nothing
    again = pipeline.run(spark, cfg(root, bad, "run3", bad_values="route", start_date="1996-01-01", end_date="1996-12-31",
                                    replay=True))
    assert again.status == "SUCCESS" and again.silver_rows == r.silver_rows
    with pytest.raises(ValueError):
        pipeline.run(spark, cfg(root, bad, "run4", bad_values="drop"))


def business(spark, root):
    """Published tables without audit columns and surrogate keys, as comparable rows."""
    read = lambda n: store.read_current(spark, f"{root}/{n}")
    silver = read("silver/sales").drop("run_id", "ingested_at", "order_year", "source_file")
    f, c, p, l = read("gold/fact_sales"), read("gold/dim_customers"), read("gold/dim_products"), read("gold/dim_location")
    named = (f.join(c.select("customer_key", "customer_id"), "customer_key").join(p.select("product_key", "product_id"), "product_key")
              .join(l, "location_id"))
    daily = read("gold/sales_daily").groupBy("order_date").agg(F.sum("sales"), F.sum("quantity"), F.sum("transaction_count"))
    monthly = read("gold/sales_monthly").groupBy("month_key").agg(F.sum("sales"), F.sum("quantity"), F.sum("transaction_count"))
    fact = named.select("row_id", "order_id", "order_date", "ship_date", "customer_id", "product_id", "country", "city", "postal_code",
                        "sales", "quantity", "discount", "profit")
    bronze = bronze_ops.live(read("bronze/sales")).drop("_source_file")
    return {n: sorted(map(str, df.collect())) for n, df in {
        "bronze": bronze.select(sorted(f"`{x}`" for x in bronze.columns)), "silver": silver, "fact": fact, "daily": daily, "monthly": monthly,
        "region": read("gold/sales_by_region")}.items()}


def test_incremental_loads_equal_full_ones_and_touch_few_years(spark, sources, tmp_path):
    extract = files.read_extract_csv(spark, sources["clean"])
    year, rid = F.split("`Order Date`", "/")[2], F.col("`Row ID`").cast("long")
    # a delivery of 1997 rows: some changed, some moved to 1998, some new customers and new rows
    news = (extract.filter((year == "1997") & (rid % 3 == 0))
            .withColumn("Quantity", F.when(rid % 2 == 0, "77").otherwise(F.col("Quantity")))
            .withColumn("Order Date", F.when(rid % 5 == 0, "2/3/1998").otherwise(F.col("`Order Date`")))
            .withColumn("Customer ID", F.when(rid % 7 == 0, "C-new").otherwise(F.col("`Customer ID`"))))
    more = extract.filter((year == "1997") & (rid % 11 == 0)).withColumn("Row ID", F.concat("Row ID", F.lit("00099")))
    files.write_extract_csv(news.unionByName(more), str(tmp_path / "d1"))
    files.write_extract_csv(extract.filter((year == "1995") & (rid % 2 == 0)).withColumn("Quantity", F.lit("5")), str(tmp_path / "d2"))
    roots = {k: str(tmp_path / k) for k in ("full", "few")}
    for k, root in roots.items():
        pipeline.run(spark, cfg(root, sources["clean"], "run1"))
        before = part_files(root, "gold/fact_sales") | {}
        for n, d in ((2, "d1"), (3, "d2")):
            r = pipeline.run(spark, cfg(root, str(tmp_path / d), f"run{n}", load_mode="append", start_date="1992-01-01",
                                        incremental=k == "few"))
            assert r.status == "SUCCESS" and r.silver_rows == r.gold_rows
        if k == "few":
            now = part_files(root, "gold/fact_sales")
            assert {y for y in before if now[y] != before[y]} == {1995, 1997, 1998}
            live = store.current_version(spark, f"{root}/bronze/sales")
            assert len(set(live["parts"].values())) == 3         # years in the versions of three runs
    full, few = (business(spark, root) for root in roots.values())
    assert [n for n in full if full[n] != few[n]] == []
    events = lambda root: sorted((r["run_id"], r["row_id"], r["operation"]) for r in spark.read.parquet(
        f"{root}/control/cdc_events").collect() if r["run_id"] != "run1")
    assert events(roots["full"]) == events(roots["few"]) != []

    # a run whose window is empty stops at bronze; the next one catches up with its years
    root = roots["few"]
    files.write_extract_csv(extract.filter((year == "1996") & (rid % 2 == 0)).withColumn("Quantity", F.lit("3")), str(tmp_path / "d3"))
    late = pipeline.run(spark, cfg(root, str(tmp_path / "d3"), "run4", load_mode="append", start_date="2030-01-01", incremental=True))
    assert late.status == "NOOP"
    pipeline.run(spark, cfg(root, str(tmp_path / "d2"), "run5", load_mode="append", start_date="1992-01-01", incremental=True))
    q = store.read_current(spark, f"{root}/silver/sales").filter("year(order_date) = 1996 and row_id % 2 = 0")
    assert q.count() > 0 and q.filter("quantity <> 3").isEmpty()

    # an incremental upsert speaks for its window alone: rows of older years are no deletions
    window = extract.filter((year == "1998") & (rid % 4 != 0))
    files.write_extract_csv(window, str(tmp_path / "d4"))
    older = store.read_current(spark, f"{root}/silver/sales").filter("order_date < date'1998-01-01'").count()
    r = pipeline.run(spark, cfg(root, str(tmp_path / "d4"), "run6", load_mode="upsert", start_date="1998-01-01", incremental=True))
    gone = spark.read.parquet(f"{root}/control/source_deletions").filter("run_id = 'run6'")
    assert gone.count() > 0
    held = bronze_ops.live(store.read_current(spark, f"{root}/bronze/sales"))
    assert held.join(gone, F.col("`Row ID`") == F.col("row_id")).filter(year < "1998").isEmpty()
    assert store.read_current(spark, f"{root}/silver/sales").filter("order_date < date'1998-01-01'").count() == older
    # what an upsert hides comes back with the next load
    pipeline.run(spark, cfg(root, str(tmp_path / "d2"), "run7", load_mode="append", start_date="1992-01-01", incremental=True))
    assert store.read_current(spark, f"{root}/silver/sales").count() == held.count()
    totals_agree(spark, root)


def state(spark, root):
    """All logs and published tables as sorted rows, without the file names."""
    import glob
    out = {}
    for t in sorted(glob.glob(f"{root}/*/*")):
        layer, name = t.split("/")[-2:]
        if name in ("sales_stage", "sales_delivery", "sales_window"):
            continue
        df = store.read_current(spark, t) if layer in ("gold", "silver") or name == "sales" else store.read_log(spark, t)
        if df is not None:
            out[f"{layer}/{name}"] = sorted(str(r) for r in df.collect())
    return out


def test_a_repeated_run_id_leaves_the_state_of_one_run(spark, sources, tmp_path):
    root = str(tmp_path / "wh")
    pipeline.run(spark, cfg(root, sources["clean"], "run1"))
    for k, mode in enumerate(("upsert", "snapshot"), start=2):
        again = cfg(root, sources["partial" if k < 4 else "clean"], f"run{k}", load_mode=mode)
        pipeline.run(spark, again)
        once = state(spark, root)
        pipeline.run(spark, again)
        twice = state(spark, root)
        assert len(once) >= 15 and once.keys() == twice.keys()
        assert [n for n in once if once[n] != twice[n]] == [], mode


def test_null_order_date_is_refused_and_nothing_is_published(spark, sources, tmp_path):
    from shelfmart.errors import KeyIntegrityError
    root = str(tmp_path / "wh")
    pipeline.run(spark, cfg(root, sources["clean"], "run1"))
    before = years(spark, root), store.read_current(spark, f"{root}/bronze/sales").count()
    extract = files.read_extract_csv(spark, sources["clean"])
    first = extract.select(F.min(F.col("`Row ID`").cast("long"))).first()[0]
    broken = extract.withColumn("Order Date", F.when(F.col("`Row ID`") == str(first), F.lit(None)).otherwise(F.col("`Order Date`")))
    files.write_extract_csv(broken.limit(50).union(broken.filter(F.col("`Row ID`") == str(first))), str(tmp_path / "null"))
    with pytest.raises(KeyIntegrityError, match="fact_sales"):
        pipeline.run(spark, cfg(root, str(tmp_path / "null"), "run2", failure_mode="WARN"))
    assert (years(spark, root), store.read_current(spark, f"{root}/bronze/sales").count()) == before
    led = {r["run_id"]: r["status"] for r in pipeline.run_ledger(spark, root).collect()}
    assert led == {"run1": "SUCCESS", "run2": "FAILED"}
