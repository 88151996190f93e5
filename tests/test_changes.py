"""Bucketed storage, the classified stream of a load, deltas, routed casts, partition maps."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shelfmart.config import SOURCE_FILE, SOURCE_KEY
from shelfmart.errors import ContractError
from shelfmart.operators import bronze, cdc, facts, keys, silver
from shelfmart.operators.silver import RunContext
from shelfmart.plans.warehouse import shared
from shelfmart.sources import files, fixture, store

from conftest import SF_SMALL, rows

SCHEMA = "`Row ID` string, a string, `b c` string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_state(r, n):
    return {str(k): (r.choice(["x", "y", None]), r.choice(["1", None])) for k in r.sample(range(40), n)}


def frame(spark, state):
    return spark.createDataFrame([(k, *v) for k, v in state.items()], SCHEMA)


# ---- the classified stream -------------------------------------------------------------------------

@pytest.mark.parametrize("mode", ["full", "snapshot", "upsert", "append"])
def test_changes_applied_to_the_old_state_give_the_new_one(spark, mode):
    r = random.Random(mode)
    for _ in range(4):
        old, new = random_state(r, r.randrange(30)), random_state(r, r.randrange(30))
        stream = bronze.changes(frame(spark, old), frame(spark, new), mode).cache()
        want = dict(new) if mode in ("full", "snapshot") else {**old, **new}
        assert {x[0]: tuple(x)[1:] for x in bronze.live(stream).collect()} == want
        ops = {x["row_id"]: x["operation"] for x in cdc.events(stream, "r", "2024-01-01 00:00:00").collect()}
        gone = set() if mode == "append" else set(old) - set(new)
        assert ops == {**{k: "INSERT" for k in set(new) - set(old)}, **{k: "DELETE" for k in gone},
                       **{k: "UPDATE" for k in set(new) & set(old) if new[k] != old[k]}}
        before, after = ({x[0]: tuple(x)[1:] for x in side.collect()} for side in bronze.images(stream))
        assert before == {k: old[k] for k, o in ops.items() if o != "INSERT"}
        assert after == {k: new[k] for k, o in ops.items() if o != "DELETE"}
        # the events carry the old state to the new one
        applied = {k: v for k, v in old.items() if k not in before} | after
        assert applied == (want if mode != "upsert" else {k: v for k, v in want.items() if k not in gone})
        assert rows(bronze.apply_load(frame(spark, old), frame(spark, new), mode)) == rows(bronze.live(stream))


def test_first_load_inserts_everything(spark):
    stream = bronze.changes(None, frame(spark, {"1": ("a", None)}), "upsert")
    assert [x[bronze.CHANGE] for x in stream.collect()] == ["INSERT"] and bronze.images(stream)[0].isEmpty()
    assert bronze.changes(frame(spark, {}), frame(spark, {}), "full").isEmpty()


def test_the_file_a_row_came_in_is_no_change_and_new_columns_are(spark):
    old = frame(spark, {"1": ("a", "b")}).withColumn(SOURCE_FILE, F.lit("monday.csv"))
    new = old.withColumn(SOURCE_FILE, F.lit("tuesday.csv"))
    only = bronze.changes(old, new, "full").first()
    assert only[bronze.CHANGE] == "KEEP" and only[SOURCE_FILE] == "tuesday.csv"
    wider = bronze.changes(old, new.withColumn("d", F.lit("new")), "upsert").first()
    assert wider[bronze.CHANGE] == "UPDATE" and wider["d"] == "new" and wider[bronze.OLD]["a"] == "a"


# ---- bucketed storage ----------------------------------------------------------------------------------

def test_bucketed_sides_are_joined_without_an_exchange(spark):
    w = shared(spark, SF_SMALL)
    for mode in ("upsert", "full", "append"):
        p = plan(w.changes(mode))
        assert p.count("SortMergeJoin") == 1 and "Exchange" not in p
        for df in (cdc.events(w.changes(mode), "r", "2024-01-01 00:00:00"), bronze.live(w.changes(mode))):
            assert plan(df).count("Join") == 1 and "Exchange hashpartitioning" not in plan(df)   # AQE may broadcast a small side
    dedup = plan(bronze.dedup_by_key(w.incoming))
    assert dedup.count("Exchange") == 1                       # a delivery is exchanged once, for its own duplicates


def test_a_bucketed_table_is_found_again_by_another_session(spark, tmp):
    df = spark.range(500).select(F.col("id").cast("string").alias(SOURCE_KEY), (F.col("id") % 3).cast("int").alias("part`y"),
                                 F.struct(F.lit("x").alias("Sub-Category"), F.lit(None).cast("string").alias("a b")).alias("_old"))
    path = f"{tmp}/t"
    store.write_bucketed(df, path, SOURCE_KEY, 4, ["part`y"])
    with store.shuffled_into(spark, 4):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    first = rows(store.read_table(spark, path))
    assert len(first) == 500 and store.layout(spark, path)["buckets"] == 4 and store.layout(spark, tmp) is None
    spark.sql(f"DROP TABLE {store._table_name(path)}")        # as a new session finds it: files and layout alone
    again = store.read_table(spark, path)
    assert rows(again) == first
    assert "Exchange" not in plan(again.groupBy(f"`{SOURCE_KEY}`").count())
    assert "PartitionFilters: [isnotnull(part`y" in plan(again.filter("`part``y` = 1"))
    store.write_bucketed(df.limit(3), path, SOURCE_KEY, 2)    # replaced, with another layout
    assert store.read_table(spark, path).count() == 3 and store.layout(spark, path)["buckets"] == 2


# ---- partition maps -------------------------------------------------------------------------------------

def test_untouched_partitions_stay_in_their_files(spark, tmp):
    table = f"{tmp}/gold/t"
    df = spark.createDataFrame([(y, n) for y in (1995, 1996, 1997) for n in range(5)], "y int, n int")
    one = store.stage_parts(df, table, "y")
    stamp = {p: os.stat(f"{table}/v=1/y={p}").st_mtime_ns for p in (1995, 1997)}
    two = store.stage_parts(df.filter("y = 1996 and n < 2"), table, "y", one, ["1996"])
    assert two["parts"] == {"1995": 1, "1996": 2, "1997": 1} and os.listdir(f"{table}/v=2") != []
    assert [d for d in os.listdir(f"{table}/v=2") if d.startswith("y=")] == ["y=1996"]
    assert {p: os.stat(f"{table}/v=1/y={p}").st_mtime_ns for p in (1995, 1997)} == stamp
    store.commit(spark, table, two)
    read = store.read_current(spark, table)
    assert sorted((r["y"], r["n"]) for r in read.collect()) == sorted(
        [(y, n) for y in (1995, 1997) for n in range(5)] + [(1996, 0), (1996, 1)])
    assert "PartitionFilters: [isnotnull(y" in plan(read.filter("y = 1997"))
    three = store.stage_parts(df.filter("y = 2000"), table, "y", two, ["1995", "1997"])   # two years lose all rows
    assert three["parts"] == {"1996": 2} and store.read_version(spark, table, three).count() == 2
    none = store.stage_parts(df.limit(0), table, "y", three, ["1996"])
    assert none["parts"] == {} and store.read_version(spark, table, none).columns == ["y", "n"]
    assert store.read_version(spark, table, none).isEmpty()
    # a table written whole before is split up when it is first touched
    whole = store.stage(df, f"{tmp}/gold/u", ["y"])
    assert store.stage_parts(df.filter("y = 1995"), f"{tmp}/gold/u", "y", whole, ["1995"])["parts"] == {
        "1995": 2, "1996": 1, "1997": 1}


# ---- deltas ---------------------------------------------------------------------------------------------

def test_rollups_kept_by_deltas_equal_a_rebuild(spark):
    r = random.Random(9)
    fact = lambda n: {k: (f"2024-0{r.randint(1, 3)}-0{r.randint(1, 3)}", r.randrange(3), r.choice([1, 2, -1]) * 1.25,
                          r.randrange(5)) for k in r.sample(range(60), n)}
    make = lambda d: spark.createDataFrame([(k, *v) for k, v in d.items()],
                                           "row_id long, order_date string, customer_key long, s double, quantity int").select(
        "row_id", F.col("order_date").cast("date").alias("order_date"), "customer_key", F.lit(1).alias("product_key"),
        F.lit(1).alias("location_id"), F.col("s").cast("decimal(18,4)").alias("sales"), "quantity",
        F.col("s").cast("decimal(18,4)").alias("profit"))
    old = fact(40)
    daily, monthly = facts.sales_daily(make(old)), facts.sales_monthly(facts.sales_daily(make(old)))
    for _ in range(3):                                       # inserts, updates, deletes, date changes
        new = {**{k: v for k, v in old.items() if r.random() < 0.7}, **fact(15)}
        before = make({k: v for k, v in old.items() if new.get(k) != v})
        after = make({k: v for k, v in new.items() if old.get(k) != v})
        delta = facts.rollup_delta(before, after, facts.DAILY_KEYS)
        daily = spark.createDataFrame(facts.merge_rollup(daily, delta, facts.DAILY_KEYS).collect(), daily.schema)
        month_keys = ["month_key", *facts.DAILY_KEYS[1:]]
        monthly = spark.createDataFrame(facts.merge_rollup(monthly, facts.monthly_delta(delta), month_keys).collect(),
                                        monthly.schema)
        rebuilt = facts.sales_daily(make(new))
        plain = lambda df, ks: rows(df.select(*ks, *[F.col(m).cast("double").alias(m) for m in facts.MEASURES]))
        assert plain(daily, facts.DAILY_KEYS) == plain(rebuilt, facts.DAILY_KEYS)
        assert plain(monthly, month_keys) == plain(facts.sales_monthly(rebuilt), month_keys)
        old = new
    assert facts.rollup_delta(make(old), make(old), facts.DAILY_KEYS).isEmpty()


# ---- as-of lookup -----------------------------------------------------------------------------------------

def test_asof_merge_equals_brute_force(spark):
    import datetime as dt
    r = random.Random(7)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    at = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n, hours=r.choice([0, 0, 5]))
    versions, key = [], 0
    for c in ("hot", "a", "b", "c"):
        cuts = sorted({at(r.randrange(200)) for _ in range(r.choice([1, 3, 8]))})
        for k, start in enumerate(cuts):
            key += 1
            end = cuts[k + 1] if k + 1 < len(cuts) else r.choice([None, start + dt.timedelta(days=9)])
            if r.random() < 0.8:                            # gaps between versions
                versions.append((key, c, start, end))
    lines = [(n, r.choice(["hot"] * 6 + ["a", "b", "c", "none", None]), r.choice([day(r.randrange(260)), None] + [day(31)] * 2))
             for n in range(400)]
    h = spark.createDataFrame(versions, "customer_key long, customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    s = spark.createDataFrame(lines, "row_id long, customer_id string, order_date date")
    want = {}
    for n, c, d in lines:
        t = None if d is None else dt.datetime(d.year, d.month, d.day)
        found = [k for k, vc, a, b in versions if t is not None and vc == c and a <= t and (b is None or t < b)]
        assert len(found) < 2
        want[n] = (c, d, found[0] if found else None)
    out = facts.fact_scd2_asof(s, h)
    assert out.columns == ["row_id", "customer_id", "order_date", "asof_customer_key"]
    assert {x[0]: tuple(x)[1:] for x in out.collect()} == want and out.count() == len(lines)
    assert facts.fact_scd2_asof(s, h.limit(0)).filter("asof_customer_key is not null").isEmpty()
    assert facts.fact_scd2_asof(s.limit(0), h).isEmpty()


# ---- routed casts ------------------------------------------------------------------------------------------

CTX = RunContext("r1", "2024-01-01 00:00:00", "f.csv")


def test_bad_values_are_routed_and_all_rows_accounted_for(spark):
    extract = bronze.dedup_by_key(fixture.corrupted_extract(fixture.source_extract(spark, SF_SMALL))).cache()
    for ctx in (CTX, RunContext("r1", CTX.ingested_at, "f.csv", "1996-01-01", "1996-12-31")):
        good, rejected = silver.route_bad_values(extract, ctx)
        counts = silver.reconcile_routed(extract, good, rejected, ctx).first()
        assert counts["passed"] and counts["silver_rows"] > 0 and counts["rejected_rows"] > 0
    reasons = {r[0] for r in silver.route_bad_values(extract, CTX)[1].select("failed_columns").distinct().collect()}
    assert {"Quantity", "Sales", "Order Date", "Discount, Ship Date"} <= reasons
    with pytest.raises(Exception):
        silver.clean(extract, CTX).agg(F.sum("quantity"), F.sum("sales")).collect()    # the strict form fails
    clean = bronze.dedup_by_key(fixture.source_extract(spark, SF_SMALL))
    good, rejected = silver.route_bad_values(clean, CTX)
    assert rejected.isEmpty() and good.exceptAll(silver.clean(clean, CTX)).isEmpty()


def test_null_cells_are_no_bad_values(spark):
    one = fixture.source_extract(spark, SF_SMALL).limit(1)
    empty = one.select(*[F.lit(None).cast("string").alias(c) if c not in ("Row ID", "Order ID") else F.col(f"`{c}`")
                         for c in one.columns])
    good, rejected = silver.route_bad_values(empty, CTX)
    assert rejected.isEmpty() and good.first()["quantity"] is None


# ---- numbering --------------------------------------------------------------------------------------------

def test_numbering_has_no_exchange_after_the_range_layout(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("pad"))
    for n in (1, 7, None):
        out = keys.dense_key(df, ["k"], "nr", offset=10, partitions=n)
        p = plan(out)
        assert "Window" not in p and p.count("Exchange") == p.count("BroadcastExchange")
        assert sorted((r["nr"], r["k"]) for r in out.collect()) == [(k + 11, k) for k in range(1000)]
    assert keys.dense_key(df.limit(0), ["k"], "nr").isEmpty()


# ---- headers per file -----------------------------------------------------------------------------------------

def test_headers_of_every_file(spark, tmp):
    d = f"{tmp}/in"
    os.makedirs(f"{d}/run=2")
    for name, text in (("a.csv", "Row ID,\"Sub, \"\"x\"\"\",Näme\n1,2,3\n"), ("b.csv", "Row ID,Name\n1,2\n" * 50), ("c.csv", "")):
        with open(f"{d}/run=2/{name}", "w", encoding=files.ENCODING) as f:
            f.write(text)
    got = {r["file_name"]: (r["columns"], r["run"]) for r in files.file_headers(spark, d).collect()}
    assert got == {"a.csv": ("Row ID,Sub, \"x\",Näme", 2), "b.csv": ("Row ID,Name", 2)}


def test_one_deviating_file_of_a_directory_is_named(spark, tmp):
    extract = fixture.source_extract(spark, SF_SMALL, dirty=False).limit(200)
    good = f"{tmp}/good"
    files.write_extract_csv(extract.repartition(3), good)
    files.check_headers(spark, good)
    staged, _ = files.guarded_read(spark, good, f"{tmp}/stage")
    names = {r[0] for r in staged.select(SOURCE_FILE).distinct().collect()}
    assert names == {n for n in os.listdir(good) if n.startswith("part-")}
    for k, columns in enumerate((extract.columns[:-1], extract.columns[::-1])):
        bad = f"{tmp}/bad{k}"
        files.write_extract_csv(extract.repartition(3), bad)
        files.write_extract_csv(extract.limit(2).coalesce(1).select(*[f"`{c}`" for c in columns]), f"{tmp}/odd{k}")
        odd = next(n for n in os.listdir(f"{tmp}/odd{k}") if n.startswith("part-"))
        with open(f"{tmp}/odd{k}/{odd}", "rb") as f, open(f"{bad}/part-zzz.csv", "wb") as g:
            g.write(f.read())
        with pytest.raises(ContractError, match="part-zzz.csv"):
            files.guarded_read(spark, bad, f"{tmp}/stage{k}")
