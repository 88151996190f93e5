import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmart.config import SOURCE_COLUMNS
from shelfmart.errors import KeyIntegrityError, ReconciliationError
from shelfmart.operators import silver
from shelfmart.operators.silver import RunContext

CTX = RunContext("run-1", "2024-01-01 00:00:00", "f.csv")


def raw(spark, rows):
    base = {c: None for c in SOURCE_COLUMNS}
    data = []
    for r in rows:
        d = dict(base, **{"Order ID": "O-1", "Order Date": "1/3/2016", "Ship Date": "12/31/2016",
                          "Customer Name": "  Ann  ", "Sales": "10.5", "Quantity": "2",
                          "Discount": "0.1", "Profit": "1.25"})
        d.update(r)
        data.append(tuple(d[c] for c in SOURCE_COLUMNS))
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in SOURCE_COLUMNS))


def test_typed_parse_trim_default(spark):
    df = silver.clean(raw(spark, [{"Row ID": "1"}]), CTX)
    r = df.first()
    assert r["row_id"] == 1 and r["order_date"] == dt.date(2016, 1, 3) and r["ship_date"] == dt.date(2016, 12, 31)
    assert r["customer_name"] == "Ann" and r["postal_code"] == "00000"
    assert float(r["sales"]) == 10.5 and r["quantity"] == 2 and r["pipeline_version"] == "1.0.0"
    assert r["run_id"] == "run-1" and str(r["ingested_at"]) == "2024-01-01 00:00:00"
    assert df.columns[:3] == ["row_id", "order_id", "order_date"] and len(df.columns) == 25


def test_bad_number_fails_the_build(spark):
    with pytest.raises(Exception):
        silver.clean(raw(spark, [{"Row ID": "1", "Quantity": "two"}]), CTX).collect()


def test_not_null_filter_and_window(spark):
    b = raw(spark, [{"Row ID": "1"}, {"Row ID": "2", "Order ID": None},
                    {"Row ID": "3", "Order Date": "1/2/2016"}, {"Row ID": "4", "Order Date": "1/4/2016"},
                    {"Row ID": "5", "Order Date": None}])
    assert silver.clean(b, CTX).count() == 4                          # null order id dropped, null date kept
    w = RunContext("run-1", CTX.ingested_at, "f", "2016-01-03", "2016-01-03")
    assert [r["row_id"] for r in silver.clean(b, w).collect()] == [1]  # inclusive, null date dropped
    only_start = RunContext("run-1", CTX.ingested_at, "f", "2016-01-03", None)
    assert sorted(r["row_id"] for r in silver.clean(b, only_start).collect()) == [1, 4]
    assert silver.window_count(b, start="2016-01-03").first()["source_rows"] == 2


def test_soft_delete_only_this_run(spark):
    b = raw(spark, [{"Row ID": "1"}, {"Row ID": "2"}])
    dels = spark.createDataFrame([("run-1", "1"), ("run-0", "2")], "run_id string, row_id string")
    assert [r["row_id"] for r in silver.clean(b, CTX, dels).collect()] == [2]


def test_quarantine_first_match_and_nulls(spark):
    b = raw(spark, [{"Row ID": "1", "Quantity": "0", "Discount": "2"}, {"Row ID": "2", "Discount": "1.5"},
                    {"Row ID": "3", "Sales": "-1"}, {"Row ID": "4", "Quantity": None, "Discount": None},
                    {"Row ID": "5"}])
    q = {r["row_id"]: r["reason"] for r in silver.quarantine(silver.clean(b, CTX)).collect()}
    assert q == {1: "quantity <= 0", 2: "discount outside [0,1]", 3: "sales < 0"}


def test_profile_counts_null_keys_as_duplicates(spark):
    b = raw(spark, [{"Row ID": "1"}, {"Row ID": "1"}, {"Row ID": None, "Order ID": None}])
    r = silver.profile(b).first()
    assert (r["total_rows"], r["null_order_ids"], r["duplicate_row_ids"]) == (3, 1, 2)
    long = {x["metric_name"]: x["metric_value"] for x in silver.profile_long(silver.profile(b), "r").collect()}
    assert long == {"total_rows": 3, "null_order_ids": 1, "duplicate_row_ids": 2}


def test_reconcile_and_keys(spark):
    b = raw(spark, [{"Row ID": "1"}, {"Row ID": "2"}])
    s = silver.clean(b, CTX)
    assert silver.assert_reconciled(silver.reconcile_bronze_silver(b, s, CTX)) == (2, 2)
    with pytest.raises(ReconciliationError):
        silver.assert_reconciled(silver.reconcile_bronze_silver(b, s.limit(1), CTX))
    dup = s.union(s).union(s.withColumn("row_id", F.lit(None).cast("long")))
    v = silver.key_violations(dup, "silver", ["row_id"]).first()
    assert (v["null_keys"], v["duplicate_keys"]) == (2, 2)
    with pytest.raises(KeyIntegrityError):
        silver.assert_keys(silver.key_violations(dup, "silver", ["row_id"]))
    silver.assert_keys(silver.key_violations(s, "silver", ["row_id"]))
