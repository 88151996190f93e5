import datetime as dt
import logging

import pytest
from pyspark.sql import functions as F

from shelfmart.errors import DataQualityError
from shelfmart.operators import control, facts, quality

from conftest import rows


def test_location_join_is_null_rejecting(spark):
    s = spark.createDataFrame([(1, "US", "W", "CA", "LA", "00001"), (2, "US", "W", None, "LA", "00001")],
                              "row_id long, country string, region string, state string, city string, postal_code string")
    loc = s.select("country", "region", "state", "city", "postal_code").distinct().withColumn("location_id", F.lit(7))
    out = dict(rows(s.join(loc, ["country", "region", "state", "city", "postal_code"], "left")
                    .select("row_id", "location_id")))
    assert out == {1: 7, 2: None}


def _fact(spark):
    return spark.createDataFrame(
        [(1, "O1", dt.date(2024, 1, 5), dt.date(2024, 1, 3), 1, 1, 1, 2.0, 1, 0.0, 1.0),
         (2, "O1", dt.date(2024, 1, 5), dt.date(2024, 1, 9), 1, 2, 1, 3.0, 2, 0.5, -1.0),
         (3, "O2", dt.date(2024, 2, 1), None, 2, 2, None, 4.0, 3, 0.0, 2.0)],
        "row_id long, order_id string, order_date date, ship_date date, customer_key long, product_key long, "
        "location_id long, sales double, quantity int, discount double, profit double").withColumn(
        "sales", F.col("sales").cast("decimal(18,4)")).withColumn("profit", F.col("profit").cast("decimal(18,4)"))


def test_rollups_reconcile(spark):
    f = _fact(spark)
    d = facts.sales_daily(f)
    m = facts.sales_monthly(d)
    tot = lambda df, c: float(df.agg(F.sum(c)).first()[0])
    assert tot(f, "sales") == tot(d, "sales") == tot(m, "sales") == 9.0
    assert tot(d, "transaction_count") == tot(m, "transaction_count") == 3
    assert facts.reconcile_fact_daily(f, d, 1e-6).first()["passed"]
    assert {r["month_key"] for r in m.collect()} == {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}


def test_order_fulfillment_negative_lead_time_kept(spark):
    of = {r["order_id"]: r for r in facts.order_fulfillment(_fact(spark)).collect()}
    assert of["O1"]["days_to_ship"] == 4 and of["O1"]["line_count"] == 2
    assert of["O2"]["days_to_ship"] is None


def test_empty_window_reconcile_fails_explicitly(spark):
    f = _fact(spark).filter(F.lit(False))
    assert facts.reconcile_fact_daily(f, facts.sales_daily(f), 1e-6).first()["passed"] is False


def test_rules_and_policy(spark, caplog):
    f = _fact(spark)
    s = f.select("sales", "profit", "quantity")
    checks = quality.rule_checks(s, f)
    res = quality.quality_results(checks, "r", "2024-01-01 00:00:00")
    got = {r["rule_name"]: r["passed"] for r in res.collect()}
    assert got == {"silver/gold row count": True, "null location keys": False,
                   "invalid measures": True, "silver/gold totals": True}
    with pytest.raises(DataQualityError, match="null location keys"):
        quality.enforce(res, "STOP")
    with caplog.at_level(logging.WARNING):
        assert quality.enforce(res, "WARN") == ["null location keys"]
        assert quality.enforce(res, "QUARANTINE") == ["null location keys"]
    with pytest.raises(ValueError):
        quality.enforce(res, "IGNORE")
    cat = quality.rules_with_results(quality.rule_catalogue(spark), res)
    assert cat.count() == 4 and cat.filter("severity = 'QUARANTINE'").count() == 1


def test_watermark_monotone_and_replay(spark):
    runs = spark.createDataFrame(
        [("p", 1, "r1", dt.date(2024, 1, 10), False), ("p", 2, "r2", dt.date(2024, 1, 5), False),
         ("p", 3, "r3", dt.date(2024, 3, 1), True), ("p", 4, "r4", None, False), ("p", 5, "r5", dt.date(2024, 2, 1), False)],
        "pipeline_name string, run_seq long, run_id string, max_order_date date, replay boolean")
    wm = {r["run_id"]: r["watermark_date"] for r in control.running_watermarks(runs).collect()}
    assert wm == {"r1": dt.date(2024, 1, 10), "r2": dt.date(2024, 1, 10), "r3": dt.date(2024, 1, 10),
                  "r4": dt.date(2024, 1, 10), "r5": dt.date(2024, 2, 1)}
    cur = spark.createDataFrame([("p", dt.date(2024, 1, 10))], "pipeline_name string, watermark_date date")
    prop = spark.createDataFrame([("p", dt.date(2024, 1, 1), dt.datetime(2024, 1, 2), False)],
                                 "pipeline_name string, watermark_date date, updated_at timestamp_ntz, replay boolean")
    assert control.advance(cur, prop).first()["watermark_date"] == dt.date(2024, 1, 10)
    assert control.advance(cur, prop.withColumn("replay", F.lit(True))).count() == 0
    assert spark.range(1).select(control.overlap_start(F.lit(dt.date(2024, 1, 10)))).first()[0] == dt.date(2024, 1, 8)
    asked = [(0, "append", False), (0, "full", False), (0, "upsert", True), (5, "upsert", False), (0, "upsert", False), (None, "append", False)]
    runs = spark.createDataFrame([(f"r{k}", m, r, n) for k, (n, m, r) in enumerate(asked)],
                                 "run_id string, mode string, replay boolean, window_rows long")
    assert [r["noop"] for r in control.noop_decisions(runs).orderBy("run_id").collect()] == [True, False, False, False, True, False]
    scopes = control.rebuild_scopes(spark.createDataFrame(
        [("a", "append", "2024-01-01", None), ("f", "full", "2024-01-01", None)],
        "run_id string, mode string, start_date string, end_date string")).orderBy("run_id").collect()
    assert [tuple(r)[2:] for r in scopes] == [(None, None), ("2024-01-01", None)]


def test_ledger_latest_state(spark):
    ev = spark.createDataFrame(
        [("r1", "p", dt.datetime(2024, 1, 1, 0, 0), "STARTED", None, None, None, None),
         ("r1", "p", dt.datetime(2024, 1, 1, 0, 5), "SUCCESS", 10, 9, 9, None),
         ("r2", "p", dt.datetime(2024, 1, 2, 0, 0), "STARTED", None, None, None, None),
         ("r2", "p", dt.datetime(2024, 1, 2, 0, 1), "FAILED", None, None, None, "boom")],
        "run_id string, pipeline_name string, event_at timestamp_ntz, status string, bronze_rows long, "
        "silver_rows long, gold_rows long, error_message string")
    led = {r["run_id"]: r for r in control.ledger(ev).collect()}
    assert led["r1"]["status"] == "SUCCESS" and led["r1"]["silver_rows"] == 9
    assert led["r2"]["status"] == "FAILED" and led["r2"]["error_message"] == "boom"
    assert led["r1"]["started_at"] == dt.datetime(2024, 1, 1) and led["r1"]["finished_at"] == dt.datetime(2024, 1, 1, 0, 5)
