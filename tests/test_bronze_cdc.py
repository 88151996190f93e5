import pytest
from pyspark.sql import functions as F

from shelfmart.operators import bronze, cdc

from conftest import rows

SCHEMA = "`Row ID` string, a string, b string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_dedup_keeps_greatest_row_deterministically(spark):
    df = frame(spark, [("1", "x", None), ("1", "x", "z"), ("1", "a", "q"), ("2", None, None), ("2", None, None)])
    out = rows(bronze.dedup_by_key(df))
    assert out == [("1", "x", "z"), ("2", None, None)]
    # same result whatever the input order / partitioning
    assert rows(bronze.dedup_by_key(df.repartition(3).orderBy(F.rand(7)))) == out


def test_dedup_empty(spark):
    assert bronze.dedup_by_key(frame(spark, [])).count() == 0


def test_invalid_mode():
    with pytest.raises(ValueError, match="is not a load mode"):
        bronze.check_load_mode("merge")


def test_load_modes(spark):
    old = frame(spark, [("1", "a", "a"), ("2", "b", "b"), ("3", "c", "c")])
    new = frame(spark, [("2", "B", "B"), ("4", "d", "d"), ("4", "d", "e")])
    assert rows(bronze.apply_load(old, new, "full")) == [("2", "B", "B"), ("4", "d", "e")]
    assert rows(bronze.apply_load(old, new, "snapshot")) == [("2", "B", "B"), ("4", "d", "e")]
    expect = [("1", "a", "a"), ("2", "B", "B"), ("3", "c", "c"), ("4", "d", "e")]
    assert rows(bronze.apply_load(old, new, "append")) == expect
    assert rows(bronze.apply_load(old, new, "upsert")) == expect
    assert rows(bronze.apply_load(None, new, "append")) == [("2", "B", "B"), ("4", "d", "e")]


def test_cdc_classification_null_safe(spark):
    old = frame(spark, [("1", "a", None), ("2", "b", "b"), ("3", "c", "c"), ("5", None, None)])
    new = frame(spark, [("1", "a", "now"), ("2", "b", "b"), ("4", "d", "d"), ("5", None, None)])
    ev = {r["row_id"]: r["operation"] for r in cdc.classify(old, new).collect()}
    assert ev == {"1": "UPDATE", "3": "DELETE", "4": "INSERT"}


def test_cdc_events_append_has_no_deletes(spark):
    old = frame(spark, [("1", "a", "a"), ("3", "c", "c")])
    new = frame(spark, [("1", "A", "a"), ("4", "d", "d")])
    up = cdc.cdc_events(old, new, "r1", "2024-01-01 00:00:00", "upsert")
    ap = cdc.cdc_events(old, new, "r1", "2024-01-01 00:00:00", "append")
    assert {r["operation"] for r in up.collect()} == {"UPDATE", "DELETE", "INSERT"}
    assert {r["operation"] for r in ap.collect()} == {"UPDATE", "INSERT"}
    assert cdc.source_deletions(up, "append").count() == 0
    assert [r["row_id"] for r in cdc.source_deletions(up, "full").collect()] == ["3"]


def test_cdc_applied_to_old_gives_new(spark):
    """Property: the change log explains the difference exactly."""
    old = frame(spark, [(str(i), str(i % 3), "x") for i in range(0, 40)])
    new = frame(spark, [(str(i), str(i % 4), "x") for i in range(20, 60)])
    ev = {r["row_id"]: r["operation"] for r in cdc.classify(old, new).collect()}
    o = {r[0]: r for r in old.collect()}
    n = {r[0]: r for r in new.collect()}
    assert {k for k, v in ev.items() if v == "INSERT"} == n.keys() - o.keys()
    assert {k for k, v in ev.items() if v == "DELETE"} == o.keys() - n.keys()
    assert {k for k, v in ev.items() if v == "UPDATE"} == {k for k in o.keys() & n.keys() if o[k] != n[k]}
    assert rows(bronze.apply_load(old, new, "full")) == sorted(rows(new))


def test_snapshot_rows(spark):
    df = bronze.snapshot_rows(frame(spark, [("1", "a", "b")]), "r9", "2024-01-01 00:00:00")
    r = df.first()
    assert r["snapshot_run_id"] == "r9" and str(r["snapshot_at"]) == "2024-01-01 00:00:00"


def test_deleted_keys_equal_delete_events(spark):
    old = frame(spark, [(str(i), "a", "b") for i in range(30)])
    new = frame(spark, [(str(i), "a", "c") for i in range(10, 45)])
    ev = cdc.source_deletions(cdc.cdc_events(old, new, "r", "2024-01-01 00:00:00", "upsert"), "upsert")
    dk = cdc.deleted_keys(old, new, "r", "2024-01-01 00:00:00", "upsert")
    assert rows(ev) == rows(dk) and len(rows(dk)) == 10
    assert cdc.deleted_keys(old, new, "r", "2024-01-01 00:00:00", "append").count() == 0
