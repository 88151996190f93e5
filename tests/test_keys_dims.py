import datetime as dt

from pyspark.sql import functions as F

from shelfmart.operators import dims
from shelfmart.operators.keys import dense_key

from conftest import rows


def test_dense_key_is_the_rank(spark):
    df = spark.range(1500).select((F.col("id") * 7919 % 1500).cast("string").alias("k"))
    df = df.union(spark.createDataFrame([(None,)], "k string"))
    a = rows(dense_key(df, ["k"], "key", partitions=7))
    assert [r[0] for r in sorted(a, key=lambda r: r[1])][:-1] == sorted(r[0] for r in a if r[0] is not None)
    keys = sorted(r[1] for r in a)
    assert keys == list(range(1, 1502))
    assert dict((r[0], r[1]) for r in a)[None] == 1501          # nulls last


def test_dense_key_offset(spark):
    df = spark.createDataFrame([("b",), ("a",)], "k string").withColumn("_o", F.lit(10))
    assert rows(dense_key(df, ["k"], "key", offset=F.col("_o")).select("k", "key")) == [("a", 11), ("b", 12)]


def _silver(spark, data):
    return spark.createDataFrame(
        data, "row_id long, customer_id string, customer_name string, segment string, ingested_at timestamp_ntz")


def test_latest_per_key_tie_break(spark):
    t = dt.datetime(2024, 1, 1)
    s = _silver(spark, [(1, "C1", "old", "A", t), (2, "C1", "new", "B", t), (3, "C2", "x", "A", t)])
    d = {r["customer_id"]: (r["customer_key"], r["customer_name"]) for r in dims.dim_customers(s).collect()}
    assert d == {"C1": (1, "new"), "C2": (2, "x")}


def test_dim_date_weekend(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, 6), dt.date(2024, 1, 7)), (dt.date(2024, 1, 8), None)],
                              "order_date date, ship_date date")
    d = {r["date_key"]: r for r in dims.dim_date(s).collect()}
    assert len(d) == 3
    assert d[dt.date(2024, 1, 6)]["is_weekend"] and d[dt.date(2024, 1, 7)]["is_weekend"]
    assert not d[dt.date(2024, 1, 8)]["is_weekend"]
    assert d[dt.date(2024, 1, 7)]["day_name"] == "Sunday" and d[dt.date(2024, 1, 8)]["month_name"] == "January"
    assert d[dt.date(2024, 1, 8)]["quarter"] == 1


def _snap(spark, data, ts):
    return spark.createDataFrame(data, "customer_id string, customer_name string, segment string").withColumn(
        "ingested_at", F.lit(ts).cast("timestamp_ntz"))


def test_scd2_sequential_equals_backfill_and_invariants(spark):
    b1 = _snap(spark, [("C1", "a", "S"), ("C2", "b", "S"), ("C3", "c", "S")], "2024-01-01 00:00:00")
    b2 = _snap(spark, [("C1", "a", "T"), ("C2", "b", "S"), ("C3", "c", None), ("C4", "d", "S")], "2024-02-01 00:00:00")
    b3 = _snap(spark, [("C1", "a", "S"), ("C2", "b", "S")], "2024-03-01 00:00:00")       # C3, C4 vanish
    h = None
    for b in (b1, b2, b3):
        h = dims.scd2_merge(h, b)
    seq = rows(h)
    back = rows(dims.scd2_backfill(b1.union(b2).union(b3)))
    assert seq == back
    cur = [r for r in seq if r[6]]
    assert sorted(r[1] for r in cur) == ["C1", "C2", "C3", "C4"]   # one current row each, vanished stay open
    assert sorted(r[0] for r in seq) == list(range(1, len(seq) + 1))
    c1 = sorted([r for r in seq if r[1] == "C1"], key=lambda r: r[4])
    assert [r[3] for r in c1] == ["S", "T", "S"] and c1[0][5] == c1[1][4]   # valid_to = next valid_from
    # re-applying the last batch changes nothing
    assert rows(dims.scd2_merge(h, b3)) == seq


def test_scd2_current_keys(spark):
    h = spark.createDataFrame(
        [(1, "C1", dt.datetime(2024, 1, 1), True), (2, "C1", dt.datetime(2024, 2, 1), True),
         (3, "C2", dt.datetime(2024, 1, 1), False)],
        "customer_key long, customer_id string, valid_from timestamp_ntz, is_current boolean")
    assert rows(dims.scd2_current_keys(h)) == [("C1", 2)]


def test_cumulative_count_multi_group(spark):
    from shelfmart.operators.keys import cumulative_count
    df = spark.range(3000).select((F.col("id") % 3).alias("g1"), (F.col("id") % 2).alias("g2"),
                                  (F.col("id") * 37 % 1000).cast("double").alias("v"),
                                  (F.col("id") % 5 + 1).alias("w")).groupBy("g1", "g2", "v").agg(F.sum("w").alias("w"))
    a = rows(cumulative_count(df, ["g1", "g2"], ["v"], "w", "before", partitions=5))
    for r in a:
        assert r[4] == sum(x[3] for x in a if x[:2] == r[:2] and x[2] < r[2])
    first = {(r[0], r[1]): r[4] for r in a if r[2] == min(x[2] for x in a if x[:2] == r[:2])}
    assert set(first.values()) == {0}
