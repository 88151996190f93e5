"""Property checks on random small frames (hypothesis)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmart.operators import bronze, cdc, keys

from conftest import rows

SCHEMA = "`Row ID` string, a string, b string"
val = st.one_of(st.none(), st.sampled_from(["x", "y", "z", ""]))
row = st.tuples(st.sampled_from([str(i) for i in range(8)]), val, val)
PROFILE = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@PROFILE
@given(st.lists(row, max_size=25), st.integers(1, 5))
def test_dedup_independent_of_partitioning(spark, data, parts):
    df = spark.createDataFrame(data, SCHEMA)
    a = rows(bronze.dedup_by_key(df))
    b = rows(bronze.dedup_by_key(df.repartition(parts).orderBy(F.rand(parts))))
    assert a == b
    assert len(a) == len({r[0] for r in data})
    best = {}
    for r in data:  # greatest row per key, None lowest
        k = tuple((v is not None, v or "") for v in r[1:])
        if r[0] not in best or k > best[r[0]][0]:
            best[r[0]] = (k, r)
    assert a == rows(spark.createDataFrame([v[1] for v in best.values()], SCHEMA))


@PROFILE
@given(st.lists(st.one_of(st.none(), st.text("abc", max_size=3)), max_size=40, unique=True), st.integers(1, 6))
def test_range_numbering_equals_window(spark, keys_, parts):
    df = spark.createDataFrame([(k,) for k in keys_], "k string")
    from pyspark.sql import Window
    a = rows(df.withColumn("n", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_last())).cast("long")))
    b = rows(keys.dense_key(df, ["k"], "n", partitions=parts))
    assert a == b and sorted(r[1] for r in a) == list(range(1, len(keys_) + 1))


@PROFILE
@given(st.lists(row, max_size=20), st.lists(row, max_size=20))
def test_cdc_explains_the_difference(spark, old_rows, new_rows):
    old = bronze.dedup_by_key(spark.createDataFrame(old_rows, SCHEMA))
    new = spark.createDataFrame(new_rows, SCHEMA)
    ev = {r["row_id"]: r["operation"] for r in cdc.classify(old, new).collect()}
    o = {r[0]: tuple(r) for r in old.collect()}
    n = {r[0]: tuple(r) for r in bronze.dedup_by_key(new).collect()}
    assert {k for k, v in ev.items() if v == "INSERT"} == n.keys() - o.keys()
    assert {k for k, v in ev.items() if v == "DELETE"} == o.keys() - n.keys()
    assert {k for k, v in ev.items() if v == "UPDATE"} == {k for k in o.keys() & n.keys() if o[k] != n[k]}
    assert rows(bronze.apply_load(old, new, "append")) == sorted(
        list({**o, **n}.values()), key=lambda t: tuple((x is None, str(x)) for x in t))
