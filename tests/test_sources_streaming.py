import pytest
from pyspark.sql import functions as F

from shelfmart.config import SOURCE_COLUMNS
from shelfmart.errors import ContractError
from shelfmart.operators import bronze
from shelfmart.sources import files, fixture, store
from shelfmart.streaming.ingest import ingest_microbatch, stage_files

from conftest import SF_SMALL


def test_csv_round_trip_and_contract(spark, tmp):
    ex = fixture.source_extract(spark, SF_SMALL)
    files.write_extract_csv(ex, f"{tmp}/x")
    back = files.read_extract_csv(spark, f"{tmp}/x")
    assert back.columns == SOURCE_COLUMNS
    assert back.exceptAll(ex).count() == 0 and ex.exceptAll(back).count() == 0
    files.write_extract_csv(ex.drop("Profit"), f"{tmp}/y")
    with pytest.raises(ContractError, match="Profit"):
        files.read_extract_csv(spark, f"{tmp}/y")


def test_fingerprint_guard(spark, tmp):
    ex = fixture.source_extract(spark, SF_SMALL)
    files.write_extract_csv(ex, f"{tmp}/x")
    df, fp = files.guarded_read(spark, f"{tmp}/x", f"{tmp}/stage", deep=True)
    assert df.count() == ex.count()
    import hashlib, glob
    f = sorted(glob.glob(f"{tmp}/x/*.csv"))[0]
    want = hashlib.sha256(open(f, "rb").read()).hexdigest()
    assert want in {r["sha256"] for r in fp.collect()}


def test_fingerprint_guard_detects_change(spark, tmp, monkeypatch):
    from shelfmart.errors import SourceChangedError
    ex = fixture.source_extract(spark, SF_SMALL)
    real = files.read_extract_csv
    for mode in ("grow", "replace"):
        files.write_extract_csv(ex, f"{tmp}/{mode}")

        def read_then_change(sp, path, columns=None, mode=mode):   # the source changes while it is read
            df = real(sp, path, columns)
            import glob
            if mode == "grow":
                with open(sorted(glob.glob(f"{path}/*.csv"))[0], "a") as f:
                    f.write("\n")
            else:
                files.write_extract_csv(ex.limit(5), path)
            return df
        monkeypatch.setattr(files, "read_extract_csv", read_then_change)
        with pytest.raises(SourceChangedError):
            files.guarded_read(spark, f"{tmp}/{mode}", f"{tmp}/stage_{mode}")
        monkeypatch.setattr(files, "read_extract_csv", real)


def test_versioned_publish_never_overwrites_what_is_read(spark, tmp):
    t = f"{tmp}/t"
    store.publish(spark.range(3), t)
    cur = store.read_current(spark, t)
    store.publish(cur.withColumn("id", F.col("id") + 10), t)       # reads v=1, writes v=2
    assert sorted(r[0] for r in store.read_current(spark, t).collect()) == [10, 11, 12]
    assert store.current_version(spark, t) == 2


def test_microbatch_ingest_equals_dedup(spark, tmp):
    ex = fixture.source_extract(spark, SF_SMALL)
    stage_files(ex, f"{tmp}/in", n_files=6)
    assert ingest_microbatch(spark, f"{tmp}/in", f"{tmp}/bronze", f"{tmp}/ckpt", max_files_per_trigger=2) == 2
    assert store.current_version(spark, f"{tmp}/bronze") == 1            # three batches, written once
    got = store.read_current(spark, f"{tmp}/bronze")
    want = bronze.dedup_by_key(ex)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a restarted query with the same checkpoint finds nothing new
    assert ingest_microbatch(spark, f"{tmp}/in", f"{tmp}/bronze", f"{tmp}/ckpt") == 2
    assert store.current_version(spark, f"{tmp}/bronze") == 1


def test_microbatch_survivor_does_not_depend_on_the_batch(spark, tmp):
    from shelfmart.streaming.ingest import merge_landed
    ex = fixture.source_extract(spark, SF_SMALL).limit(1)
    row = lambda q: ex.withColumn("Quantity", F.lit(q))
    for k, q in enumerate(("9", "5")):                     # one key, a batch each, the smaller row last
        row(q).write.parquet(f"{tmp}/t/_landing/batch={k}")
    assert merge_landed(spark, f"{tmp}/t") == 1
    want = bronze.dedup_by_key(row("9").union(row("5"))).collect()
    assert store.read_current(spark, f"{tmp}/t").collect() == want
    row("1").write.parquet(f"{tmp}/t/_landing/batch=2")    # a later drain replaces what is stored
    assert merge_landed(spark, f"{tmp}/t") == 2 and merge_landed(spark, f"{tmp}/t") == 2
    assert [r["Quantity"] for r in store.read_current(spark, f"{tmp}/t").collect()] == ["1"]


def test_polling_publishes_while_it_runs(spark, tmp):
    from shelfmart.streaming.ingest import poll
    ex = fixture.source_extract(spark, SF_SMALL).limit(300).cache()
    key = F.col("`Row ID`").cast("long")
    row = lambda parity: bronze.dedup_by_key(ex.filter(key % 2 == parity))
    stage_files(ex.filter(key % 2 == 0), f"{tmp}/in", n_files=1)
    query = poll(spark, f"{tmp}/in", f"{tmp}/bronze", f"{tmp}/ckpt", "0 seconds")
    try:
        query.processAllAvailable()
        assert store.read_current(spark, f"{tmp}/bronze").exceptAll(row(0)).isEmpty()
        ex.filter(key % 2 == 1).coalesce(1).write.mode("append").options(**files._CSV_OPTS).csv(f"{tmp}/in")
        query.processAllAvailable()
        assert query.isActive                               # current while the query runs
        got, want = store.read_current(spark, f"{tmp}/bronze"), bronze.dedup_by_key(ex)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        query.stop()
    assert store.partitions(spark, f"{tmp}/bronze/_landing", "batch") == []
    assert store.retire(spark, f"{tmp}/bronze", keep=0) == [1] and store.read_current(spark, f"{tmp}/bronze").count() == want.count()


def test_retired_versions_are_those_nobody_reads(spark, tmp):
    df = spark.createDataFrame([(y, y) for y in (1, 2, 3)], "y int, n int")
    t, now = f"{tmp}/wh/gold/t", None
    for k in range(5):                                       # year 1 stays in version 1
        now = store.stage_parts(df.filter("y <> 1") if k else df, t, "y", now, ["2", "3"] if k else None)
        store.publish_all(spark, f"{tmp}/wh", f"run{k}", {"gold/t": now})
    assert now["parts"] == {"1": 1, "2": 5, "3": 5}
    assert store.retire(spark, t, keep=1) == [2]             # 4 is what a repeat of run4 starts from, 3 is kept
    assert store.read_current(spark, t).count() == 3


def test_checkpoint_folder_is_required_off_local_masters(spark):
    from types import SimpleNamespace

    from shelfmart.session import ensure_checkpoint_dir
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        sc = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        bare = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(bare)


def test_source_fingerprint_query_matches_the_files(spark):
    import glob
    import hashlib
    import os

    from shelfmart.plans import catalog
    from shelfmart.plans.warehouse import shared
    got = sorted(tuple(r) for r in catalog.QUERIES["source_fingerprint"](spark, SF_SMALL).select("length", "sha256").collect())
    folder = shared(spark, SF_SMALL).store.removeprefix("file:") + "/landing/extract_csv"
    names = [f for f in glob.glob(f"{folder}/*") if not os.path.basename(f).startswith(("_", "."))]
    assert got == sorted((os.path.getsize(f), hashlib.sha256(open(f, "rb").read()).hexdigest()) for f in names)


def test_files_are_bounded_and_hashed_without_their_content(spark, tmp, monkeypatch):
    import glob
    import hashlib
    import os

    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    ex = fixture.source_extract(spark, SF_SMALL).limit(450).coalesce(1)
    files.write_extract_csv(ex, f"{tmp}/a b=%41", "gzip")
    names = glob.glob(f"{tmp}/a b=%41/part-*")
    assert len(names) == 5
    found = store.content_fingerprint(spark, f"{tmp}/a b=%41")
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["sha256"] for r in found.collect()) == sorted(hashlib.sha256(open(f, "rb").read()).hexdigest() for f in names)
    assert sum(r["length"] for r in found.collect()) == sum(os.path.getsize(f) for f in names)
    assert files.read_extract_csv(spark, f"{tmp}/a b=%41").count() == 450
