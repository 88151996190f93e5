import hashlib

import pytest
from pyspark.sql import functions as F

from shelfmart.config import REQUIRED_SOURCE_COLUMNS, SOURCE_COLUMNS
from shelfmart.errors import ContractError
from shelfmart.operators import contract


def test_contract_accepts_required_set_and_extras():
    contract.check_columns(REQUIRED_SOURCE_COLUMNS)
    contract.check_columns(SOURCE_COLUMNS + ["Extra"])


def test_contract_rejects_missing_profit():
    with pytest.raises(ContractError, match="required column.*: Profit"):
        contract.check_columns([c for c in REQUIRED_SOURCE_COLUMNS if c != "Profit"])


def test_contract_lists_missing_sorted():
    with pytest.raises(ContractError) as e:
        contract.check_columns(["Row ID"])
    missing = str(e.value).split(": ", 1)[1].split(", ")
    assert missing == sorted(set(REQUIRED_SOURCE_COLUMNS) - {"Row ID"})


def test_schema_hash_matches_hashlib(spark):
    text = ",".join(SOURCE_COLUMNS)
    assert contract.schema_hash(SOURCE_COLUMNS) == hashlib.sha256(text.encode()).hexdigest()
    df = spark.createDataFrame([("s", text)], "source_name string, columns string")
    assert contract.with_schema_hash(df).first()["schema_hash"] == contract.schema_hash(SOURCE_COLUMNS)


def test_drift_history_versions_and_events(spark):
    a = ",".join(SOURCE_COLUMNS)
    b = ",".join(SOURCE_COLUMNS + ["Extra"])          # column added
    c = ",".join(reversed(SOURCE_COLUMNS))             # reordered
    obs = spark.createDataFrame(
        [("f.csv", a, "2024-01-01 00:00:00", "r1"), ("f.csv", a, "2024-01-02 00:00:00", "r2"),
         ("f.csv", b, "2024-01-03 00:00:00", "r3"), ("f.csv", c, "2024-01-04 00:00:00", "r4"),
         ("g.csv", a, "2024-01-01 00:00:00", "r1")],
        "source_name string, columns string, observed_at string, run_id string").withColumn(
        "observed_at", F.col("observed_at").cast("timestamp_ntz"))
    h = contract.drift_history(obs)
    ver = {(r["source_name"], str(r["observed_at"])[:10]): r["schema_version"] for r in h.collect()}
    assert ver[("f.csv", "2024-01-01")] == 1 and ver[("f.csv", "2024-01-02")] == 1
    assert ver[("f.csv", "2024-01-03")] == 2 and ver[("f.csv", "2024-01-04")] == 3
    assert ver[("g.csv", "2024-01-01")] == 1
    ev = contract.drift_events(h).collect()
    assert len(ev) == 2 and all(r["previous_hash"] != r["new_hash"] for r in ev)
    reg = {r["source_name"]: r for r in contract.registry(h).collect()}
    assert reg["f.csv"]["schema_version"] == 3 and reg["f.csv"]["columns"] == c
