import numpy as np
from pyspark.sql import functions as F

from shelfmart.operators import eda


def _long(spark, values, name="x"):
    return spark.createDataFrame([(name, float(v) if v is not None else None) for v in values],
                                 "column_name string, value double")


def test_quantiles_match_linear_interpolation_both_methods(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.integers(0, 50, 997)) + [None]
    lg = _long(spark, vals).union(_long(spark, [5, 1, 3, 3], "y"))
    for method in ("ranked", "sketch"):
        q = {(r["column_name"], r["p"]): r["q"] for r in eda.quantiles(lg, [0.25, 0.5, 0.75], method).collect()}
        xs = np.array([v for v in vals if v is not None], dtype=float)
        for p in (0.25, 0.5, 0.75):
            assert abs(q[("x", p)] - np.percentile(xs, p * 100)) < 1e-9
            assert abs(q[("y", p)] - np.percentile([5, 1, 3, 3], p * 100)) < 1e-9


def test_histogram_last_bin_closed_and_constant_column(spark):
    lg = _long(spark, [0, 1, 2, 3, 4, 40]).union(_long(spark, [7, 7], "c"))
    h = {(r["column_name"], r["bin"]): r["count"] for r in eda.histogram(lg).collect()}
    assert h[("x", 40)] == 1 and h[("x", 1)] == 1 and sum(v for (c, _), v in h.items() if c == "x") == 6
    assert h[("c", 1)] == 2


def test_boxplot_outliers_and_density(spark):
    lg = _long(spark, list(range(1, 21)) + [100])
    b = eda.boxplot(lg).first()
    assert b["outliers"] == 1 and b["whisker_high"] == 20.0
    got = {r["bin"]: r["kde_mass"] for r in eda.density(lg).collect()}
    xs = np.array(list(range(1, 21)) + [100], dtype=float)
    lo, width = xs.min(), (xs.max() - xs.min()) / 40
    bins = np.minimum(np.floor((xs - lo) / width).astype(int) + 1, 40)
    centres = lo + (np.arange(1, 41) - 0.5) * width
    counts = np.bincount(bins, minlength=41)[1:]
    bw = xs.std(ddof=1) * len(xs) ** -0.2
    dens = [(counts * np.exp(-0.5 * ((c - centres) / bw) ** 2)).sum() * width / (len(xs) * bw * np.sqrt(2 * np.pi))
            for c in centres]
    assert len(got) == 40
    assert all(abs(got[j + 1] - dens[j]) < 1e-8 for j in range(40))


def test_missing_duplicates_value_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "z")], "`Segment` string, `Region` string")
    m = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in eda.missing_values(df).collect()}
    assert m == {"Region": (2, 66.67)}
    assert eda.exact_duplicates(df).first()["duplicate_rows"] == 1
    vc = [(r["column_name"], r["value"], r["count"]) for r in eda.value_counts(df, ["Segment", "Region"]).collect()]
    assert vc == [("Region", "z", 1), ("Segment", "a", 2), ("Segment", "b", 1)]
    ov = eda.columns_overview(df.withColumn("n", F.lit(1)))
    assert [r["non_null"] for r in ov.orderBy("position").collect()] == [3, 1, 3]


def test_sketch_quantiles_exact_with_small_accuracy_and_fallback(spark):
    rng = np.random.default_rng(11)
    xs = np.round(rng.lognormal(3, 1.5, 5000), 2)
    lg = _long(spark, list(xs)).union(_long(spark, [1] * 300 + [2] * 3 + [9], "t"))
    for k, bracket in ((8, 0.2), (200, 0.02), (16_000, 0.001), (8, 0.0001)):    # the last misses its ranks
        q = {(r["column_name"], r["p"]): r["q"] for r in eda.quantiles(lg, [0.0, 0.25, 0.5, 0.75, 1.0],
                                                                          sketch_k=k, bracket=bracket).collect()}
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert abs(q[("x", p)] - np.percentile(xs, p * 100)) < 1e-9
            assert abs(q[("t", p)] - np.percentile([1] * 300 + [2] * 3 + [9], p * 100)) < 1e-9
