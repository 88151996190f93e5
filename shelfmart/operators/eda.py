"""Exploratory profile of the raw extract: shape, missing values, duplicates,
describe, histograms, box plots, outliers, value counts and a binned density.

Every statistic is an aggregate over all rows. The numeric columns are unpivoted into
one long (column_name, value) frame so each statistic is one grouped pass instead of
one job per column. Exact quantiles bracket each target rank with a quantile sketch and
rank only the values inside the bracket (two scans); the fallback ranks every distinct
value with a weighted cumulative count (``keys.cumulative_count``), range-partitioned for
large inputs, never collecting a column's values in one task; fences, bins and densities only ever join small per-column tables.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmart.functions.columns import col, count_if, side_by_side
from shelfmart.operators.keys import cumulative_count
from shelfmart.session import ensure_checkpoint_dir

# ---- FIXED VALUES ------------------------------------------------------------------
# Columns excluded from the numeric profile although numeric (identifiers).
ID_COLUMNS = ["Row ID", "Postal Code"]
# Categorical columns whose value counts are reported.
CATEGORICAL_COLUMNS = ["Ship Mode", "Segment", "Country", "Region", "Category", "Sub-Category"]
HISTOGRAM_BINS = 40
IQR_FACTOR = 1.5
QUARTILES = [0.25, 0.5, 0.75]
# ---- end FIXED VALUES ---------------------------------------------------------------

STAT_DIGITS = 6   # presentation rounding of floating statistics
DENSITY_DIGITS = 9

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def profile_frame(extract: DataFrame) -> DataFrame:
    """The extract with measures typed as a loader would infer them."""
    casts = {"Row ID": "bigint", "Sales": "double", "Quantity": "int", "Discount": "double", "Profit": "double"}
    return extract.select(*[col(c).cast(casts[c]).alias(c) if c in casts else col(c) for c in extract.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns minus identifier columns."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ID_COLUMNS]


def columns_overview(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of every column (one pass)."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(col(c)).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    meta = df.sparkSession.createDataFrame(
        [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, data_type string")
    long = counts.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.col(f"_c{i}").alias("non_null"))
        for i in range(len(df.columns))])).alias("_p")).select("_rows", "_p.*")
    return meta.join(F.broadcast(long), "position").select(
        "position", "column_name", "data_type", "non_null", F.col("_rows").alias("total_rows"))


def missing_values(df: DataFrame) -> DataFrame:
    """Null count and percentage (2 dp) for columns that have nulls."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[count_if(col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    long = agg.select("_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)])).alias("_p")).select("_rows", "_p.*")
    return (long.filter(F.col("missing_count") > 0)
                .select("column_name", "missing_count",
                        F.round(F.col("missing_count") * 100.0 / F.col("_rows"), 2).alias("missing_pct")))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows (NULLs compare equal)."""
    total = df.agg(F.count(F.lit(1)).alias("total_rows"))
    distinct = df.distinct().agg(F.count(F.lit(1)).alias("distinct_rows"))
    return side_by_side(total, distinct).withColumn(
        "duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))


def numeric_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = columns or numeric_columns(df)
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), col(c).cast("double").alias("value")) for c in cols
    ])).alias("_p")).select("_p.*")


SKETCH_K = 16_000           # KLL size: a rank is off by about 2.3 / k^0.9 of n, 0.04 %
BRACKET = 0.001             # bracket half-width, as a share of n
SKETCH_SALT = 16            # sketches per column before the merge


def _targets(n: DataFrame, probs: list[float]) -> DataFrame:
    """(column_name, n, p, lo, hi, frac): the ranks floor/ceil of p*(n-1) per column."""
    return (n.select("column_name", "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
             .withColumn("_pos", F.col("p") * (F.col("n") - 1))
             .withColumn("lo", F.floor("_pos").cast("long")).withColumn("hi", F.ceil("_pos").cast("long"))
             .withColumn("frac", F.col("_pos") - F.col("lo")).drop("_pos"))


def _interpolate(tg: DataFrame, hits: DataFrame, keys: list[str]) -> DataFrame:
    """Join the values found at ranks lo and hi and interpolate linearly."""
    lo = hits.select(*keys, F.col("r").alias("lo"), F.col("value").alias("_vlo"))
    hi = hits.select(*keys, F.col("r").alias("hi"), F.col("value").alias("_vhi"))
    q = (tg.join(lo, [*keys, "lo"], "left").join(hi, [*keys, "hi"], "left")
           .withColumn("q", F.when(F.col("lo") == F.col("hi"), F.col("_vlo"))
                       .otherwise(F.col("_vlo") * (1.0 - F.col("frac")) + F.col("_vhi") * F.col("frac"))))
    return q


def quantiles(long: DataFrame, probs: list[float], method: str = "sketch",
              sketch_k: int = SKETCH_K, bracket: float = BRACKET) -> DataFrame:
    """Exact quantiles with linear interpolation: (column_name, p, q).

    ``sketch`` (default): two scans whatever the cardinality. KLL sketches per (column,
    salt), merged per column and stored, bracket every target rank; a second pass counts
    the rows below each bracket and reduces the bracket band to (value, count); ranks inside
    the small band are exact. A bracket that misses its rank falls back to ``ranked``, which
    gives the same result.
    ``ranked``: rank all distinct values (see ``_ranked``).
    """
    if method != "sketch":
        return _ranked(long, probs)
    spark = long.sparkSession
    ensure_checkpoint_dir(spark)
    v = long.filter(F.col("value").isNotNull())
    delta = bracket
    edges = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-delta, delta)})
    sketches = v.withColumn("_s", F.spark_partition_id() % SKETCH_SALT).groupBy("column_name", "_s").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(sketch_k)).alias("_k"))
    sk = (sketches.groupBy("column_name").agg(F.sum("n").alias("n"),
                                              F.kll_merge_agg_double("_k", F.lit(sketch_k)).alias("_k"))
          .select("column_name", "n", F.kll_sketch_get_quantile_double(
              "_k", F.array(*[F.lit(e) for e in edges])).alias("_e"))
          .checkpoint(eager=True))                             # one row per column
    at = {e: i for i, e in enumerate(edges)}
    tg = _targets(sk.select("column_name", "n"), probs).join(
        sk.select("column_name", F.explode(F.array(*[
            F.struct(F.lit(float(p)).alias("p"), F.col("_e")[at[min(1.0, max(0.0, p - delta))]].alias("a"),
                     F.col("_e")[at[min(1.0, max(0.0, p + delta))]].alias("b")) for p in probs])).alias("_t"))
          .select("column_name", "_t.*"), ["column_name", "p"])
    # one pass: rows below a bracket collapse to one count, rows inside it to (value, count)
    j = v.join(F.broadcast(tg.select("column_name", "p", "a", "b")), "column_name").filter(F.col("value") <= F.col("b"))
    g = j.groupBy("column_name", "p", F.when(F.col("value") >= F.col("a"), F.col("value")).alias("bv")).agg(
        F.count(F.lit(1)).alias("cnt")).checkpoint(eager=True)     # at most 2 x BRACKET x n rows per target
    below = g.filter(F.col("bv").isNull()).select("column_name", "p", F.col("cnt").alias("_below"))
    inside = g.filter(F.col("bv").isNotNull())
    ranked = cumulative_count(inside, ["column_name", "p"], ["bv"], "cnt", "_in")
    band = (ranked.join(F.broadcast(below), ["column_name", "p"], "left")
                  .withColumn("before", F.coalesce("_below", F.lit(0)) + F.col("_in")))
    ranks = tg.select("column_name", "p", F.explode(F.array("lo", "hi")).alias("r")).distinct()
    hits = (band.join(ranks, ["column_name", "p"])
                .filter((F.col("before") <= F.col("r")) & (F.col("r") < F.col("before") + F.col("cnt")))
                .select("column_name", "p", "r", F.col("bv").alias("value")))
    q = _interpolate(tg, hits, ["column_name", "p"]).select(
        "column_name", "p", "q", (F.col("_vlo").isNotNull() & F.col("_vhi").isNotNull()).alias("_ok"))
    q = q.checkpoint(eager=True)                     # columns x probabilities rows
    if not q.filter(~F.col("_ok")).isEmpty():        # a bracket missed: rank exactly instead
        return _ranked(long, probs)
    return q.select("column_name", "p", "q")


def _ranked(long: DataFrame, probs: list[float]) -> DataFrame:
    """Exact quantiles by ranking every distinct value.

    Values are first reduced to (column, value, count) by a partial aggregation, so a
    low-cardinality column costs a few rows whatever the table size. A weighted
    cumulative count gives each distinct value its rank interval [before, before+count);
    the ranks floor/ceil of p*(n-1) are then looked up with a range join against a
    broadcast table of (columns x probabilities x 2) targets.
    """
    v = long.filter(F.col("value").isNotNull())
    # every later step reads this reduction: write it once (it also cuts the lineage)
    ensure_checkpoint_dir(long.sparkSession)
    vc = v.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt")).checkpoint(eager=True)
    pos = cumulative_count(vc, "column_name", ["value"], "cnt", "before")
    tg = _targets(vc.groupBy("column_name").agg(F.sum("cnt").alias("n")), probs)
    need = tg.select(F.col("column_name").alias("_c"), F.explode(F.array("lo", "hi")).alias("r")).distinct()
    hits = pos.join(F.broadcast(need), (F.col("column_name") == F.col("_c")) & (F.col("before") <= F.col("r"))
                    & (F.col("r") < F.col("before") + F.col("cnt"))).select("column_name", "r", "value")
    return _interpolate(tg, hits, ["column_name"]).select("column_name", "p", "q")


def _pivot_quartiles(q: DataFrame) -> DataFrame:
    return q.groupBy("column_name").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))


def quartiles(long: DataFrame, method: str = "sketch") -> DataFrame:
    """(column_name, q1, median, q3): what E5, E7 and E8 share."""
    return _pivot_quartiles(quantiles(long, QUARTILES, method))


def describe(long: DataFrame, quarters: DataFrame | None = None) -> DataFrame:
    """E5: count, mean, sample std, min, quartiles, max per numeric column. ``quarters``:
    the stored result of ``quartiles``, computed here if absent."""
    base = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    qs = quartiles(long) if quarters is None else quarters
    r = lambda c: F.round(F.col(c), STAT_DIGITS).alias(c)
    return base.join(qs, "column_name", "left").select(
        "column_name", "count", r("mean"), r("std"), r("min"), F.round("q1", STAT_DIGITS).alias("p25"),
        F.round("median", STAT_DIGITS).alias("p50"), F.round("q3", STAT_DIGITS).alias("p75"), r("max"))


def _ranges(long: DataFrame, bins: int) -> DataFrame:
    return (long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                            F.count("value").alias("n"), F.stddev_samp("value").alias("std"))
                .withColumn("width", (F.col("hi") - F.col("lo")) / bins))


def _bin(value, lo, width, bins: int):
    raw = F.floor((value - lo) / width).cast("int") + 1
    return F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins)))


def histogram(long: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between min and max; the last bin is closed on the right."""
    rng = _ranges(long, bins)
    v = long.filter(F.col("value").isNotNull()).join(F.broadcast(rng.select("column_name", "lo", "width")),
                                                     "column_name")
    counts = v.groupBy("column_name", _bin(F.col("value"), F.col("lo"), F.col("width"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    return counts.join(F.broadcast(rng.select("column_name", "lo", "width")), "column_name").select(
        "column_name", "bin",
        F.round(F.col("lo") + (F.col("bin") - 1) * F.col("width"), STAT_DIGITS).alias("bin_lo"),
        F.round(F.col("lo") + F.col("bin") * F.col("width"), STAT_DIGITS).alias("bin_hi"), "count")


def fences(qs: DataFrame) -> DataFrame:
    iqr = F.col("q3") - F.col("q1")
    return qs.select("column_name", "q1", "median", "q3", iqr.alias("iqr"),
                     (F.col("q1") - IQR_FACTOR * iqr).alias("lower_fence"),
                     (F.col("q3") + IQR_FACTOR * iqr).alias("upper_fence"))


def boxplot(long: DataFrame, quarters: DataFrame | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers (extreme values inside them), outlier count."""
    fz = fences(quartiles(long) if quarters is None else quarters)
    v = long.filter(F.col("value").isNotNull()).join(F.broadcast(fz), "column_name")
    inside = (F.col("value") >= F.col("lower_fence")) & (F.col("value") <= F.col("upper_fence"))
    agg = v.groupBy("column_name").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        count_if(~inside).alias("outliers"))
    r = lambda c: F.round(F.col(c), STAT_DIGITS).alias(c)
    return fz.join(agg, "column_name").select(
        "column_name", r("q1"), r("median"), r("q3"), r("iqr"), r("lower_fence"), r("upper_fence"),
        r("whisker_low"), r("whisker_high"), "outliers")


def outlier_rows(df: DataFrame, key: str, columns: list[str] | None = None,
                 quarters: DataFrame | None = None) -> DataFrame:
    """(column_name, key, value) for every value outside its column's fences."""
    cols = columns or numeric_columns(df)
    long = df.select(col(key).alias("row_key"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), col(c).cast("double").alias("value")) for c in cols
    ])).alias("_p")).select("row_key", "_p.*")
    fz = fences(quartiles(long.select("column_name", "value")) if quarters is None else quarters)
    v = long.join(F.broadcast(fz.select("column_name", "lower_fence", "upper_fence")), "column_name")
    return v.filter((F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))).select(
        "column_name", "row_key", "value")


def value_counts(df: DataFrame, columns: list[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Frequency of every non-null value of the categorical columns, in one grouping."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), col(c).cast("string").alias("value")) for c in columns
    ])).alias("_p")).select("_p.*").filter(F.col("value").isNotNull())
    return (long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
                .orderBy("column_name", F.col("count").desc(), "value"))


def density(long: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Gaussian KDE (Scott bandwidth std * n^-1/5) evaluated on the bin centres from
    the binned counts; reported as the expected share of rows per bin. Work is bounded
    by bins x bins per column, independent of the row count."""
    rng = _ranges(long, bins)
    h = histogram(long, bins).join(F.broadcast(rng.select("column_name", "lo", "width")), "column_name")
    src = h.select("column_name", "count", (F.col("lo") + (F.col("bin") - 0.5) * F.col("width")).alias("c_i"))
    grid = rng.select("column_name", "lo", "width", "n", (F.col("std") * F.pow(F.col("n"), -0.2)).alias("bw"),
                      F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")).select(
        "column_name", "bin", (F.col("lo") + (F.col("bin") - 0.5) * F.col("width")).alias("c_j"),
        "width", "n", "bw")
    pairs = grid.join(src, "column_name")  # at most bins x bins rows per column
    z = (F.col("c_j") - F.col("c_i")) / F.col("bw")
    kern = F.col("count") * F.exp(-0.5 * z * z)
    out = pairs.filter(F.col("bw") > 0).groupBy("column_name", "bin", "width", "n", "bw").agg(F.sum(kern).alias("_k"))
    mass = F.col("_k") * F.col("width") / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
    return out.select("column_name", "bin", F.round(mass, DENSITY_DIGITS).alias("kde_mass"))
