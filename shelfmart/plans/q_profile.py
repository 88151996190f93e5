"""Catalogue entries for the exploratory profile of the landed extract."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfmart.config import SOURCE_COLUMNS, SOURCE_KEY
from shelfmart.functions.columns import col
from shelfmart.operators import eda
from shelfmart.plans.catalog import query
from shelfmart.plans.oracle import CTES, build
from shelfmart.plans.warehouse import Warehouse

NUMERIC = ["Sales", "Quantity", "Discount", "Profit"]
_TYPES = {"Row ID": ("BIGINT", "bigint"), "Sales": ("DOUBLE", "double"), "Quantity": ("INTEGER", "int"),
          "Discount": ("DOUBLE", "double"), "Profit": ("DOUBLE", "double")}
B = eda.HISTOGRAM_BINS
D = eda.STAT_DIGITS


def _q(c: str) -> str:
    return '"' + c + '"'


CTES.update({
    "pf": (["src"], "SELECT " + ", ".join(
        f"CAST({_q(c)} AS {_TYPES[c][0]}) AS {_q(c)}" if c in _TYPES else _q(c) for c in SOURCE_COLUMNS)
        + " FROM src"),
    "nl": (["pf"], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({_q(c)} AS DOUBLE) AS value FROM pf" for c in NUMERIC)),
    "nlk": (["pf"], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, \"Row ID\" AS row_key, CAST({_q(c)} AS DOUBLE) AS value FROM pf"
        for c in NUMERIC)),
    "rng": (["nl"], f"""
      SELECT column_name, min(value) AS lo, max(value) AS hi, count(value) AS n, stddev_samp(value) AS std,
             (max(value) - min(value)) / {B} AS width FROM nl GROUP BY column_name"""),
    "hist": (["nl", "rng"], f"""
      SELECT column_name, bin, count(*) AS cnt FROM (
        SELECT n.column_name, CASE WHEN r.width = 0 THEN 1
                                   ELSE least(CAST(floor((n.value - r.lo) / r.width) AS INTEGER) + 1, {B}) END AS bin
        FROM nl n JOIN rng r USING (column_name) WHERE n.value IS NOT NULL) GROUP BY column_name, bin"""),
    "fz": (["nl"], """
      SELECT column_name, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
             q3 + 1.5 * (q3 - q1) AS upper_fence FROM (
        SELECT column_name, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
               quantile_cont(value, 0.75) AS q3 FROM nl WHERE value IS NOT NULL GROUP BY column_name)"""),
})


def _frame(w: Warehouse) -> DataFrame:
    return eda.profile_frame(w.extract)


_COLS_SQL = " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, "
    f"'{_TYPES[c][1] if c in _TYPES else 'string'}' AS data_type, count({_q(c)}) AS non_null, "
    f"count(*) AS total_rows FROM pf" for i, c in enumerate(SOURCE_COLUMNS))


@query("eda_columns", build(_COLS_SQL, "pf"))
def eda_columns(w: Warehouse) -> DataFrame:
    """Shape, types and non-null counts."""
    return eda.columns_overview(_frame(w))


_MISSING_SQL = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({_q(c)}) AS missing_count, "
    f"round((count(*) - count({_q(c)})) * 100.0 / count(*), 2) AS missing_pct FROM pf"
    for c in SOURCE_COLUMNS) + ") WHERE missing_count > 0"


@query("eda_missing", build(_MISSING_SQL, "pf"))
def eda_missing(w: Warehouse) -> DataFrame:
    """Columns with missing values, count and percentage."""
    return eda.missing_values(_frame(w))


@query("eda_duplicates", build("""
    SELECT t.n AS total_rows, d.n AS distinct_rows, t.n - d.n AS duplicate_rows
    FROM (SELECT count(*) AS n FROM pf) t, (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM pf)) d""", "pf"))
def eda_duplicates(w: Warehouse) -> DataFrame:
    """Identical rows beyond the first."""
    # The key's text, rendered from a number, is the same wherever rows are; as the extract lies in
    # buckets of it, identical rows are compared where they lie.
    keyed = eda.profile_frame(w.extract.select("*", col(SOURCE_KEY).alias("_key")))
    return w._layer("report/duplicates", lambda: eda.exact_duplicates(keyed))


@query("eda_describe", build(f"""
    SELECT column_name, count(value) AS count, round(avg(value), {D}) AS mean, round(stddev_samp(value), {D}) AS std,
           round(min(value), {D}) AS min, round(quantile_cont(value, 0.25), {D}) AS p25,
           round(quantile_cont(value, 0.5), {D}) AS p50, round(quantile_cont(value, 0.75), {D}) AS p75,
           round(max(value), {D}) AS max
    FROM nl GROUP BY column_name""", "nl"))
def eda_describe(w: Warehouse) -> DataFrame:
    """E4 + E5: describe the numeric, non-identifier columns."""
    return eda.describe(eda.numeric_long(_frame(w)), w.quartiles)


@query("eda_histogram", build(f"""
    SELECT h.column_name, h.bin, round(r.lo + (h.bin - 1) * r.width, {D}) AS bin_lo,
           round(r.lo + h.bin * r.width, {D}) AS bin_hi, h.cnt AS "count"
    FROM hist h JOIN rng r USING (column_name)""", "hist", "rng"))
def eda_histogram(w: Warehouse) -> DataFrame:
    """40 equal-width bins per numeric column."""
    return eda.histogram(eda.numeric_long(_frame(w)))


@query("eda_boxplot", build(f"""
    SELECT f.column_name, round(q1, {D}) AS q1, round(median, {D}) AS median, round(q3, {D}) AS q3,
           round(iqr, {D}) AS iqr, round(lower_fence, {D}) AS lower_fence, round(upper_fence, {D}) AS upper_fence,
           round(min(CASE WHEN value BETWEEN lower_fence AND upper_fence THEN value END), {D}) AS whisker_low,
           round(max(CASE WHEN value BETWEEN lower_fence AND upper_fence THEN value END), {D}) AS whisker_high,
           count(*) FILTER (WHERE NOT (value BETWEEN lower_fence AND upper_fence)) AS outliers
    FROM nl n JOIN fz f USING (column_name) WHERE n.value IS NOT NULL
    GROUP BY f.column_name, q1, median, q3, iqr, lower_fence, upper_fence""", "nl", "fz"))
def eda_boxplot(w: Warehouse) -> DataFrame:
    """Box-plot statistics."""
    return eda.boxplot(eda.numeric_long(_frame(w)), w.quartiles)


@query("eda_outliers", build("""
    SELECT n.column_name, n.row_key, n.value FROM nlk n JOIN fz f USING (column_name)
    WHERE n.value < f.lower_fence OR n.value > f.upper_fence""", "nlk", "fz"))
def eda_outliers(w: Warehouse) -> DataFrame:
    """The rows behind the box-plot outliers."""
    return eda.outlier_rows(_frame(w), "Row ID", NUMERIC, w.quartiles)


_VC_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_q(c)} AS value, count(*) AS \"count\" FROM pf "
    f"WHERE {_q(c)} IS NOT NULL GROUP BY {_q(c)}" for c in eda.CATEGORICAL_COLUMNS)


@query("eda_value_counts", build(_VC_SQL, "pf"))
def eda_value_counts(w: Warehouse) -> DataFrame:
    """Value frequencies of the categorical columns."""
    return eda.value_counts(_frame(w))


@query("eda_density", build(f"""
    WITH g AS (SELECT column_name, b AS bin, lo + (b - 0.5) * width AS c_j, width, n,
                      std * pow(n, -0.2) AS bw FROM rng, range(1, {B + 1}) t(b)),
         s AS (SELECT h.column_name, h.cnt, r.lo + (h.bin - 0.5) * r.width AS c_i
               FROM hist h JOIN rng r USING (column_name))
    SELECT g.column_name, g.bin,
           round(sum(s.cnt * exp(-0.5 * ((g.c_j - s.c_i) / g.bw) * ((g.c_j - s.c_i) / g.bw)))
                 * g.width / (g.n * g.bw * sqrt(2 * pi())), {eda.DENSITY_DIGITS}) AS kde_mass
    FROM g JOIN s USING (column_name) WHERE g.bw > 0
    GROUP BY g.column_name, g.bin, g.width, g.n, g.bw""", "hist", "rng"))
def eda_density(w: Warehouse) -> DataFrame:
    """Binned Gaussian density on the histogram grid."""
    return eda.density(eda.numeric_long(_frame(w)))

