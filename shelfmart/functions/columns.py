"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmart.config import SOURCE_DATE_FORMAT


def col(name: str) -> Column:
    """Column by (possibly spaced / hyphenated) name."""
    return F.col(f"`{name}`")


def parse_source_date(c: Column) -> Column:
    """``M/d/yyyy`` text -> date; accepts one- and two-digit month/day."""
    return F.to_date(c, SOURCE_DATE_FORMAT)


def render_source_date(c: Column) -> Column:
    """date -> ``M/d/yyyy`` text (the extract's rendering)."""
    return F.date_format(c, SOURCE_DATE_FORMAT)


def round2(c: Column) -> Column:
    """Round an exact decimal half away from zero to cents, then expose as double."""
    return F.round(c, 2).cast("double")


def avg2(total: Column, n: Column) -> Column:
    """Average of an exact sum, rounded to cents."""
    return F.round(total.cast("double") / n, 2)


def rows_differ(left: Iterable[Column], right: Iterable[Column]) -> Column:
    """Null-safe row inequality (IS DISTINCT FROM on tuples), fields matched by position."""
    def tup(cols):
        return F.struct(*[c.alias(f"_{i}") for i, c in enumerate(cols)])
    return ~tup(left).eqNullSafe(tup(right))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Presentation step: expose exact decimals as doubles."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Place several one-row aggregates next to each other without a join: the rows are
    unioned by name (missing columns null) and folded by ``max``, which keeps each
    side's value (a NULL aggregate stays NULL)."""
    names = [c for r in rows for c in r.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names must be distinct across sides: {names}")
    u = rows[0]
    for r in rows[1:]:
        u = u.unionByName(r, allowMissingColumns=True)
    return u.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in names])


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")
