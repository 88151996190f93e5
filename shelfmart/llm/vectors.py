"""Vector tables: which rows take part, and classes of identical vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vec: Column) -> Column:
    """True for vectors with at least one component, all of them finite and not all zero."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & good & F.exists(vec, lambda x: x != 0), F.lit(False))


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): one row per non-null id with a usable vector.

    Of several usable vectors under one id the smallest counts. Components keep 32 bits if
    the column holds floats and have 64 bits otherwise."""
    kind = df.schema[vec_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vec = F.col(vec_col).cast("array<float>" if single else "array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & usable(F.col("vec")))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def vector_classes(rows: DataFrame, members: int) -> DataFrame:
    """(rep, vec, ids): every distinct vector with its smallest ids, ``members`` at most.

    The ranking keeps the first ids per vector before the shuffle, so a vector that a third
    of all rows share costs a few rows per map task."""
    order = Window.partitionBy("vec").orderBy("vec_id")
    first = rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= members)
    return first.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("rep"), "vec", "ids")
