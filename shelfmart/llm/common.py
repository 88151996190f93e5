"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmart.session import ensure_checkpoint_dir
from shelfmart.sources import store


T = TypeVar("T")
_HELD: dict[str, object] = {}


def hand_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task, and what the C
    library and Arrow's pool keep for it counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass                                       # another C library


def worker_cache(name: str, make: Callable[[], T]) -> T:
    """A table of words that a Python worker keeps between tasks. Only one is held at a time:
    a worker outlives the stages of a job, and each stage needs its own."""
    if name not in _HELD:
        _HELD.clear()
        hand_back()
        _HELD[name] = make()
    return _HELD[name]


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, no_id, text): pandas holds a long column with nulls as floating point, which
    would change large ids, so a null id travels as 0 with a mark."""
    i = F.col(id_col).cast("long")
    return docs.select(F.coalesce(i, F.lit(0)).alias("doc_id"), i.isNull().alias("no_id"),
                       F.col(text_col).cast("string").alias("text"))


def null_ids(df: DataFrame) -> DataFrame:
    """Undo the mark of ``id_and_text``."""
    return df.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


class Stored:
    """An intermediate table in the shared folder, removed when its reader is done with it.

    Parquet rather than ``checkpoint()`` where a wide or long table is read more than once:
    it is a fraction of the size and lets the reader prune columns."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        base = self.spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(self.spark)
        self.path = f"{base.rstrip('/')}/shelfmart-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        store.delete(self.spark, self.path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
