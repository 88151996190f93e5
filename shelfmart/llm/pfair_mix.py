"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations.

Every source is a task whose blocks are its unit jobs: with weight w (its share of the
slots) block j is released at slot floor(j / w) and due before slot ceil((j + 1) / w).
Earliest deadline first meets all deadlines on one processor, so after every slot each
source has received its share to within less than one block. With integer weights the
schedule repeats after as many slots as the weights sum to; one such cycle is planned on
the driver (its size depends on the weights alone) and every block's slot follows by
arithmetic. When a source ends, the remaining ones start a new cycle with the same
weights among themselves, so a plan has one phase per source.

Rows get their rank within the source from range-partitioned counts, so a source with a
third of all rows is spread like the others. Nothing is repeated or dropped: every row
appears once.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import unused
from shelfmart.operators.keys import cumulative_count

MAX_SOURCES = 1000
MAX_CYCLE = 10_000
_NULL_KEY = "n"


def edf_cycle(weights: list[int]) -> list[int]:
    """Owner of each of the sum(weights) slots of one cycle; ties go to the earlier task."""
    total = sum(weights)
    waiting = [(0, i, 0) for i in range(len(weights))]        # (release, task, job)
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []                    # (deadline, task, job)
    owners = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[i]), i, j))
        _, i, j = heapq.heappop(ready)
        owners.append(i)
        if j + 1 < weights[i]:
            heapq.heappush(waiting, ((j + 1) * total // weights[i], i, j + 1))
    return owners


@dataclass(frozen=True)
class PlanRow:
    """Where a source's blocks from ``first_block`` to before ``end_block`` go."""
    source_key: str
    first_block: int
    end_block: int
    first_slot: int
    cycle: int
    share: int
    slots: list[int]
    short: int            # rows that partial blocks before this phase lack


def plan(rows: Mapping[str, int], weights: Mapping[str, int], block_rows: int) -> list[PlanRow]:
    """Phases of the schedule. ``rows``: rows per source key; tasks are ordered by (-weight, key)."""
    left = {k: -(-n // block_rows) for k, n in rows.items() if n > 0}
    done = dict.fromkeys(left, 0)
    out, slot, short = [], 0, 0
    while left:
        keys = sorted(left, key=lambda k: (-weights[k], k))
        owners = edf_cycle([weights[k] for k in keys])
        cycle = len(owners)
        at: list[list[int]] = [[] for _ in keys]
        for s, i in enumerate(owners):
            at[i].append(s)
        ends = [((left[k] - 1) // weights[k]) * cycle + at[i][(left[k] - 1) % weights[k]] + 1
                for i, k in enumerate(keys)]
        length = min(ends)
        for i, k in enumerate(keys):
            n = (length // cycle) * weights[k] + sum(s < length % cycle for s in at[i])
            if n:
                out.append(PlanRow(k, done[k], done[k] + n, slot, cycle, weights[k], at[i], short))
            done[k] += n
            left[k] -= n
        over = keys[ends.index(length)]                        # one block a slot, so one source ends
        short += done[over] * block_rows - rows[over]
        del left[over]
        slot += length
    return out


def mix(docs: DataFrame, weights: Mapping[str, int] | None = None, default_weight: int = 1,
        block_rows: int = 16, source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, source, block, slot, position), one row per row of ``docs``.

    ``position`` numbers the mixed order from 0 without gaps; ``slot`` is the place of the
    row's block of ``block_rows`` rows, ``block`` that block's number within its source.
    Rows of a source keep the order of their ids (null ids last, equal ids in any order,
    each with its own position). Weights are positive integers; a source without one has
    ``default_weight``, and null is a source of its own. After every slot of a phase each
    source has received its share of the phase's slots to within less than one block; a
    phase ends with the last block of a source (which may be short).

    More than MAX_SOURCES sources or weights that sum to more than MAX_CYCLE are refused
    with a ValueError, so that the plan, which is broadcast, stays bounded whatever the
    number of rows. An empty table gives none.
    """
    weights = dict(weights or {})
    if block_rows < 1 or any(int(w) != w or w < 1 for w in [default_weight, *weights.values()]):
        raise ValueError("weights and block_rows must be positive integers")
    spark = docs.sparkSession
    source = F.col(source_col).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), source.alias("source"),
                         F.coalesce(F.concat(F.lit("s"), source), F.lit(_NULL_KEY)).alias("source_key"),
                         F.lit(1).alias("one"))
    counts = (narrow.groupBy("source_key").agg(F.count(F.lit(1)).alias("n"))
                    .limit(MAX_SOURCES + 1).collect())         # bounded: refused beyond
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = {r["source_key"]: r["n"] for r in counts}
    share = {k: int(weights.get(k[1:], default_weight)) if k != _NULL_KEY else default_weight for k in rows}
    if sum(share.values()) > MAX_CYCLE:
        raise ValueError(f"weights sum to more than {MAX_CYCLE}")
    planned = spark.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps([vars(p) for p in plan(rows, share, block_rows)])),
        "array<struct<source_key string, first_block long, end_block long, first_slot long, cycle long, "
        "share long, slots array<long>, short long>>")).alias("p")).select("p.*")
    ranked = cumulative_count(narrow, "source_key", ["doc_id"], "one", "rank").withColumn(
        "block", F.expr(f"rank div {block_rows}"))
    placed = ranked.join(F.broadcast(planned), "source_key").filter("first_block <= block and block < end_block")
    nth = F.col("block") - F.col("first_block")
    slot = (F.col("first_slot") + F.floor(nth / F.col("share")) * F.col("cycle")
            + F.get("slots", (nth % F.col("share")).cast("int")))
    return placed.withColumn("slot", slot.cast("long")).select(
        "doc_id", "source", "block", "slot",
        (F.col("slot") * block_rows - F.col("short") + F.col("rank") % block_rows).alias("position"))


def mixed_documents(docs: DataFrame, weights: Mapping[str, int] | None = None, default_weight: int = 1,
                    block_rows: int = 16, source_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``docs`` itself in the mixed order: its files and rows follow the positions.

    Rows with one id and source take the first position among them.
    """
    doc, source, place = unused(docs, "_doc", "_source", "_position")
    order = mix(docs, weights, default_weight, block_rows, source_col, id_col).groupBy("doc_id", "source").agg(
        F.min("position").alias(place)).withColumnsRenamed({"doc_id": doc, "source": source})
    same = (F.col(id_col).cast("long").eqNullSafe(F.col(doc))
            & F.col(source_col).cast("string").eqNullSafe(F.col(source)))
    return docs.join(order, same).repartitionByRange(place).sortWithinPartitions(place).select(*docs.columns)
