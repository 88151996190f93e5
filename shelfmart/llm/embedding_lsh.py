"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised, so cosine t is distance sqrt(2 - 2 t). A table's key joins the
quantised values of several random projections; two vectors at distance c agree on one
projection with a probability that depends on c over the quantisation width alone (Datar
et al. 2004). The number of projections per key follows from the number of vectors, so
that an unrelated vector meets a fraction of another per table on average, and the number
of tables from the wanted recall at the threshold itself; closer pairs are missed less.

Identical vectors collapse to one first. Buckets of two or more are compared exactly; a
bucket beyond ``tile_rows`` is split into tiles and every pair of tiles is one bounded
group, so no task sees a whole large bucket. A pair counts in the first table that
brings it together, so nothing has to be made distinct, and a group returns sums per
vector and a spanning forest instead of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmart.llm.common import Stored
from shelfmart.llm.components import connected_components
from shelfmart.llm.vectors import valid_vectors
from shelfmart.session import ensure_checkpoint_dir

WIDTH = 2.0
MISS = 0.005
SEED = 20


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees at this distance."""
    r = width / distance
    below = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_plan(vectors: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(projections per key, tables) for this many vectors."""
    near = agreement(math.sqrt(max(2 - 2 * threshold, 1e-9)))
    far = agreement(math.sqrt(2.0))
    per_key = max(1, math.ceil(math.log(8 * max(vectors, 2)) / -math.log(far)))
    return per_key, max(1, math.ceil(math.log(miss) / math.log1p(-near ** per_key)))


def unit_rows(vecs: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision (by the largest component first)."""
    x = np.asarray(vecs, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def table_keys(unit: np.ndarray, per_key: int, tables: int) -> np.ndarray:
    """(rows, tables) keys of unit vectors of one dimension; the dimension is part of the key."""
    dim = unit.shape[1]
    rng = np.random.default_rng([SEED, dim])
    out = np.empty((len(unit), tables), np.int64)
    for t in range(tables):
        a = rng.standard_normal((dim, per_key))
        b = rng.uniform(0, WIDTH, per_key)
        q = np.floor((unit @ a + b) / WIDTH).astype(np.int64).view(np.uint64)
        h = np.full(len(unit), dim, np.uint64)
        for j in range(per_key):
            h = (h ^ q[:, j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out[:, t] = h.view(np.int64)
    return out


def _keyed(classes: DataFrame, per_key: int, tables: int) -> DataFrame:
    kind = classes.schema["vec"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            dims = b["vec"].map(len).to_numpy()
            keys = np.empty((len(b), tables), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                keys[at] = table_keys(unit_rows(np.stack(b["vec"].to_numpy()[at])), per_key, tables)
            yield pd.DataFrame({"rep": b["rep"], "copies": b["copies"], "vec": b["vec"], "keys": list(keys)})

    return classes.mapInPandas(run, f"rep long, copies long, vec {kind}, keys array<long>")


def _forest(p: np.ndarray, q: np.ndarray, n: int) -> tuple[list[int], list[int]]:
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left, right = [], []
    for s, t in zip(p.tolist(), q.tolist()):
        a, b = find(s), find(t)
        if a != b:
            parent[max(a, b)] = min(a, b)
            left.append(s)
            right.append(t)
    return left, right


def _compare(g: pd.DataFrame, threshold: float) -> pd.DataFrame | None:
    """Links of one group: rows (a, a, copies linked to) and (a, b, 0) of a spanning forest."""
    unit, keys = unit_rows(np.stack(g["vec"].to_numpy())), np.stack(g["keys"].to_numpy())
    rep, copies, t = g["rep"].to_numpy(), g["copies"].to_numpy(), int(g["t"].iat[0])
    near = unit @ unit.T >= threshold
    if g["lo"].iat[0] != g["hi"].iat[0]:               # two tiles: pairs across them only
        tile = g["tile"].to_numpy()
        near &= tile[:, None] < tile[None, :]
    else:
        near = np.triu(near, 1)
    p, q = np.nonzero(near)
    if not len(p):
        return None
    new = np.ones(len(p), bool)
    for s in range(0, len(p), 1 << 15):                # not met in an earlier table
        a, b = p[s:s + (1 << 15)], q[s:s + (1 << 15)]
        new[s:s + (1 << 15)] = ~(keys[a, :t] == keys[b, :t]).any(axis=1)
    links = np.zeros(len(rep), np.int64)
    np.add.at(links, p[new], copies[q[new]])
    np.add.at(links, q[new], copies[p[new]])
    left, right = _forest(p, q, len(rep))
    some = np.flatnonzero(links)
    return pd.DataFrame({"a": np.concatenate([rep[some], rep[left]]), "b": np.concatenate([rep[some], rep[right]]),
                         "n": np.concatenate([links[some], np.zeros(len(left), np.int64)])})


def _links(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Compare the groups of sorted rows; a group may go on in the next batch."""
    ends = ["t", "key", "lo", "hi"]
    held: pd.DataFrame | None = None
    for b in batches:
        if held is not None:
            b = pd.concat([held, b], ignore_index=True)
        new = (b[ends] != b[ends].shift()).any(axis=1).to_numpy()
        cuts = np.append(np.flatnonzero(new), len(b))
        out = [r for s, e in zip(cuts[:-2], cuts[1:-1]) if (r := _compare(b.iloc[s:e], threshold)) is not None]
        if out:
            yield pd.concat(out)
        held = b.iloc[cuts[-2]:] if len(b) else None
    if held is not None and len(held):
        last = _compare(held, threshold)
        if last is not None:
            yield last


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                    miss: float = MISS, tile_rows: int = 512) -> DataFrame:
    """One row per distinct non-null id: vec_id, n_links, component_id, kept.

    Vectors whose cosine (double precision) is at least ``threshold`` link; ``n_links`` counts
    the other vectors linked directly, copies included, ``component_id`` is the smallest id
    reachable and ``kept`` tells whether it is the row's own. A pair at the threshold itself
    is missed with probability ``miss`` at most, closer ones less; no other pair links.
    Null, zero, empty and non-finite vectors link with nothing, vectors of different length
    do not link. Of rows that repeat an id, the smallest usable vector counts. Rows with a
    null id are left out. Other columns are ignored. An empty table gives none.
    """
    ensure_checkpoint_dir(vectors.sparkSession)
    rows = Stored(valid_vectors(vectors, id_col, vec_col))
    classes = rows.df.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    per_key, tables = table_plan(rows.df.count(), threshold, miss)
    base = Stored(_keyed(classes, per_key, tables))

    entries = base.df.select("rep", F.posexplode("keys").alias("t", "key"))
    shared = entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    tiles = F.ceil(F.col("size") / tile_rows).cast("int")
    tiled = (entries.join(shared, ["t", "key"])
             .withColumn("tile", F.pmod(F.xxhash64("rep"), tiles).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
             .select("t", "key", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
                     "tile", "rep"))
    ends = ["t", "key", "lo", "hi"]
    groups = tiled.join(base.df, "rep").repartition(*ends).sortWithinPartitions(*ends)
    found = groups.select(*ends, "tile", "rep", "copies", "vec", "keys").mapInPandas(
        lambda batches: _links(batches, threshold), "a long, b long, n long").checkpoint()

    degrees = found.filter("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    components = connected_components(found.filter("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    named = base.df.select("rep", "copies").join(degrees, "rep", "left").join(components, "rep", "left").select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component")
    copies = rows.df.join(base.df.filter("copies > 1").select("vec", "rep"), "vec").select("vec_id", "rep")
    ids = vectors.select(F.col(id_col).cast("long").alias("vec_id")).filter("vec_id is not null").distinct()
    component = F.coalesce("component", "rep", "vec_id")
    out = (ids.join(copies, "vec_id", "left").withColumn("rep", F.coalesce("rep", "vec_id"))
              .join(named, "rep", "left")
              .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))).checkpoint()
    rows.drop()
    base.drop()
    return out
