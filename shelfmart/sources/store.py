"""Layer store: each warehouse table is a Parquet directory written once and read back.

Tables live under a root inside the session's checkpoint folder (shared storage on a
cluster), keyed by a fingerprint of the inputs, so a lost executor recomputes from a
written table instead of from the raw extract, and every downstream query scans
Parquet with pushdown and pruning.

Versioned publish (for the pipeline): a table is a set of ``v=N`` directories. A new
version is written beside the old one and becomes live by a small write after the data is
complete: all tables of a warehouse together in its ``_PUBLISHED`` manifest, a table on its
own in its ``_CURRENT`` pointer. A reader never sees a half-written table and the table
being read is never overwritten in place. A table that is partitioned may be live in
several versions, each partition in one: the manifest then maps partitions to versions, and
a run that touches a few of them writes only these.

Bucketed tables: a folder written in buckets of a key is registered in the session's
catalog, so that joins and aggregations on the key read it without an exchange. Its layout
is stored beside the data, and any later session registers it again from there.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _jvm_fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; a missing one is no error."""
    fs, p, _ = _jvm_fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _jvm_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _jvm_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines, line = [], reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def committed(spark: SparkSession, path: str) -> bool:
    """A Parquet directory whose write job committed (``_SUCCESS`` marker present)."""
    return exists(spark, f"{path}/_SUCCESS")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# ---- bucketed tables ---------------------------------------------------------------------

#: Folder name of the partition of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _table_name(path: str) -> str:
    return "shelfmart_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _quoted(names: Iterable[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}`" for n in names)


def layout(spark: SparkSession, path: str) -> dict | None:
    """How a bucketed table is laid out (key, buckets, partition and sort columns), None for others."""
    text = read_text(spark, f"{path}/_LAYOUT")
    return None if text is None else json.loads(text)


_SHUFFLED: list[int] = []
_SHUFFLED_BEFORE: dict[str, str] = {}
_SHUFFLED_GUARD = threading.Lock()

#: Stored bytes one task of a build reads: what it unpacks to fits its memory even if it is sorted.
BYTES_PER_TASK = 32 << 20


@contextmanager
def shuffled_into(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Plans made and run inside exchange into ``partitions`` partitions and read files in pieces
    of ``BYTES_PER_TASK`` at most. The files of their exchanges go when the plan has run: what it
    made is stored, and else they stay until the driver happens to collect its garbage, so a build
    of several layers holds those of all. Where threads overlap, the largest number holds for all
    of them, and the session's settings return with the last one's end."""
    shuffle, piece = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    freed = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def settle() -> None:
        if _SHUFFLED:
            spark.conf.set(shuffle, str(max(_SHUFFLED)))
            spark.conf.set(piece, str(BYTES_PER_TASK))
            spark.conf.set(freed, "true")
        else:
            for name, value in _SHUFFLED_BEFORE.items():
                spark.conf.set(name, value)

    with _SHUFFLED_GUARD:
        if not _SHUFFLED:
            _SHUFFLED_BEFORE.update({name: spark.conf.get(name) for name in (shuffle, piece, freed)})
        _SHUFFLED.append(partitions)
        settle()
    try:
        yield
    finally:
        with _SHUFFLED_GUARD:
            _SHUFFLED.remove(partitions)
            settle()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, partition_by: Iterable[str] = (),
                   sort_by: str | None = None) -> None:
    """Write ``df`` in ``buckets`` buckets of ``key``, replacing the folder.

    Rows that come hash-partitioned on the key into as many partitions, as from an
    aggregation or join on it (``shuffled_into``), make one file per bucket and partition
    value; no exchange is added here."""
    spark, name, parts = df.sparkSession, _table_name(path), list(partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {name}")             # the catalog entry; the files are not the catalog's
    delete(spark, path)
    w = df.write.format("parquet").option("compression", "zstd").bucketBy(buckets, key).sortBy(sort_by or key).option("path", path)
    (w.partitionBy(*parts) if parts else w).saveAsTable(name)
    write_text(spark, f"{path}/_LAYOUT", json.dumps({
        "key": key, "buckets": buckets, "partition_by": parts, "sort_by": sort_by or key,
        "columns": ddl(spark.table(name))}))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored folder; bucketed ones with their buckets, whichever session wrote them."""
    found = layout(spark, path)
    if found is None:
        return spark.read.parquet(path)
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        parts = f"PARTITIONED BY ({_quoted(found['partition_by'])})" if found["partition_by"] else ""
        spark.sql(f"CREATE TABLE {name} ({found['columns']}) USING parquet {parts} CLUSTERED BY ({_quoted([found['key']])}) "
                  f"SORTED BY ({_quoted([found['sort_by']])}) INTO {found['buckets']} BUCKETS LOCATION '{path}'")
        if parts:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def _manifest_hash(files: DataFrame) -> DataFrame:
    """One row that changes with any file's row: count, bytes and two order-free digests."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in files.columns])
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                     F.coalesce(F.bit_xor(row), F.lit(0)).alias("xor"),
                     F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("sum"))


def manifest(spark: SparkSession, path: str, deep: bool = False) -> tuple:
    """The files under ``path`` as one comparable row (made on the executors)."""
    return tuple(_manifest_hash(content_fingerprint(spark, path, deep)).first())


def input_fingerprint(spark: SparkSession, paths: list[str], salt: str = "") -> str:
    """sha256 over the manifest (path, length, modificationTime) of the input files.

    Uses the binaryFile source with the content column pruned, so file bytes are not
    read; this is the cheap form of the source fingerprint (S2) for large inputs.
    """
    meta = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    return hashlib.sha256(f"{salt}|{tuple(_manifest_hash(meta).first())}".encode()).hexdigest()


def content_fingerprint(spark: SparkSession, path: str, deep: bool = True) -> DataFrame:
    """Per-file fingerprint (path, length, modificationTime, sha256).

    ``deep`` hashes the bytes (reads every file once more); otherwise sha256 is NULL and
    only the listing metadata is compared, which costs no data I/O at any size. Files on a
    mounted folder are hashed piece by piece, whatever their size; those of other file systems
    are held one at a time in memory (so below 2 GB each).
    """
    df = spark.read.format("binaryFile").load(path)
    if not deep:
        digest = F.lit(None).cast("string")
    elif _jvm_fs(spark, path)[0].getScheme() == "file":
        @F.udf("string")
        def sha256_of(uri):
            import hashlib
            import re
            with open(re.sub("^file:(//(?=/))?", "", uri), "rb") as f:
                return hashlib.file_digest(f, "sha256").hexdigest()
        digest = sha256_of("path")
    else:
        digest = F.sha2(F.col("content"), 256)
    return df.select("path", "length", "modificationTime", digest.alias("sha256"))


# ---- versioned tables (pipeline) -------------------------------------------------------

def _pointer(spark: SparkSession, table: str) -> dict | None:
    text = read_text(spark, f"{table}/_CURRENT")
    return None if text is None else json.loads(text)


def current_version(spark: SparkSession, table: str) -> int | dict | None:
    """The live version: of the warehouse's manifest if the table is in one, else its own pointer."""
    root, layer, name = table.rsplit("/", 2)
    v = published(spark, root)["tables"].get(f"{layer}/{name}")
    if v is not None:
        return v
    own = _pointer(spark, table)
    return None if own is None else own["version"]


def published(spark: SparkSession, root: str) -> dict:
    """The warehouse manifest: the run that wrote it, live versions, and those before that run."""
    text = read_text(spark, f"{root.rstrip('/')}/_PUBLISHED")
    return json.loads(text) if text else {"run_id": None, "tables": {}, "base": {}}


def base_versions(spark: SparkSession, root: str, run_id: str) -> dict[str, int | dict]:
    """Versions a run starts from: a repeated run starts where its first attempt did."""
    now = published(spark, root)
    return now["base"] if now["run_id"] == run_id else now["tables"]


def publish_all(spark: SparkSession, root: str, run_id: str, versions: dict[str, int | dict]) -> None:
    """Make the staged versions of one run live together, by one write of the manifest."""
    base = base_versions(spark, root, run_id)
    write_text(spark, f"{root.rstrip('/')}/_PUBLISHED", json.dumps(
        {"run_id": run_id, "tables": {**base, **versions}, "base": base}))


def read_current(spark: SparkSession, table: str) -> DataFrame | None:
    return read_version(spark, table, current_version(spark, table))


def read_version(spark: SparkSession, table: str, live: int | dict | None) -> DataFrame | None:
    """A table at a version, or with each partition at its own (``live_parts``)."""
    if live is None:
        return None
    if isinstance(live, int):
        return read_table(spark, f"{table}/v={live}")
    by: dict[int, list[str]] = {}
    for part, v in live["parts"].items():
        by.setdefault(v, []).append(part)
    if not by:                                             # no partition is left
        return spark.createDataFrame([], live["columns"])
    out = None
    for v, parts in sorted(by.items()):
        base, column = f"{table}/v={v}", F.col(live["by"])
        if layout(spark, base) is None:
            df = spark.read.option("basePath", base).parquet(*[f"{base}/{live['by']}={p}" for p in sorted(parts)])
        else:                                             # a union of tables in the same buckets keeps them
            named = column.isin([int(p) for p in parts if p != NO_VALUE])
            df = read_table(spark, base).filter(named | column.isNull() if NO_VALUE in parts else named)
        out = df if out is None else out.unionByName(df)
    return out


def only_parts(live: dict, keep: Iterable[str]) -> dict:
    """A version map restricted to some partitions."""
    wanted = set(keep)
    return {**live, "parts": {p: v for p, v in live["parts"].items() if p in wanted}}


def next_version(spark: SparkSession, table: str) -> int:
    """A version number that no earlier write used; one left by a stopped run is never reused."""
    now = current_version(spark, table)
    v = 1 + (now if isinstance(now, int) else now["latest"] if now else 0)
    while exists(spark, f"{table}/v={v}"):
        v += 1
    return v


def stage(df: DataFrame, table: str, partition_by: list[str] | None = None) -> int:
    """Write the next version beside the current one without making it visible."""
    v = next_version(df.sparkSession, table)
    write_table(df, f"{table}/v={v}", partition_by)
    return v


def partitions(spark: SparkSession, path: str, by: str) -> list[str]:
    """Values, as folder names hold them, of the first partition column of a stored folder."""
    fs, p, _ = _jvm_fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return sorted(n[len(by) + 1:] for n in names if n.startswith(f"{by}="))


def stage_parts(df: DataFrame, table: str, by: str, before: int | dict | None = None,
                replaced: Iterable[str] | None = None) -> dict:
    """Stage the partitions that ``df`` holds and say where each partition of the table is then.

    Partitions of ``before`` stay where they are, files untouched, unless they are in
    ``replaced`` (None: all) or written anew."""
    spark, v = df.sparkSession, next_version(df.sparkSession, table)
    write_table(df, f"{table}/v={v}", [by])
    return parts_map(spark, table, v, by, ddl(df), before, replaced)


def ddl(df: DataFrame) -> str:
    return df._jdf.schema().toDDL()


def parts_map(spark: SparkSession, table: str, v: int, by: str, columns: str, before: int | dict | None = None,
              replaced: Iterable[str] | None = None) -> dict:
    """Where each partition is once version ``v`` was written (``stage_parts``); ``columns`` are
    the table's, as DDL, for when no partition is left."""
    kept: dict[str, int] = {}
    if before is not None and replaced is not None:
        gone = set(replaced)
        kept = {p: n for p, n in as_map(spark, table, before, by)["parts"].items() if p not in gone}
    return {"by": by, "latest": v, "columns": columns,
            "parts": {**kept, **{p: v for p in partitions(spark, f"{table}/v={v}", by)}}}


def as_map(spark: SparkSession, table: str, live: int | dict, by: str) -> dict:
    """A version as a map of its partitions."""
    if isinstance(live, dict):
        return live
    path = f"{table}/v={live}"
    return {"by": by, "latest": live, "columns": ddl(read_table(spark, path)),
            "parts": {p: live for p in partitions(spark, path, by)}}


def live_parts(spark: SparkSession, table: str, live: int | dict | None, by: str) -> list[str]:
    """Partition values of a table at a version."""
    if live is None:
        return []
    return sorted(as_map(spark, table, live, by)["parts"])


def commit(spark: SparkSession, table: str, version: int, **notes) -> None:
    """Make a staged version of a table outside a warehouse the current one, by one small
    write; ``notes`` are kept beside it."""
    write_text(spark, f"{table}/_CURRENT", json.dumps({"version": version, **notes}))


def retire(spark: SparkSession, table: str, keep: int = 1) -> list[int]:
    """Delete the versions of a table that are neither live, nor what a repeated run would start
    from, nor among the ``keep`` newest of the others; returns them. A reader may hold a
    version for as long as ``keep`` later ones take to be written."""
    root, layer, name = table.rsplit("/", 2)
    manifest_ = published(spark, root)
    used: set[int] = set()
    for now in (manifest_["tables"].get(f"{layer}/{name}"), manifest_["base"].get(f"{layer}/{name}"),
                (_pointer(spark, table) or {}).get("version")):
        if isinstance(now, dict):
            used.update(now["parts"].values(), [now["latest"]])
        elif now is not None:
            used.add(now)
    newest = max(used, default=0)
    free = sorted((int(v) for v in partitions(spark, table, "v") if int(v) not in used and int(v) < newest), reverse=True)
    for v in free[keep:]:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{table}/v={v}')}")
        delete(spark, f"{table}/v={v}")
    return sorted(free[keep:])


def pointer_note(spark: SparkSession, table: str, name: str, default=None):
    return (_pointer(spark, table) or {}).get(name, default)


def publish(df: DataFrame, table: str, partition_by: list[str] | None = None) -> int:
    """Stage a new version, then switch the pointer (S5: never overwrite what is read)."""
    v = stage(df, table, partition_by)
    commit(df.sparkSession, table, v)
    return v


# ---- logs (control state) ----------------------------------------------------------------

def write_log(df: DataFrame, path: str, run_id: str) -> None:
    """Store one run's rows of a log. A repeated run replaces its own rows, so it leaves the
    log as one run does."""
    write_table(df, f"{path}/run={quote(run_id, safe='')}")


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """All runs' rows of a log."""
    if not exists(spark, path):
        return None
    return spark.read.parquet(path).drop("run")


def read_run_log(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """One run's rows of a log: its part is read alone, however many runs there were."""
    return spark.read.parquet(f"{path}/run={quote(run_id, safe='')}")
