"""Versioned tables: each load writes a new folder under a table root.

Two kinds of folder:

* ``v=<id>``: the whole table as of load ``id`` (dimensions after an
  upsert, a fact after an overwrite),
* ``d=<id>``: only the rows load ``id`` added (append-only facts), so an
  hourly load writes its new rows, never the whole fact table again.

The table is the newest complete ``v=`` folder plus every ``d=`` folder
after it, read in one multi-path scan. ``compact`` folds the deltas into
a new ``v=`` folder when their number grows.

Upserts compute the next table from the current one, so they never
overwrite the path they read. A folder counts once its ``_SUCCESS``
marker exists (Spark writes it when the job commits), so a load that
died half-way is ignored and simply re-run with the same id, which
rewrites exactly its own folder.

A folder's row count is taken while it is written and kept beside its
rows (``_ROWS``), so ``table_rows`` adds up a few small files and runs no
job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dimspark.sinks.folders import file_system, read_text, write_text
from dimspark.sinks.upserted import committed_loads, read_upserted, upserted_rows
from dimspark.sinks.writers import write_counted

VERSION_PREFIX = "v="
DELTA_PREFIX = "d="
ROWS_FILE = "_ROWS"


def _committed(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(id, prefix) of the complete folders under ``root``, by id."""
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        for prefix in (VERSION_PREFIX, DELTA_PREFIX):
            if st.isDirectory() and name.startswith(prefix) and fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append((int(name[len(prefix):]), prefix))
    return sorted(out)


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Ids of the complete loads (full versions, deltas, upserts)."""
    return sorted({i for i, _ in _committed(spark, root)} | set(committed_loads(spark, root)))


def version_path(root: str, version: int, delta: bool = False) -> str:
    return f"{root.rstrip('/')}/{DELTA_PREFIX if delta else VERSION_PREFIX}{version:012d}"


def current_paths(spark: SparkSession, root: str, before: int | None = None) -> list[str]:
    """Folders that make up the table (before load ``before``, if given):
    the newest full version and the deltas after it."""
    done = [(i, k) for i, k in _committed(spark, root) if before is None or i < before]
    bases = [i for i, k in done if k == VERSION_PREFIX]
    base = bases[-1] if bases else -1
    paths = [version_path(root, base)] if bases else []
    return paths + [version_path(root, i, delta=True) for i, k in done if k == DELTA_PREFIX and i > base]


def read_current(
    spark: SparkSession, root: str, before: int | None = None, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table before load ``before`` (None if it has no load yet). With a
    schema no file is opened to infer one, and loads without rows are read
    as such. A table kept by :mod:`dimspark.sinks.upserted` is read as that."""
    upserted = read_upserted(spark, root, before)
    if upserted is not None:
        return upserted
    paths = current_paths(spark, root, before)
    if not paths:
        return None
    return _read_folders(spark, paths, schema)


def _read_folders(spark: SparkSession, paths: list[str], schema: T.StructType | None) -> DataFrame:
    """One scan of all plain folders. A folder with partition folders in it
    is a scan of its own (Spark discovers partitions under one root), which
    a filter on them prunes; compaction bounds their number."""
    plain, parted = [], []
    for path in paths:
        fs, p = file_system(spark, path)
        names = [x.getPath().getName() for x in fs.listStatus(p)]
        if any("=" in n for n in names):
            parted.append([path])
        elif any(not n.startswith(("_", ".")) for n in names):
            plain.append(path)
    if not plain and not parted and schema:
        return spark.createDataFrame([], schema)
    scans = [(spark.read.schema(schema) if schema else spark.read).parquet(*x) for x in parted + [plain] * bool(plain)]
    return reduce(lambda a, b: a.unionByName(b), scans)


def read_latest(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table as of its newest complete load."""
    return read_current(spark, root, schema=schema)


def folder_rows(spark: SparkSession, path: str) -> int:
    """Rows of one load's folder: as counted by its write, else counted now."""
    kept = read_text(spark, f"{path}/{ROWS_FILE}")
    return int(kept) if kept else _read_folders(spark, [path], None).count()


def table_rows(spark: SparkSession, root: str, before: int | None = None) -> int:
    """Rows of the current table, from the counts kept with its folders."""
    upserted = upserted_rows(spark, root, before)
    if upserted is not None:
        return upserted
    return sum(folder_rows(spark, path) for path in current_paths(spark, root, before))


def batch_version(spark: SparkSession, root: str, tables, stream: str, batch: int) -> int:
    """The load id of a stream's batch: above everything its tables hold
    when the batch first runs, and the same one when it runs again. Kept as
    an empty folder named by the id, under the stream and the batch."""
    base = f"{root.rstrip('/')}/_batches/{stream}/{batch:012d}"
    fs, p = file_system(spark, base)
    known = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    if known:
        return max(int(name[2:]) for name in known)
    v = max(next_version(spark, f"{root.rstrip('/')}/{t}") for t in tables)
    fs.mkdirs(p.suffix(f"/v={v:012d}"))
    return v


def next_version(spark: SparkSession, root: str) -> int:
    vs = committed_versions(spark, root)
    return vs[-1] + 1 if vs else 0


def _write(df: DataFrame, path: str, partition_by) -> int:
    rows = write_counted(df, path, partition_by)
    write_text(df.sparkSession, f"{path}/{ROWS_FILE}", str(rows))
    return rows


def write_version(df: DataFrame, root: str, version: int, partition_by=()) -> int:
    """The whole table as of load ``version``; returns its rows."""
    return _write(df, version_path(root, version), partition_by)


def write_delta(df: DataFrame, root: str, version: int, partition_by=()) -> int:
    """Rows added by load ``version``; the table before it is not rewritten.
    Returns their number."""
    return _write(df, version_path(root, version, delta=True), partition_by)


def deltas_since_base(spark: SparkSession, root: str) -> int:
    """Number of delta folders a read of the table scans besides its base."""
    return max(len(current_paths(spark, root)) - 1, 0) if any(
        k == VERSION_PREFIX for _, k in _committed(spark, root)
    ) else len(current_paths(spark, root))


def compact(spark: SparkSession, root: str, partition_by=(), schema: T.StructType | None = None) -> str | None:
    """Write the current table (base + deltas) as a new full version, so
    later reads scan one folder instead of many. Returns its folder."""
    cur = read_current(spark, root, schema=schema)
    if cur is None:
        return None
    version = next_version(spark, root)
    write_version(cur, root, version, partition_by)
    return version_path(root, version)
