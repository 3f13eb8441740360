"""Upserted tables: hash-partitioned, and only touched partitions rewritten.

Parquet has no MERGE. A table that changes in place (K12, K13) is kept in
``parts`` hash partitions of its key. A load finds the partitions its
batch touches, reads those alone, joins them with the batch and writes
them to a folder of its own: ``u=<id>/part=<k>/``. Per partition, the
newest folder that holds it is the current one; the list of them is kept
in the load's ``_PARTS`` file. So a load's cost grows with the partitions
it touches, not with the table; a hot key is one row of one partition;
nothing that is being read is overwritten (an overwrite in place would
leave a partition missing if it died between delete and rename); a load
that died has no ``_PARTS`` file and counts for nothing, and one that is
run again under its id rewrites its own folder only.

The number of partitions is fixed when the table is made, from the size
of its first load (``rows_per_part``); ``resize`` deals a grown table
anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.sinks.folders import file_system, read_text, write_text
from dimspark.sinks.writers import write_counted_by

PART = "__part"
UPSERT_PREFIX = "u="
MANIFEST = "_PARTS"
ROWS_PER_PART = 2_000_000
MAX_PARTS = 8192  # folders that one read lists

Change = Callable[[DataFrame | None, DataFrame], DataFrame]


def part_of(keys: Sequence[str], parts: int) -> Column:
    """The hash partition of a row: by the keys' values as text, so that it
    does not depend on a column's integer width."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(parts)).cast("int")


def _folder(root: str, load: int) -> str:
    return f"{root.rstrip('/')}/{UPSERT_PREFIX}{load:012d}"


def committed_loads(spark: SparkSession, root: str) -> list[int]:
    """Ids of the complete loads."""
    fs, p = file_system(spark, root)
    if not fs.exists(p):
        return []
    folders = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith(UPSERT_PREFIX)]
    return sorted(int(f.getName()[len(UPSERT_PREFIX) :]) for f in folders if fs.exists(f.suffix(f"/{MANIFEST}")))


def manifest(spark: SparkSession, root: str, before: int | None = None) -> dict | None:
    """The newest complete load's record before ``before``: its load id, the
    number of parts, the schema, the keys, the rows and, per part, the load
    that wrote it last and its rows."""
    loads = [x for x in committed_loads(spark, root) if before is None or x < before]
    return json.loads(read_text(spark, f"{_folder(root, loads[-1])}/{MANIFEST}")) if loads else None


def next_load(spark: SparkSession, root: str) -> int:
    loads = committed_loads(spark, root)
    return loads[-1] + 1 if loads else 0


def read_upserted(
    spark: SparkSession, root: str, before: int | None = None, parts: Sequence[int] | None = None
) -> DataFrame | None:
    """The table (or only some of its parts); None before the first load."""
    found = manifest(spark, root, before)
    if found is None:
        return None
    schema = T.StructType.fromJson(found["schema"])
    wanted = None if parts is None else set(parts)
    paths = [
        f"{_folder(root, load)}/{PART}={part}"
        for part, (load, _) in found["parts"].items()
        if wanted is None or int(part) in wanted
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def upserted_rows(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """Rows of the table, from the record of its newest load; None if it has
    none."""
    found = manifest(spark, root, before)
    return found["rows"] if found else None


def _touched(batch: DataFrame, keys: Sequence[str], parts: int) -> list[int]:
    """Parts the batch has keys in: at most MAX_PARTS small numbers."""
    return sorted(r[0] for r in batch.select(part_of(keys, parts).alias("p")).distinct().collect())


def upsert(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    keys: Sequence[str],
    change: Change,
    load: int | None = None,
    rows_per_part: int = ROWS_PER_PART,
    fresh: bool = False,
    adopt: DataFrame | None = None,
) -> dict:
    """One load. ``change(existing, batch)`` gives the touched partitions as
    they shall be: existing holds their stored rows (``adopt``, a table kept
    otherwise until now, or None on the first load; None with ``fresh``,
    which replaces the table). The batch is read more than once: stage it.
    Returns the load's record, with ``rows_written`` and ``parts_written``."""
    keys = list(keys)
    load = next_load(spark, root) if load is None else load
    found = None if fresh else manifest(spark, root, before=load)
    if found is None:
        new = change(None if fresh else adopt, batch)
        parts = min(MAX_PARTS, max(1, -(-new.count() // rows_per_part)))
        touched = list(range(parts))
    else:
        if found["keys"] != keys:
            raise ValueError(f"{root} is kept by {found['keys']}, not by {keys}")
        parts = found["parts_total"]
        touched = _touched(batch, keys, parts)
        new = change(read_upserted(spark, root, load, touched), batch) if touched else None
    written: dict[int, int] = {}
    schema = new.schema.jsonValue() if new is not None else found["schema"]
    if new is not None:
        written = _write_parts(new, _folder(root, load), keys, parts)
    gone = {str(p) for p in touched} if found else set()  # a change may leave a part empty
    kept = {p: x for p, x in (found["parts"] if found else {}).items() if p not in gone}
    kept |= {str(p): [load, rows] for p, rows in written.items()}
    record = _record(spark, root, load, keys, parts, schema, kept)
    return record | {"rows_written": sum(written.values()), "parts_written": len(written), "parts_touched": len(touched)}


def _write_parts(df: DataFrame, path: str, keys: Sequence[str], parts: int) -> dict[int, int]:
    return write_counted_by(df.withColumn(PART, part_of(keys, parts)), path, PART, parts)


def _record(spark: SparkSession, root: str, load: int, keys: list[str], total: int, schema: dict, parts: dict) -> dict:
    """Write a load's record, which makes the load count."""
    record = {"load": load, "keys": keys, "parts_total": total, "schema": schema, "parts": parts}
    record["rows"] = sum(rows for _, rows in parts.values())
    write_text(spark, f"{_folder(root, load)}/{MANIFEST}", json.dumps(record))
    return record


def resize(spark: SparkSession, root: str, rows_per_part: int = ROWS_PER_PART) -> dict | None:
    """Deal the table into as many parts as its size asks for now: one full
    rewrite, as a load of its own."""
    found = manifest(spark, root)
    if found is None:
        return None
    load, keys = found["load"] + 1, found["keys"]
    parts = min(MAX_PARTS, max(1, -(-found["rows"] // rows_per_part)))
    written = _write_parts(read_upserted(spark, root), _folder(root, load), keys, parts)
    return _record(spark, root, load, keys, parts, found["schema"], {str(p): [load, rows] for p, rows in written.items()})


def remove_old(spark: SparkSession, root: str) -> int:
    """Delete the partitions that no current load refers to (and folders of
    loads that died before the newest complete one). Returns how many
    folders went. Only for a table that nobody reads at an earlier load."""
    found = manifest(spark, root)
    if found is None:
        return 0
    fs, p = file_system(spark, root)
    gone = 0
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not name.startswith(UPSERT_PREFIX) or int(name[len(UPSERT_PREFIX) :]) > found["load"]:
            continue
        load = int(name[len(UPSERT_PREFIX) :])
        parts = [x for x in fs.listStatus(st.getPath()) if x.isDirectory() and x.getPath().getName().startswith(PART)]
        old = [x for x in parts if found["parts"].get(x.getPath().getName().split("=")[1], [None])[0] != load]
        for x in old:
            fs.delete(x.getPath(), True)
            gone += 1
        if len(old) == len(parts) and load != found["load"]:
            fs.delete(st.getPath(), True)
    return gone
