"""Bulk JSON load through a path file.

A path file holds ``{"jsonpaths": [...]}``: the n-th path says where the
n-th column of the target comes from. Paths start at the record (``$``)
and go down by field (``.name``, ``['name']``) and array index (``[0]``).
They are compiled twice: into one read schema that holds exactly the
fields the paths use (the JSON reader builds nothing else), and into one
projection of those fields onto the target columns.

A path that a record does not have, an index past the end of an array and
a value that does not fit the column's type give NULL. A column named in
``epoch_ms`` is read as milliseconds since the epoch into a timestamp.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.sinks.folders import read_text
from dimspark.sources.files import read_json_dir

Step = str | int

_STEP = re.compile(r"""\.([^.\[\]'"]+)|\['((?:[^'\\]|\\.)*)'\]|\["((?:[^"\\]|\\.)*)"\]|\[(\d+)\]""")


def parse_path(path: str) -> list[Step]:
    """The steps of a path: names for fields, numbers for array elements."""
    text = path.strip()
    if not text.startswith("$"):
        raise ValueError(f"path {path!r} does not start with $")
    steps: list[Step] = []
    at = 1
    while at < len(text):
        m = _STEP.match(text, at)
        if not m:
            raise ValueError(f"path {path!r} cannot be read from character {at + 1}")
        dotted, single, double, index = m.groups()
        if index is not None:
            steps.append(int(index))
        else:
            name = next(x for x in (dotted, single, double) if x is not None)
            steps.append(name if dotted is not None else re.sub(r"\\(.)", r"\1", name))
        at = m.end()
    if not steps or not isinstance(steps[0], str):
        raise ValueError(f"path {path!r} names no field of the record")
    return steps


def read_path_file(spark: SparkSession, path: str) -> list[list[Step]]:
    """The paths of a path file (a small file, on any file system)."""
    text = read_text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    paths = json.loads(text).get("jsonpaths")
    if not isinstance(paths, list) or not paths:
        raise ValueError(f"{path} has no list of jsonpaths")
    return [parse_path(p) for p in paths]


def _add(tree: dict, steps: list[Step], leaf: T.DataType) -> None:
    """Put a path into a tree of steps; '[]' stands for any array element."""
    for i, step in enumerate(steps):
        name = step if isinstance(step, str) else "[]"
        if any((k == "[]") != (name == "[]") for k in tree):
            raise ValueError(f"the paths read one value both as an object and as an array (at {name})")
        if any(k != name and k.lower() == name.lower() for k in tree):
            raise ValueError(f"the field names {name} and another one differ in case only")
        last = i == len(steps) - 1
        if last:
            if tree.get(name, leaf) != leaf:
                raise ValueError(f"the paths read {name} as two types")
            tree[name] = leaf
        else:
            tree = tree.setdefault(name, {})
            if not isinstance(tree, dict):
                raise ValueError(f"the paths read {name} both as a value and as an object")


def _type(tree) -> T.DataType:
    if not isinstance(tree, dict):
        return tree
    if "[]" in tree:
        return T.ArrayType(_type(tree["[]"]))
    return T.StructType([T.StructField(k, _type(v)) for k, v in tree.items()])


def compile_schema(paths: Sequence[list[Step]], types: Sequence[T.DataType]) -> T.StructType:
    """The least schema with all the paths' fields. Paths to one field must
    agree on its type."""
    tree: dict = {}
    for steps, leaf in zip(paths, types):
        _add(tree, steps, leaf)
    return _type(tree)


def path_column(steps: list[Step]) -> Column:
    c = F.col("`" + str(steps[0]).replace("`", "``") + "`")
    for step in steps[1:]:
        c = c.getField(step) if isinstance(step, str) else F.get(c, step)
    return c


def read_json_paths(
    spark: SparkSession,
    source: str | Sequence[str],
    path_file: str,
    target: T.StructType,
    epoch_ms: Sequence[str] = (),
    glob: str = "*.json",
) -> DataFrame:
    """The records under ``source`` as rows of ``target``."""
    paths = read_path_file(spark, path_file)
    if len(paths) != len(target.fields):
        raise ValueError(f"{path_file} has {len(paths)} paths for {len(target.fields)} columns")
    types = [T.LongType() if f.name in epoch_ms else f.dataType for f in target.fields]
    records = read_json_dir(spark, source, compile_schema(paths, types), glob)
    out = []
    for steps, f in zip(paths, target.fields):
        c = path_column(steps)
        out.append((F.timestamp_millis(c) if f.name in epoch_ms else c).alias(f.name))
    return records.select(*out)
