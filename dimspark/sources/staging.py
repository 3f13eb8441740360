"""Staging clean-up and run-time source paths."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.functions.textfn import blank_to_null, truncate_bytes, truncate_chars


def clean_strings(
    df: DataFrame,
    blanks_as_null: bool = True,
    truncate_to: int | None = None,
    truncate_to_bytes: int | Mapping[str, int] | None = None,
) -> DataFrame:
    """Per text column, '' and blanks -> NULL; optionally cut to
    ``truncate_to`` characters, or to ``truncate_to_bytes`` bytes between
    characters (TRUNCATECOLUMNS for varchar(n), whose n counts bytes; a
    mapping gives n by column)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            if blanks_as_null:
                c = blank_to_null(c)
            if truncate_to is not None:
                c = truncate_chars(c, truncate_to)
            width = truncate_to_bytes.get(f.name) if isinstance(truncate_to_bytes, Mapping) else truncate_to_bytes
            if width is not None:
                c = truncate_bytes(c, width)
        out.append(c.alias(f.name))
    return df.select(*out)


def templated_path(template: str, run_time: dt.datetime | dt.date, **extra: str) -> str:
    """Fill a source path template from the run date.

    Fields: ``{ds}`` (YYYY-MM-DD), ``{year}``, ``{month}``, ``{day}``,
    ``{hour}`` (zero-padded), ``{execution_date}`` (ISO) and any ``extra`` ones.
    Reading only the folder of one run lets the scan skip the others.
    """
    d = run_time
    return template.format(
        ds=d.strftime("%Y-%m-%d"),
        year=f"{d.year:04d}",
        month=f"{d.month:02d}",
        day=f"{d.day:02d}",
        hour=f"{getattr(d, 'hour', 0):02d}",
        execution_date=d.isoformat(),
        **extra,
    )
