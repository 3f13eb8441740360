"""Scheduled source folders, by run time.

A path template names the folder of one run (``.../year={year}/...``). A
range of run times becomes the list of its folders: those that exist are
read, in one scan of these folders alone, and those that are missing are
reported. ``back_fill`` loads the runs of a range that a ledger does not
hold yet, one after the other, each under its own load id.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from dimspark.sinks.folders import file_system, write_text
from dimspark.sources.staging import templated_path

HOUR = dt.timedelta(hours=1)


def run_times(start: dt.datetime, end: dt.datetime, step: dt.timedelta = HOUR) -> Iterator[dt.datetime]:
    """start, start + step, ... before end."""
    if step <= dt.timedelta(0):
        raise ValueError("the step must be positive")
    while start < end:
        yield start
        start += step


@dataclass
class RunPlan:
    """The folders of a range of runs, and the runs without one."""

    present: dict[dt.datetime, str] = field(default_factory=dict)
    missing: list[dt.datetime] = field(default_factory=list)


def plan_runs(
    spark: SparkSession, template: str, start: dt.datetime, end: dt.datetime, step: dt.timedelta = HOUR, **extra: str
) -> RunPlan:
    """Which folders of a range exist. The driver asks the file system once
    per folder of the range, and lists no other."""
    plan, asked = RunPlan(), {}
    for t in run_times(start, end, step):
        path = templated_path(template, t, **extra)
        if path not in asked:
            fs, p = file_system(spark, path)
            asked[path] = fs.exists(p)
        if asked[path]:
            plan.present[t] = path
        else:
            plan.missing.append(t)
    return plan


def read_runs(spark: SparkSession, plan: RunPlan, read: Callable[[list[str]], DataFrame]) -> DataFrame | None:
    """One scan of a plan's folders, each read once (None if there are none)."""
    paths = list(dict.fromkeys(plan.present.values()))
    return read(paths) if paths else None


def load_id(run: dt.datetime) -> int:
    """A run's load id: minutes since 1970, so that later runs have higher ones."""
    return int(run.replace(tzinfo=dt.timezone.utc).timestamp()) // 60


def back_fill(
    spark: SparkSession,
    template: str,
    start: dt.datetime,
    end: dt.datetime,
    ledger: str,
    load: Callable[[DataFrame, int], None],
    read: Callable[[list[str]], DataFrame],
    step: dt.timedelta = HOUR,
    **extra: str,
) -> dict[str, list[dt.datetime]]:
    """Load the runs that the ledger does not hold, in order. ``load`` gets a
    run's rows and its load id; the run is entered once it returns, so one
    that fails is loaded again, under the same id. Returns the runs that
    were ``loaded`` now, held ``before``, and ``missing`` their folder."""
    fs, p = file_system(spark, ledger)
    held = {st.getPath().getName() for st in fs.listStatus(p)} if fs.exists(p) else set()
    plan = plan_runs(spark, template, start, end, step, **extra)
    out: dict[str, list[dt.datetime]] = {"loaded": [], "before": [], "missing": plan.missing}
    for run, path in plan.present.items():
        name = f"run-{load_id(run):012d}"
        if name in held:
            out["before"].append(run)
            continue
        load(read([path]), load_id(run))
        write_text(spark, f"{ledger.rstrip('/')}/{name}", path)
        out["loaded"].append(run)
    return out
