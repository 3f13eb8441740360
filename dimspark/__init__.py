"""dimspark: star-schema ETL and analytics on Spark DataFrames.

Layout:
  sources/    readers for JSON, CSV, Parquet and label text (S*)
  functions/  column expressions: time, text, keys, casts (T*, K9-K10, P9-P10)
  operators/  DataFrame -> DataFrame building blocks: dedupe, lookup joins,
              upserts, pivots, multi-level averages (A*, J*, K11-K13)
  plans/      composite table builders and reports (C*, Q*)
  sinks/      writers and load modes (K1-K8, K14)
  streaming/  incremental file-stream loading of activity logs

Every builder is lazy; only sinks, checks and reports run Spark actions.
"""

from dimspark.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
