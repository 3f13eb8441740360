"""All registered driver queries (importing the modules registers them)."""

from dimspark.plans import driver, driver_capstone, driver_io, driver_sources, driver_tables  # noqa: F401
from dimspark.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
