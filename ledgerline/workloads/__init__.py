"""Named queries over the star-schema Parquet tables, each with an independent SQL statement."""

from ledgerline.workloads import customers, kpis, quality  # noqa: F401
from ledgerline.workloads.registry import QUERIES

__all__ = ["QUERIES"]
