"""Snapshot-consistent, foreign-key-aware table refresh on Spark DataFrames."""

from mirrorwell.config import RefreshConfig
from mirrorwell.plans.refresh import (
    cancel_job,
    cleanup_job,
    compact_target,
    copy_tables,
    plan_refresh,
    run_refresh,
    verify_job,
)
from mirrorwell.sources.catalog_tables import CatalogSource
from mirrorwell.sources.files import FileSource
from mirrorwell.sources.jdbc import JdbcSource

__all__ = [
    "CatalogSource",
    "FileSource",
    "JdbcSource",
    "RefreshConfig",
    "cancel_job",
    "cleanup_job",
    "compact_target",
    "copy_tables",
    "plan_refresh",
    "run_refresh",
    "verify_job",
]
