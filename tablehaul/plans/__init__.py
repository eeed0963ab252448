"""Whole loads."""

from tablehaul.plans.jobs import DryRun, bulk_import, load_blob_listing, run_sql_steps, transfer

__all__ = ["DryRun", "bulk_import", "load_blob_listing", "run_sql_steps", "transfer"]
