"""Append-only feeds, incremental tables and the steps between them."""

from .feeds import auto_ingest, change_feed, consume, csv_feed, has_data, stateful_sums, tagged_union, with_change_metadata
from .steps import (
    HoldingsHistory,
    UnloadLedger,
    daily_cash_step,
    history_step,
    holdings_history,
    newest_totals,
    part,
    part_step,
    positions_step,
    run_steps,
    snapshot_step,
    totals_step,
    totals_table,
    touched_dates,
    unload_ledger,
    unload_step,
)
from .tables import BatchFolders, BatchLog, BatchSums, ChangeTable, NewestPerKey

__all__ = [
    "BatchFolders",
    "BatchLog",
    "BatchSums",
    "ChangeTable",
    "HoldingsHistory",
    "NewestPerKey",
    "UnloadLedger",
    "auto_ingest",
    "change_feed",
    "consume",
    "csv_feed",
    "daily_cash_step",
    "has_data",
    "history_step",
    "holdings_history",
    "newest_totals",
    "part",
    "part_step",
    "positions_step",
    "run_steps",
    "snapshot_step",
    "stateful_sums",
    "tagged_union",
    "totals_step",
    "totals_table",
    "touched_dates",
    "unload_ledger",
    "unload_step",
    "with_change_metadata",
]
