"""Operators that Spark has no single call for, composed from those it has."""

from .asof import asof_instants, asof_prices
from .dates import each_date, weekly_schedule
from .governance import (
    Governed,
    Principal,
    apply_masks,
    as_principal,
    classify_columns,
    govern,
    mask_date,
    mask_number,
    mask_ssn,
    mask_text,
    row_access,
    tag_columns,
)
from .latest import latest_per_key, newest
from .merge import changed_positions, merge_positions, trade_summary
from .payload import build_payload, flatten_trades, payload_paths

__all__ = [
    "Governed",
    "Principal",
    "apply_masks",
    "as_principal",
    "asof_instants",
    "asof_prices",
    "build_payload",
    "changed_positions",
    "classify_columns",
    "each_date",
    "flatten_trades",
    "govern",
    "latest_per_key",
    "mask_date",
    "mask_number",
    "mask_ssn",
    "mask_text",
    "merge_positions",
    "newest",
    "payload_paths",
    "row_access",
    "tag_columns",
    "trade_summary",
    "weekly_schedule",
]
