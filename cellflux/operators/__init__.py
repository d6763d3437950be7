"""DataFrame to DataFrame operators; each works on batch and streaming input."""

from cellflux.operators.aggregate import (
    daily_from_hourly,
    daily_totals,
    hourly_totals,
    tumbling_totals,
)
from cellflux.operators.clean import clean, repair_measures, valid_cells, with_event_time
from cellflux.operators.lines import (
    decode_lines,
    encode_records,
    file_order,
    head_lines,
    head_of_files,
    numbered_lines,
)
from cellflux.operators.sorting import kept_events, line_counts, rejected_lines, sorted_lines

__all__ = [
    "clean",
    "daily_from_hourly",
    "daily_totals",
    "decode_lines",
    "encode_records",
    "file_order",
    "head_lines",
    "head_of_files",
    "hourly_totals",
    "kept_events",
    "line_counts",
    "numbered_lines",
    "rejected_lines",
    "repair_measures",
    "sorted_lines",
    "tumbling_totals",
    "valid_cells",
    "with_event_time",
]
