"""DataFrame operators used by the reports."""

from ledgerlens.operators.averages import group_and_overall_avg, indicator
from ledgerlens.operators.hotkeys import spread_join
from ledgerlens.operators.joins import broadcast_if_small
from ledgerlens.operators.lookup import key_set, lookup
from ledgerlens.operators.recency import purchase_recency, recency_days
from ledgerlens.operators.runs import ordered_run_counts, run_counts_by_key, spaced_runs
from ledgerlens.operators.status import status_breakdown, status_pivot
from ledgerlens.operators.topk import positional_pivot, top_k_per_group

__all__ = [
    "broadcast_if_small", "group_and_overall_avg", "indicator",
    "key_set", "lookup", "ordered_run_counts", "positional_pivot", "purchase_recency",
    "recency_days", "run_counts_by_key", "spaced_runs", "spread_join", "status_breakdown", "status_pivot",
    "top_k_per_group",
]
