"""Name -> report function, for the driver contract and the bench."""

from __future__ import annotations

from ledgerlens.plans import loading as L
from ledgerlens.plans import reports as R

QUERIES = {
    "monthly_status_report": R.monthly_status_report,
    "top_products_monthly": R.top_products_monthly,
    "top_customers_monthly_per_line": R.top_customers_monthly_per_line,
    "top_customers_monthly": R.top_customers_monthly,
    "top3_products_customers": R.top3_products_customers,
    "territory_vs_org_avg": R.territory_vs_org_avg,
    "group_vs_org_avg_last6": R.group_vs_org_avg_last6,
    "consecutive_code_counts": R.consecutive_code_counts,
    "consecutive_codes": R.consecutive_codes,
    "spaced_code_runs": R.spaced_code_runs,
    "purchase_recency": R.purchase_recency_report,
    "positional_pivot": R.positional_pivot_events,
    "category_pivot_onehot": R.category_pivot_onehot,
    "load_normalized_table": L.load_normalized_table,
    "load_all_tables": L.load_all_tables,
    "monthly_status_loaded": L.monthly_status_loaded,
    "script_to_table": L.script_to_table,
    "script_with_month_values": L.script_with_month_values,
    "script_run_log": L.script_run_log,
    "append_rows": L.append_rows,
    "parsed_dates": L.parsed_dates,
    "table_roundtrip": L.customer_table_roundtrip,
    "csv_roundtrip": L.csv_roundtrip,
    "filter_sort_demo": L.filter_sort_demo,
    "customer_lookup": L.customer_lookup,
    "incremental_load": L.incremental_header_load,
    "replace_after_failed_load": L.replace_after_failed_load,
    "append_batches_once": L.append_batches_once,
    "quarantined_rows": L.quarantined_rows,
    "types_over_arriving_files": L.types_over_arriving_files,
    "monthly_status_incremental": L.monthly_status_incremental,
    "group_vs_org_avg_partitioned": L.group_vs_org_avg_partitioned,
    "monthly_status_hot_keys": L.monthly_status_hot_keys,
}
