from .flow import FlowRun, append_run_log, check_flow, check_inputs, run_flow
from .history import (
    daily_runs,
    failure_reasons,
    filter_runs,
    latency_percentiles,
    latest_runs,
    read_run_logs,
    rows_processed,
    run_by_id,
    run_history,
    sla_report,
)
from .inventory import file_inventory, filter_inventory, inventory_summary, inventory_totals
from .steps import STEPS, Step, custom_step

__all__ = [
    "STEPS",
    "FlowRun",
    "Step",
    "append_run_log",
    "check_flow",
    "check_inputs",
    "custom_step",
    "daily_runs",
    "failure_reasons",
    "file_inventory",
    "filter_inventory",
    "filter_runs",
    "inventory_summary",
    "inventory_totals",
    "latency_percentiles",
    "latest_runs",
    "read_run_logs",
    "rows_processed",
    "run_by_id",
    "run_flow",
    "run_history",
    "sla_report",
]
