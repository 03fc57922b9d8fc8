from .quarantine import quarantine, quarantine_rows, read_quarantine, replay
from .reconcile import fx_reconcile
from .rules import Check, NotNull, Range, Rule, Unique, evaluate_rules, scorecard, split_by_rules

__all__ = [
    "Check",
    "NotNull",
    "Range",
    "Rule",
    "Unique",
    "evaluate_rules",
    "fx_reconcile",
    "quarantine",
    "quarantine_rows",
    "read_quarantine",
    "replay",
    "scorecard",
    "split_by_rules",
]
