from .aggregate import aggregate, aggregate_levels, aggregate_rolling, aggregate_window
from .dedup import deduplicate, golden_record
from .join import join, lookup
from .mask import detokenize, mask, record_hash, token_vault, unmask
from .merge import merge
from .sort import sort

__all__ = [
    "aggregate",
    "aggregate_levels",
    "aggregate_rolling",
    "aggregate_window",
    "deduplicate",
    "detokenize",
    "golden_record",
    "join",
    "lookup",
    "mask",
    "merge",
    "record_hash",
    "sort",
    "token_vault",
    "unmask",
]
