from .names import col, expressions, flag, fresh, names, quoted, require_columns
from .rounding import round_binary
from .secrets import secret
from .sizing import BROADCAST_ROWS, broadcast_if_small, fits_broadcast, spread, within_rows

__all__ = [
    "BROADCAST_ROWS",
    "broadcast_if_small",
    "col",
    "expressions",
    "fits_broadcast",
    "flag",
    "fresh",
    "names",
    "quoted",
    "require_columns",
    "round_binary",
    "secret",
    "spread",
    "within_rows",
]
