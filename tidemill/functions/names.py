"""Small helpers around column names and option values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names(value: str | Iterable[str] | None) -> list[str]:
    """Turn ``"a, b"`` or ``["a", "b"]`` into a clean list; ``None`` gives ``[]``."""
    if value is None:
        return []
    parts = value.split(",") if isinstance(value, str) else value
    return [p.strip() for p in parts if p and p.strip()]


def expressions(value: str | Iterable[str] | None) -> list[str]:
    """As ``names`` for SQL expressions: commas inside parentheses or quotes do not separate."""
    if not isinstance(value, str):
        return names(value)
    parts, depth, quote = [""], 0, ""
    for c in value:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c in "([":
            depth += 1
        elif c in ")]":
            depth -= 1
        if c == "," and not quote and depth == 0:
            parts.append("")
        else:
            parts[-1] += c
    return [p.strip() for p in parts if p.strip()]


def flag(value: bool | str | None, default: bool) -> bool:
    """Read a true/false option that may arrive as text."""
    if value is None:
        return default
    if isinstance(value, bool):
        return value
    word = value.strip().lower()
    if word not in ("true", "false"):
        raise ValueError(f"expected true or false, got {value!r}")
    return word == "true"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str, owner: str | None = None) -> Column:
    """Column by exact name (dots and spaces allowed), optionally of an aliased frame."""
    return F.col(f"{quoted(owner)}.{quoted(name)}" if owner else quoted(name))


def require_columns(df: DataFrame, wanted: Iterable[str], what: str) -> None:
    """Fail while the plan is built, not in the middle of a job."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: columns {missing} not found; available: {df.columns}")


def fresh(base: str, taken: Iterable[str]) -> str:
    """A helper column name that no existing column uses."""
    taken = {t.lower() for t in taken}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name
