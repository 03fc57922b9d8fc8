"""Column masking: hash, tokenize, redact, encrypt, and a reversible token vault."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col, names, require_columns, secret

STRATEGIES = ("hash", "tokenize", "redact", "encrypt")
#: Fixed value: what a redacted column holds.
REDACTED = "***"


def _text(c: Column) -> Column:
    return c.cast("string")


def token(c: Column, salt: str | None = None) -> Column:
    """SHA-256 hex of the text, after the salt when one is given; null stays null."""
    text = _text(c)
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


def mask(
    df: DataFrame,
    columns: str | Iterable[str],
    strategy: str = "hash",
    key: str | Column | None = None,
    salt: str | None = None,
    secret_ref: str | None = None,
) -> DataFrame:
    """Rewrite the named columns in place, order of columns unchanged.

    ``hash`` and unsalted ``tokenize`` are the SHA-256 hex of the value's text;
    ``redact`` is the literal ``***`` also for nulls (and frees the scan from reading the
    column); ``encrypt`` is base64 of AES-GCM under a key of 16, 24 or 32 bytes. ``secret_ref`` names
    that key (see :func:`~tidemill.functions.secret`); a literal ``key`` would be readable in plans and event logs.
    A column that does not exist raises, since a typo would leak data.
    """
    wanted = names(columns)
    require_columns(df, wanted, "mask")
    if strategy == "hash":
        hide = token
    elif strategy == "tokenize":
        hide = lambda c: token(c, salt)
    elif strategy == "redact":
        hide = lambda c: F.lit(REDACTED)
    elif strategy == "encrypt":
        value = _key(df, key, secret_ref, "mask: strategy 'encrypt'")
        hide = lambda c: F.base64(F.aes_encrypt(_text(c), value, F.lit("GCM")))
    else:
        raise ValueError(f"mask: strategy must be one of {STRATEGIES}, got {strategy!r}")
    return df.select(*[hide(col(c)).alias(c) if c in wanted else col(c) for c in df.columns])


def _key(df: DataFrame, key: str | Column | None, secret_ref: str | None, who: str) -> Column:
    if (key is None) == (secret_ref is None):
        raise ValueError(f"{who} needs a key: give secret_ref, or key")
    if secret_ref is not None:
        return secret(df.sparkSession, secret_ref)
    return key if isinstance(key, Column) else F.lit(key)


def unmask(
    df: DataFrame, columns: str | Iterable[str], key: str | Column | None = None, secret_ref: str | None = None
) -> DataFrame:
    """Reverse of ``mask(strategy="encrypt")``; the columns come back as text."""
    wanted = names(columns)
    require_columns(df, wanted, "unmask")
    value = _key(df, key, secret_ref, "unmask")
    return df.select(
        *[
            F.aes_decrypt(F.unbase64(col(c)), value, F.lit("GCM")).cast("string").alias(c)
            if c in wanted
            else col(c)
            for c in df.columns
        ]
    )


def token_vault(df: DataFrame, column: str, salt: str) -> DataFrame:
    """``(token, value)`` once per distinct value: the table that makes tokens reversible."""
    require_columns(df, [column], "token_vault")
    value = _text(col(column))
    return (
        df.filter(col(column).isNotNull())
        .select(value.alias("value"))
        .distinct()
        .select(token(F.col("value"), salt).alias("token"), "value")
    )


def detokenize(df: DataFrame, column: str, vault: DataFrame) -> DataFrame:
    """Swap tokens back for the vault's values; tokens the vault lacks become null.

    The vault holds each token once, so this is a plain left join whose left side
    adaptive execution can split when one token is hot.
    """
    require_columns(df, [column], "detokenize")
    found = vault.alias("vault")
    joined = df.alias("base").join(found, col(column, "base") == F.col("vault.token"), "left")
    return joined.select(
        *[F.col("vault.value").alias(c) if c == column else col(c, "base").alias(c) for c in df.columns]
    )


def record_hash(df: DataFrame, columns: str | Iterable[str] | None = None, output: str = "record_hash") -> DataFrame:
    """Correlation hash per row: SHA-256 of the row's JSON over ``columns`` (default all)."""
    picked = names(columns) or df.columns
    require_columns(df, picked, "record_hash")
    return df.withColumn(output, F.sha2(F.to_json(F.struct(*[col(c) for c in picked])), 256))
