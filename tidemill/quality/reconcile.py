"""Currency reconciliation: the booked base amount must be the transaction amount times the rate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col, require_columns

#: The documented conversion rates; equal currencies convert at 1.
RATES: dict[tuple[str, str], str] = {
    ("USD", "GBP"): "1.2",
    ("USD", "EUR"): "1.5",
    ("GBP", "EUR"): "0.9",
}


def rate_of(txn_ccy: Column, base_ccy: Column, rates: Mapping[tuple[str, str], str] = RATES) -> Column:
    """Rate as a decimal, null for a pair without one. A literal map: no join, no shuffle."""
    entries = [x for (a, b), r in rates.items() for x in (F.lit(f"{a}>{b}"), F.lit(r).cast("decimal(9,5)"))]
    table = F.create_map(*entries)
    found = F.try_element_at(table, F.concat(txn_ccy, F.lit(">"), base_ccy))
    return F.when(txn_ccy == base_ccy, F.lit("1").cast("decimal(9,5)")).otherwise(found)


def fx_reconcile(
    df: DataFrame,
    txn_amount: str = "txn_amt",
    base_amount: str = "base_amt",
    txn_ccy: str = "txn_ccy",
    base_ccy: str = "base_ccy",
    tolerance: str = "0.001",
    rates: Mapping[tuple[str, str], str] = RATES,
) -> DataFrame:
    """Adds ``expected_amt`` (five decimals) and ``reconciled``; a pair without a rate fails."""
    require_columns(df, [txn_amount, base_amount, txn_ccy, base_ccy], "fx_reconcile")
    amount = col(txn_amount).cast("decimal(31,5)")
    expected = F.round(amount * rate_of(col(txn_ccy), col(base_ccy), rates), 5).cast("decimal(31,5)")
    gap = F.abs(col(base_amount).cast("decimal(31,5)") - F.col("expected_amt"))
    return df.withColumn("expected_amt", expected).withColumn(
        "reconciled", F.coalesce(gap <= F.lit(tolerance).cast("decimal(31,5)"), F.lit(False))
    )
