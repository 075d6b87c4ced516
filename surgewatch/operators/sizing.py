"""Measured bounds that decide whether a small side may be broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if it was counted to be below both.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

ROW_OVERHEAD = 64  # bytes per row beside its text


def text_bytes(columns: Sequence[str]) -> Column:
    """Bytes one row takes: its text columns and a fixed overhead."""
    total = F.lit(ROW_OVERHEAD)
    for name in columns:
        total = total + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return total


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Count a side, looking at no more than ``max_rows + 1`` of its rows."""
    row = (
        df.select(text_bytes(df.columns).alias("b"))
        .limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b"))
        .first()
    )
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes
