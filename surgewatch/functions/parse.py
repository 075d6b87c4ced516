"""Access-log lines to ``(ip, url)``, as column expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAB = "\t"
LITERAL_TAB = r"\t"  # a backslash followed by the letter t

# Fixed value: what both fields hold when a line cannot be split.
MALFORMED = "error"


def _fields(line: Column, delimiter: str) -> tuple[Column, Column, Column]:
    """First field, second field, and whether the line has two fields.

    Empty fields at the end of a line do not count, so a line is good only if
    some field after the first one is not empty. Splitting stops after the
    second delimiter; the rest is looked at only if the second field is empty.
    """
    text = F.replace(line, F.lit("\n"), F.lit(""))
    parts = F.split(text, re.escape(delimiter), 3)
    second = F.get(parts, F.lit(1))
    rest = F.replace(F.get(parts, F.lit(2)), F.lit(delimiter), F.lit(""))
    good = F.coalesce((second != "") | (rest != ""), F.lit(False))
    return F.get(parts, F.lit(0)), second, good


def is_malformed(line: Column, delimiter: str = TAB) -> Column:
    """True where the line has no two fields (NULL lines included)."""
    return ~_fields(line, delimiter)[2]


def parse_lines(
    lines: DataFrame,
    delimiter: str = TAB,
    line_col: str = "line",
    drop_malformed: bool = False,
    metric: str | None = None,
) -> DataFrame:
    """Replace the line column by ``ip`` and ``url``; keep all other columns.

    A malformed line stays in the result as ``('error', 'error')`` unless
    ``drop_malformed`` is set. ``metric`` names an observation that reports
    the number of lines and of malformed lines without a second pass.
    """
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    line = F.col(line_col)
    first, second, good = _fields(line, delimiter)
    if metric:
        lines = lines.observe(
            metric,
            F.count(F.lit(1)).alias("lines"),
            F.count_if(~good).alias("malformed"),
        )
    if drop_malformed:
        lines = lines.where(good)
    others = [c for c in lines.columns if c != line_col]
    return lines.select(
        F.when(good, first).otherwise(MALFORMED).alias("ip"),
        F.when(good, second).otherwise(MALFORMED).alias("url"),
        *others,
    )


def malformed_counts(
    lines: DataFrame, delimiter: str = TAB, line_col: str = "line"
) -> DataFrame:
    """One row: how many lines there are and how many are malformed."""
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(is_malformed(F.col(line_col), delimiter)).alias("malformed"),
    )
