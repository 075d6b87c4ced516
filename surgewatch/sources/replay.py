"""Logs, raw lines and thresholds derived from tables of recorded events.

Used to replay a recorded table as if it were an access log, and to check the
jobs against a reference result on the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (id, trigger_value, url) of the lookup table for event logs.
# One url has two thresholds, and not every url has one.
LOOKUP_ROWS = [(1, 3, "click"), (2, 2, "error"), (3, 5, "purchase"), (4, 2, "purchase")]

# The urls whose thresholds the change stream of event logs sets.
CHANGED_URLS = ["click", "error", "purchase", "signup", "view"]


def event_logs(events: DataFrame) -> DataFrame:
    """``ip, url, ts`` from the events table."""
    return events.select(
        F.col("user_id").cast("string").alias("ip"), F.col("event_type").alias("url"), "ts"
    )


def lookup_table(spark: SparkSession) -> DataFrame:
    """The small lookup table for event logs; its url is not unique."""
    rows = ", ".join(f"({n}, {value}, '{url}')" for n, value, url in LOOKUP_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, trigger_value, url)")


def event_changes(events: DataFrame) -> DataFrame:
    """``url, trigger_value, proc_time, seq``: each signup sets one threshold."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    urls = F.array(*[F.lit(u) for u in CHANGED_URLS])
    return events.where("event_type = 'signup'").select(
        F.get(urls, (k % len(CHANGED_URLS)).cast("int")).alias("url"),
        (k % 3 + 1).cast("string").alias("trigger_value"),
        F.col("ts").alias("proc_time"),
        F.col("event_id").alias("seq"),
    )


def event_thresholds(events: DataFrame) -> DataFrame:
    """``url, trigger_value``: a threshold of each url that holds before its first change."""
    counts = events.groupBy(F.col("event_type").alias("url")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("url", (F.col("n") % 3 + 1).cast("string").alias("trigger_value"))


def event_change_json(events: DataFrame) -> DataFrame:
    """``value, proc_time, seq``: changes as JSON, some of them damaged."""
    changes = event_changes(events)
    url, value, damage = F.col("url"), F.col("trigger_value"), F.col("seq") % 10
    text = (
        F.when(damage == 1, F.concat(F.lit("not json "), url))
        .when(damage == 2, F.concat(F.lit('{"url":"'), url, F.lit('"}')))
        .when(damage == 3, F.concat(F.lit('{"url":"'), url, F.lit('","trigger_value":"many"}')))
        .otherwise(
            F.concat(F.lit('{"url":"'), url, F.lit('","trigger_value":'), value, F.lit("}"))
        )
    )
    return changes.select(text.alias("value"), "proc_time", "seq")


def _raw(cases: dict[int, Column], other: Column) -> Column:
    kind = F.col("event_id") % 50
    text = None
    for number, line in cases.items():
        text = F.when(kind == number, line) if text is None else text.when(kind == number, line)
    return text.otherwise(other)


def raw_lines_tab(events: DataFrame) -> DataFrame:
    """``event_id, line`` with TAB-separated fields; some lines are malformed."""
    ip, url, tab = F.col("user_id").cast("string"), F.col("event_type"), F.lit("\t")
    cases = {0: ip, 1: F.concat(ip, tab), 2: F.concat(ip, tab, tab, url)}
    other = F.concat(ip, tab, url, F.lit("\n"), tab, F.col("event_id").cast("string"))
    return events.select("event_id", _raw(cases, other).alias("line"))


def raw_lines_literal(events: DataFrame) -> DataFrame:
    """``event_id, line`` with fields separated by a backslash and a ``t``."""
    ip, url, mark = F.col("user_id").cast("string"), F.col("event_type"), F.lit(r"\t")
    cases = {
        0: ip,
        1: F.concat(ip, mark),
        2: F.concat(ip, mark, mark, url),
        3: F.concat(ip, F.lit("t"), mark),
    }
    other = F.concat(ip, mark, url, F.lit("\n"))
    return events.select("event_id", _raw(cases, other).alias("line"))


def order_logs(lineitem: DataFrame) -> DataFrame:
    """``ip, url, ts`` from order lines: suppliers asking for parts."""
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("ip"),
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("url"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
    )


def order_changes(lineitem: DataFrame) -> DataFrame:
    """``url, trigger_value, proc_time, seq``: a returned line sets its part's
    threshold. Changes have whole days, so many fall on the same instant."""
    return lineitem.where("l_returnflag = 'R'").select(
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("url"),
        (F.col("l_linenumber") % 3 + 1).cast("string").alias("trigger_value"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("proc_time"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def part_thresholds(part: DataFrame) -> DataFrame:
    """``id, trigger_value, url``: a lookup table that grows with the data."""
    return part.select(
        F.col("p_partkey").alias("id"),
        (F.col("p_size") % 3 + 1).cast("int").alias("trigger_value"),
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("url"),
    )
