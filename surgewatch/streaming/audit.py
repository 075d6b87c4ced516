"""What a stream keeps: its state, read from the checkpoint as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.session import STREAM_CONF, session_conf


def read_state(
    spark: SparkSession, checkpoint: str, variable: str | None = None, operator: int = 0
) -> DataFrame:
    """State rows as of the last finished micro-batch; ``key``, ``partition_id`` and values.

    ``operator`` is the number of a stateful operator (see ``operators``).
    Operators with state of their own (``transformWithState``) are read by the
    name of a ``variable``; entries of lists and maps are rows. The job should
    not be running, or the state may be gone while it is read.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable is not None:
        reader = reader.option("stateVarName", variable).option("flattenCollectionTypes", "true")
    with session_conf(spark, STREAM_CONF):
        return reader.load(checkpoint)


def operators(spark: SparkSession, checkpoint: str) -> dict[int, str]:
    """Names of the stream's stateful operators by number."""
    rows = spark.read.format("state-metadata").load(checkpoint)
    return {r.operatorId: r.operatorName for r in rows.select("operatorId", "operatorName").distinct().collect()}


def _join_state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """State of the as-of join, the one operator of a temporal job with variables."""
    number = [n for n, name in operators(spark, checkpoint).items() if name.startswith("transformWithState")]
    return read_state(spark, checkpoint, variable, number[0])


def threshold_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Per url, of a temporal job: its keys (one per salt) and the fewest and most thresholds of a key."""
    rows = _join_state(spark, checkpoint, "changes")
    kept = rows.groupBy("key.url", "key.salt").agg(F.sum(F.size("list_element.at")).alias("n"))
    return kept.groupBy("url").agg(
        F.count(F.lit(1)).alias("salts"), F.min("n").alias("fewest"), F.max("n").alias("most")
    )


def waiting_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Requests of a temporal job that wait for their threshold, per url and time bucket."""
    rows = _join_state(spark, checkpoint, "waiting")
    return rows.groupBy("key.url", "user_map_key.bucket").agg(
        F.sum(F.aggregate("user_map_value.hits", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("hits")
    )
