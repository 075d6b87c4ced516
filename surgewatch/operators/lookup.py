"""Per-url thresholds from a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.operators.sizing import MAX_BROADCAST_ROWS, fits_broadcast
from surgewatch.operators.windows import tumble_counts


# The column that tells the copies of a table row apart.
SALT = "_dim_salt"


def _copies(dim: DataFrame, salts: int) -> DataFrame:
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return dim.select("*", every).withColumn(SALT, F.col("col").alias(SALT, metadata={"salts": salts})).drop("col")


def salted(dim: DataFrame, salts: int) -> DataFrame:
    """``dim`` as a stream's join with ``salts`` needs it: copied, dealt out and sorted.

    Persist it while the stream runs. Each micro-batch sees the table as it was then.
    """
    partitions = int(dim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _copies(dim.select(F.col("url").alias("dim_url"), "trigger_value"), salts)
    return rows.repartition(partitions, "dim_url", SALT).sortWithinPartitions("dim_url", SALT)


def lookup_join(
    logs: DataFrame,
    dim: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Inner join on ``url``: log columns, ``trigger_value`` and ``dim_url``.

    The url need not be unique in ``dim``: each match gives a row. A table
    counted to be small is broadcast and the log is not shuffled; a larger one
    is joined by shuffling, where adaptive execution splits popular urls.

    On a stream every micro-batch reads ``dim`` anew. There the plan is fixed
    while the table may grow, so no hint is given: Spark broadcasts by the
    table's measured size (see ``streaming.snapshot``) or by its statistics.
    With ``salts`` the log rows of a url are dealt out to so many keys and each
    table row is copied to all of them, so that a popular url keeps many tasks
    busy; give it where the table is too large to broadcast. ``salted`` makes
    those copies ahead, to be persisted and given as ``dim`` with the same
    ``salts``; the table is then neither read nor shuffled by each micro-batch.
    """
    copied = SALT in dim.columns
    if copied and not (logs.isStreaming and dim.schema[SALT].metadata.get("salts") == salts):
        raise ValueError("a salted table is joined to a stream, with its number of salts")
    if not copied:
        dim = dim.select(F.col("url").alias("dim_url"), "trigger_value")
    if not logs.isStreaming and fits_broadcast(dim, max_rows):
        dim = F.broadcast(dim)
    matching = F.col("url") == F.col("dim_url")
    columns = [*logs.columns, "trigger_value", "dim_url"]
    if logs.isStreaming and salts:
        # Seeded, so by position in the scan: equal when a lost task is run again.
        logs = logs.withColumn("_salt", F.floor(F.rand(7) * salts).cast("int"))
        dim = dim if copied else _copies(dim, salts)
        matching = matching & (F.col("_salt") == F.col(SALT))
    return logs.join(dim, matching).select(*columns)


def lookup_counts(
    logs: DataFrame,
    dim: DataFrame,
    window_size: int,
    time_col: str = "ts",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Requests per window, ip, url and threshold of the matching rows.

    Joining first and counting after gives, per window, ip, url and threshold,
    the number of requests times the number of table rows with that url and
    threshold. In batch this is what is computed: the log shrinks to its
    counts before any join, and a popular url needs no special care.

    On a stream the row's own micro-batch decides which threshold it sees, so
    there the join comes first (for ``buckets`` see ``windows.tumble_counts``).
    """
    if logs.isStreaming:
        joined = lookup_join(logs, dim, max_rows, salts)
        return tumble_counts(joined, window_size, time_col, ("ip", "url", "trigger_value"), buckets)
    copies = dim.groupBy(F.col("url").alias("dim_url"), "trigger_value").agg(
        F.count(F.lit(1)).alias("copies")
    )
    if fits_broadcast(dim.select("url", "trigger_value"), max_rows):
        copies = F.broadcast(copies)
    counts = tumble_counts(logs, window_size, time_col)
    joined = counts.join(copies, F.col("url") == F.col("dim_url"))
    return joined.select(
        "ip",
        "url",
        "trigger_value",
        (F.col("times") * F.col("copies")).alias("times"),
        "window_start",
        "window_end",
    )
