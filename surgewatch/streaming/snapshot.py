"""A lookup table kept in memory for a limited time while a stream joins it."""

from __future__ import annotations

import logging
import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

log = logging.getLogger(__name__)


class SnapshotCache:
    """Persist a lookup table and read it again when the copy gets too old.

    A stream that joins ``table`` plans each micro-batch anew and takes the
    persisted copy wherever there is one. The copy's size is known exactly, so
    Spark broadcasts it if it is below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles otherwise; this holds for every new copy.

    There are two generations while the table is read again: the old copy
    answers until the new one is complete, and stays if the read fails. Rows
    are counted by the read that makes the copy.

    A table with more than ``max_rows`` rows is not kept: it is read by each
    micro-batch. A time to live of 0 means that as well.
    """

    def __init__(self, dim: DataFrame, ttl_seconds: float, max_rows: int | None = None) -> None:
        if ttl_seconds < 0 or (max_rows is not None and max_rows < 0):
            raise ValueError("ttl_seconds and max_rows must not be negative")
        self.dim = dim
        #: What to join: another plan over ``dim``, so that both can have a copy of their own.
        self.table = dim.where(F.lit(True))
        self.ttl_seconds = ttl_seconds
        self.max_rows = max_rows
        self.loaded_at: float | None = None
        self._outgrown = False

    @property
    def kept(self) -> bool:
        """Whether there is a copy in memory."""
        return self.dim.storageLevel.useMemory or self.table.storageLevel.useMemory

    def refresh(self) -> None:
        """Read the table now. If that fails, the copy there was is kept, and the error raised."""
        if self.ttl_seconds == 0:
            self.release()
            return
        if self.dim.storageLevel.useMemory:
            # The old generation: a copy of the copy, which outlives it.
            self.table.persist().count()
            self.dim.unpersist()
        try:
            kept = self._read()
        except Exception:
            self.dim.unpersist()
            raise
        if not kept:
            self.dim.unpersist()
        self.table.unpersist()
        self.loaded_at = time.monotonic()

    def _read(self) -> bool:
        """Copy the table; False if it has too many rows."""
        if self._outgrown and self.dim.limit(self.max_rows + 1).count() > self.max_rows:
            return False
        rows = self.dim.persist().count()
        self._outgrown = self.max_rows is not None and rows > self.max_rows
        return not self._outgrown

    def refresh_if_stale(self) -> bool:
        """Read the table if the copy is older than its time to live."""
        if self.loaded_at is not None and time.monotonic() - self.loaded_at < self.ttl_seconds:
            return False
        self.refresh()
        return True

    def release(self) -> None:
        """Give the copy up; micro-batches then read the table itself."""
        self.dim.unpersist()
        self.table.unpersist()
        self.loaded_at = None

    def keep_fresh(self, query: StreamingQuery) -> None:
        """Refresh in the background for as long as the query runs."""
        if self.ttl_seconds == 0:
            return
        threading.Thread(target=self._watch, args=(query,), daemon=True).start()

    def _watch(self, query: StreamingQuery) -> None:
        while True:
            try:
                if query.awaitTermination(max(1, int(self.ttl_seconds))):
                    break
            except Exception:  # the query failed; its owner gets the error
                break
            try:
                self.refresh_if_stale()
            except Exception as error:
                log.warning("lookup table not refreshed: %s", type(error).__name__)
        self.release()
