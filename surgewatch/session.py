"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Needed by every stream started here: windows are aligned to UTC, and the
# keyed state of the temporal join must live in RocksDB. Changelog
# checkpointing uploads only what a micro-batch changed.
STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "surgewatch",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution and the streaming settings on.

    The number of shuffle partitions is left to the cluster's configuration
    (AQE coalesces it in batch); pass it in ``conf`` for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STREAM_CONF,
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set SQL options for a block and put the old values back after it.

    A stream copies the session's options when it starts, so a stream started
    inside the block keeps them for its whole life.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Only where that setting is absent and the master is local (tests) is a
    temporary folder of this machine used; on a cluster its absence is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="surgewatch-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tasks among which a stream deals out the rows of one url. State is kept by
#: salt, so this does not depend on the session; jobs keep it beside their
#: checkpoint (``streaming.jobs.run_temporal``).
SALTS = 16
