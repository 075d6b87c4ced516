"""The four jobs end to end: read, parse, count, compare, write."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from surgewatch.functions.parse import parse_lines
from surgewatch.functions.timeattr import with_event_time, with_processing_time, with_watermark
from surgewatch.params import (
    FixedThresholdParams,
    HopTemporalParams,
    JobParams,
    LookupParams,
    TemporalParams,
)
from surgewatch.plans import alerts
from surgewatch.session import SALTS, STREAM_CONF, session_conf
from surgewatch.sources import table_replay
from surgewatch.sources.dims import read_dim_changes, read_dim_jdbc
from surgewatch.sources.logs import read_logs
from surgewatch.sources.positions import StartPosition, pinned, pinned_start, start_at
from surgewatch.streaming.heartbeat import clock, with_heartbeat
from surgewatch.streaming.sinks import write_alerts
from surgewatch.streaming.snapshot import SnapshotCache
from surgewatch.streaming.temporal import BUCKET_SECONDS


@dataclass(frozen=True)
class Endpoint:
    """A connector: format, options, and the option that takes a stream name.

    ``time_col`` names the column with the record's own time; without it the
    processing time is used. ``delay`` is how late such a time may be. A
    connector with a start position of its own gets it by ``position_option``
    and ``timestamp_option``.
    """

    fmt: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    name_option: str | None = None
    schema: str | None = None
    payload_col: str = "value"
    time_col: str | None = None
    delay: str = "0 seconds"
    position_option: str | None = None
    timestamp_option: str | None = None
    parameters: Mapping[str, str] = field(default_factory=dict)

    def named(self, name: str, kafka_option: str, given: Mapping[str, str]) -> dict[str, str]:
        """The connector's options: the stream's name, parameters of the job, and its own, which count most.

        ``parameters`` names the connector's options for those parameters of a
        job that only connectors understand; it gets no others.
        """
        option = self.name_option or (kafka_option if self.fmt == "kafka" else "path")
        passed = {self.parameters[k]: v for k, v in given.items() if k in self.parameters}
        return {option: name, **passed, **self.options}

    @property
    def start_options(self) -> dict[str, str | None]:
        """Names of the connector's options for the start position, for ``read_records``."""
        return {"position_option": self.position_option, "timestamp_option": self.timestamp_option}

    @property
    def filtered(self) -> bool:
        """Whether the start position is a filter on the time column."""
        own = self.fmt in ("kafka", table_replay.NAME) or self.position_option is not None
        return self.time_col is not None and not own


def _job(run: Callable[..., StreamingQuery]) -> Callable[..., StreamingQuery]:
    """Build and start a job with the stream settings: zone-less times are UTC."""

    @wraps(run)
    def with_settings(spark: SparkSession, *args: object, **options: object) -> StreamingQuery:
        with session_conf(spark, STREAM_CONF):
            return run(spark, *args, **options)

    return with_settings


def _source(
    spark: SparkSession, params: JobParams, source: Endpoint, checkpoint: str
) -> DataFrame:
    start = params.stream_init_position, params.stream_initial_timestamp
    if source.filtered:
        start = pinned_start(spark, start[0], f"{checkpoint}-start") or start
    lines = read_logs(
        spark,
        source.fmt,
        source.named(params.input_stream_name, "subscribe", params.connector),
        payload_col=source.payload_col,
        time_col=source.time_col,
        schema=source.schema,
        position=start[0],
        timestamp=start[1],
        **source.start_options,
    )
    logs = parse_lines(lines, params.delimiter, metric="log_lines")
    return with_event_time(logs, "ts") if source.time_col else with_processing_time(logs)


def _logs(
    spark: SparkSession,
    params: JobParams,
    source: Endpoint,
    checkpoint: str,
    beats: DataFrame | None,
) -> DataFrame:
    logs = _source(spark, params, source, checkpoint)
    if beats is None and source.time_col:
        # Recorded times may be long past: the clock would make all rows late.
        return logs
    return with_heartbeat(logs, clock(spark) if beats is None else beats)


def _changes(
    spark: SparkSession, params: TemporalParams, dim: Endpoint, checkpoint: str
) -> DataFrame:
    position, pinned = params.dim_stream_init_position, None
    if dim.filtered:
        pinned = pinned_start(spark, position, f"{checkpoint}-start-changes")
    changes = read_dim_changes(
        spark,
        dim.fmt,
        dim.named(params.dim_stream_name, "subscribe", params.connector),
        payload_col=dim.payload_col,
        time_col=dim.time_col,
        schema=dim.schema,
        position=StartPosition.TRIM_HORIZON if pinned else position,
        **dim.start_options,
    )
    return start_at(changes, *pinned, time_col="proc_time") if pinned else changes


def _start(
    rows: DataFrame,
    params: JobParams,
    sink: Endpoint,
    checkpoint: str,
    name: str,
    write_options: Mapping[str, object],
) -> StreamingQuery:
    target = sink.named(params.target_stream_name, "topic", params.connector)
    return write_alerts(rows, sink.fmt, checkpoint, target, name=name, **write_options)


def _kept(spark: SparkSession, name: str, value: int | None, default: int, checkpoint: str) -> int:
    """A number that state belongs to: the one of the first start, kept beside the checkpoint."""
    kept = int(pinned(spark, str(value or default), f"{checkpoint}-{name}"))
    if value not in (None, kept):
        raise ValueError(f"this checkpoint was made with {name}={kept}, not {value}")
    return kept


@_job
def run_fixed_threshold(
    spark: SparkSession,
    params: FixedThresholdParams,
    source: Endpoint,
    sink: Endpoint,
    checkpoint: str,
    beats: DataFrame | None = None,
    name: str = "fixed-threshold-alerts",
    **write_options: object,
) -> StreamingQuery:
    """Start the job with one threshold for all urls.

    With processing time a clock closes the windows of a quiet stream. With
    event times (``source.time_col``) a window closes when newer rows arrive;
    pass ``beats`` (such as ``heartbeat.clock`` with a lag) to close it sooner.
    ``write_options`` go to ``write_alerts``.
    """
    logs = with_watermark(_logs(spark, params, source, checkpoint, beats), delay=source.delay)
    rows = alerts.fixed_threshold_alerts(logs, params.window_size, params.trigger_value)
    return _start(rows, params, sink, checkpoint, name, write_options)


@_job
def run_lookup(
    spark: SparkSession,
    params: LookupParams,
    source: Endpoint,
    sink: Endpoint,
    checkpoint: str,
    beats: DataFrame | None = None,
    jdbc_options: Mapping[str, str] | None = None,
    name: str = "lookup-alerts",
    **write_options: object,
) -> StreamingQuery:
    """Start the job with thresholds from a JDBC table.

    The table is read by every micro-batch, or kept for ``cache_ttl`` if it
    has at most ``cache_maxrows`` rows.
    """
    dim = read_dim_jdbc(
        spark,
        params.mysql_host,
        params.mysql_table,
        params.mysql_user,
        params.mysql_password,
        jdbc_options,
    )
    cache = SnapshotCache(dim, params.cache_ttl, params.cache_maxrows)
    cache.refresh()
    logs = with_watermark(_logs(spark, params, source, checkpoint, beats), delay=source.delay)
    salts = None if cache.kept else SALTS
    rows = alerts.lookup_alerts(logs, cache.table, params.window_size, salts=salts)
    query = _start(rows, params, sink, checkpoint, name, write_options)
    cache.keep_fresh(query)
    return query


@_job
def run_temporal(
    spark: SparkSession,
    params: TemporalParams,
    source: Endpoint,
    dim: Endpoint,
    sink: Endpoint,
    checkpoint: str,
    beats: DataFrame | None = None,
    salts: int | None = None,
    bucket_seconds: int | None = None,
    initial: DataFrame | None = None,
    name: str | None = None,
    **write_options: object,
) -> StreamingQuery:
    """Start the job with thresholds from a change stream; windows hop if the
    parameters have a ``window_interval``.

    ``source.delay`` and ``dim.delay`` are how late either stream's times may
    be. The numbers of salts and of seconds per bucket of waiting requests are
    kept beside the checkpoint, since state belongs to them; other numbers at a
    later start are an error. With event times and no ``beats``, results wait
    until both streams have passed them. ``initial`` is a table of thresholds
    known before the first start (``url, trigger_value[, proc_time, seq]``, as
    from ``operators.dims.latest_per_key``): without it, requests before a
    url's first change in the stream are dropped.
    """
    kept = _kept(spark, "salts", salts, SALTS, checkpoint)
    width = _kept(spark, "bucket_seconds", bucket_seconds, BUCKET_SECONDS, checkpoint)
    logs = _logs(spark, params, source, checkpoint, beats)
    changes = _changes(spark, params, dim, checkpoint)
    join = {
        "salts": kept,
        "delay": source.delay,
        "change_delay": dim.delay,
        "bucket_seconds": width,
        "initial": initial,
    }
    if isinstance(params, HopTemporalParams):
        name = name or "hop-temporal-alerts"
        rows = alerts.hop_temporal_alerts(
            logs, changes, params.window_size, params.window_interval, **join
        )
    else:
        name = name or "temporal-alerts"
        rows = alerts.temporal_alerts(logs, changes, params.window_size, **join)
    return _start(rows, params, sink, checkpoint, name, write_options)
