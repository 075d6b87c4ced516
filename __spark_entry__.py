"""

Every query runs over whole tables. ``events`` and ``lineitem`` are replayed
as access logs (see ``surgewatch.sources.replay``); windows are hours or a
year long because the tables span a month and seven years.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgewatch.functions.jsonio import alert_json, parse_changes
from surgewatch.functions.parse import LITERAL_TAB, TAB, malformed_counts, parse_lines
from surgewatch.functions.thresholds import as_number, at_least
from surgewatch.functions.timeattr import with_processing_time, with_watermark
from surgewatch.operators.dims import latest_per_key, versions
from surgewatch.operators.lookup import lookup_counts, lookup_join, salted
from surgewatch.operators.temporal import temporal_join
from surgewatch.operators.windows import hop_counts, tumble_counts
from surgewatch.plans import alerts
from surgewatch.sources import replay
from surgewatch.sources.positions import start_at
from surgewatch.streaming.replay import replay_alerts, replay_clocked, replay_latest
from surgewatch.streaming.windowed import BUCKETS

SIZE, SLIDE = 21600, 7200
YEAR = 31_536_000
START = "2024-01-15 00:00:00"


# Schemas of the tables read here, so that none is inferred.
SCHEMAS = {
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.event_logs(_events(spark, sf_dir))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.event_changes(_events(spark, sf_dir))


def _order_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.order_logs(_table(spark, sf_dir, "lineitem"))


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.order_changes(_table(spark, sf_dir, "lineitem"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.part_thresholds(_table(spark, sf_dir, "part"))


def entry(spark: SparkSession) -> DataFrame:
    """Clients that asked for the same url at least twice in six hours."""
    return alerts.fixed_threshold_alerts(_logs(spark, "/root/testdata/sf0.001"), SIZE, 2)


# --- one query per operator -------------------------------------------------


def source_scan(spark, sf_dir):
    return _logs(spark, sf_dir)


def start_at_timestamp(spark, sf_dir):
    return start_at(_logs(spark, sf_dir), "AT_TIMESTAMP", START)


def parse_lines_tab(spark, sf_dir):
    return parse_lines(replay.raw_lines_tab(_events(spark, sf_dir)), TAB)


def parse_lines_literal(spark, sf_dir):
    return parse_lines(replay.raw_lines_literal(_events(spark, sf_dir)), LITERAL_TAB)


def malformed_counts_tab(spark, sf_dir):
    return malformed_counts(replay.raw_lines_tab(_events(spark, sf_dir)), TAB)


def dim_changes_parse(spark, sf_dir):
    return parse_changes(replay.event_change_json(_events(spark, sf_dir)))


def processing_time(spark, sf_dir):
    """Each row, and whether its stamp is a time from now on."""
    stamped = with_processing_time(_logs(spark, sf_dir).drop("ts"))
    now = F.lit(datetime.now(timezone.utc))
    return stamped.select("ip", "url", F.col("ts").between(now, now + F.expr("interval 1 day")).alias("is_now"))


def temporal_join_bootstrap(spark, sf_dir):
    known = replay.event_thresholds(_events(spark, sf_dir))
    return temporal_join(_logs(spark, sf_dir), _changes(spark, sf_dir), initial=known)


def dim_latest(spark, sf_dir):
    return latest_per_key(_changes(spark, sf_dir))


def dim_latest_parts(spark, sf_dir):
    return latest_per_key(_order_changes(spark, sf_dir))


def dim_versions(spark, sf_dir):
    return versions(_changes(spark, sf_dir))


def dim_versions_parts(spark, sf_dir):
    return versions(_order_changes(spark, sf_dir), slice_seconds=YEAR)


def lookup_join_rows(spark, sf_dir):
    return lookup_join(_logs(spark, sf_dir), replay.lookup_table(spark))


def lookup_join_parts(spark, sf_dir):
    return lookup_join(_order_logs(spark, sf_dir), _parts(spark, sf_dir))


def temporal_join_rows(spark, sf_dir):
    return temporal_join(_logs(spark, sf_dir), _changes(spark, sf_dir))


def temporal_join_sorted(spark, sf_dir):
    return temporal_join(_logs(spark, sf_dir), _changes(spark, sf_dir), strategy="sorted")


def temporal_join_parts(spark, sf_dir):
    return temporal_join(_order_logs(spark, sf_dir), _order_changes(spark, sf_dir))


def tumble_counts_rows(spark, sf_dir):
    return tumble_counts(_logs(spark, sf_dir), SIZE)


def tumble_counts_by_threshold(spark, sf_dir):
    return lookup_counts(_logs(spark, sf_dir), replay.lookup_table(spark), SIZE)


def hop_counts_by_threshold(spark, sf_dir):
    joined = temporal_join(_logs(spark, sf_dir), _changes(spark, sf_dir))
    return hop_counts(joined, SIZE, SLIDE, keys=alerts.THRESHOLD_KEYS)


def hop_counts_panes(spark, sf_dir):
    return hop_counts(_logs(spark, sf_dir), 36_000, 7200)


def threshold_coercion(spark, sf_dir):
    changes = parse_changes(replay.event_change_json(_events(spark, sf_dir)))
    counts = changes.groupBy("url", "trigger_value").agg(F.count(F.lit(1)).alias("times"))
    return at_least(counts, as_number(F.col("trigger_value")))


# --- the four jobs ----------------------------------------------------------


def fixed_threshold_alerts(spark, sf_dir):
    return alerts.fixed_threshold_alerts(_logs(spark, sf_dir), SIZE, 2)


def lookup_alerts(spark, sf_dir):
    return alerts.lookup_alerts(_logs(spark, sf_dir), replay.lookup_table(spark), SIZE)


def lookup_alerts_parts(spark, sf_dir):
    return alerts.lookup_alerts(_order_logs(spark, sf_dir), _parts(spark, sf_dir), YEAR)


def temporal_alerts(spark, sf_dir):
    return alerts.temporal_alerts(_logs(spark, sf_dir), _changes(spark, sf_dir), SIZE)


def temporal_alerts_parts(spark, sf_dir):
    logs, changes = _order_logs(spark, sf_dir), _order_changes(spark, sf_dir)
    return alerts.temporal_alerts(logs, changes, YEAR)


def hop_temporal_alerts(spark, sf_dir):
    logs, changes = _logs(spark, sf_dir), _changes(spark, sf_dir)
    return alerts.hop_temporal_alerts(logs, changes, SIZE, SLIDE)


def alert_json_lookup(spark, sf_dir):
    return alert_json(lookup_alerts(spark, sf_dir))


# --- the four jobs as streams, over the whole table -------------------------


def _stream(spark, sf_dir, job, name="events", to_logs=replay.event_logs, size=SIZE, fmt="parquet"):
    path = f"{sf_dir}/{name}.parquet"
    return replay_alerts(spark, path, SCHEMAS[name], to_logs, job, size, files_per_trigger=1, fmt=fmt)


def _as_of_options(delay):
    # Recorded data is decided in few large steps: long buckets.
    return {"delay": delay, "change_delay": delay, "bucket_seconds": 4 * SIZE}


def stream_fixed_threshold_alerts(spark, sf_dir):
    def job(logs, events, delay):
        return alerts.fixed_threshold_alerts(with_watermark(logs, delay=delay), SIZE, 2, buckets=BUCKETS)

    return _stream(spark, sf_dir, job)


def stream_alert_table(spark, sf_dir):
    """The alerts of one threshold as JSON, from the table that takes each micro-batch once."""

    def job(logs, events, delay):
        return alerts.fixed_threshold_alerts(with_watermark(logs, delay=delay), SIZE, 2, buckets=BUCKETS)

    return _stream(spark, sf_dir, job, fmt="alert_table")


def stream_lookup_alerts(spark, sf_dir):
    def job(logs, events, delay):
        dim = replay.lookup_table(spark)
        return alerts.lookup_alerts(with_watermark(logs, delay=delay), dim, SIZE, buckets=BUCKETS)

    return _stream(spark, sf_dir, job)


def stream_lookup_alerts_parts(spark, sf_dir):
    # Kept for all micro-batches: the recorded table does not change.
    dim = salted(_parts(spark, sf_dir), 4).persist()

    def job(logs, lines, delay):
        return alerts.lookup_alerts(with_watermark(logs, delay=delay), dim, YEAR, salts=4, buckets=BUCKETS)

    try:
        return _stream(spark, sf_dir, job, "lineitem", replay.order_logs, YEAR)
    finally:
        dim.unpersist()


def stream_temporal_alerts(spark, sf_dir):
    def job(logs, events, delay):
        changes = replay.event_changes(events)
        return alerts.temporal_alerts(logs, changes, SIZE, **_as_of_options(delay))

    return _stream(spark, sf_dir, job)


def stream_bootstrap_alerts(spark, sf_dir):
    def job(logs, events, delay):
        changes, known = replay.event_changes(events), replay.event_thresholds(_events(spark, sf_dir))
        return alerts.temporal_alerts(logs, changes, SIZE, initial=known, **_as_of_options(delay))

    return _stream(spark, sf_dir, job)


def stream_hop_temporal_alerts(spark, sf_dir):
    def job(logs, events, delay):
        changes = replay.event_changes(events)
        return alerts.hop_temporal_alerts(logs, changes, SIZE, SLIDE, **_as_of_options(delay))

    return _stream(spark, sf_dir, job)


def stream_hop_counts_panes(spark, sf_dir):
    def job(logs, events, delay):
        return hop_counts(with_watermark(logs, delay=delay), 36_000, 7200, buckets=BUCKETS).where("times > 0")

    return _stream(spark, sf_dir, job, size=36_000)


def stream_dim_latest(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    return replay_latest(spark, path, SCHEMAS["events"], replay.event_changes, files_per_trigger=1)


def stream_dim_latest_parts(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    return replay_latest(spark, path, SCHEMAS["lineitem"], replay.order_changes, files_per_trigger=1)


def stream_processing_time_counts(spark, sf_dir):
    """Requests per client and url, added up over windows of processing time."""
    path = f"{sf_dir}/events.parquet"
    counts = replay_clocked(spark, path, SCHEMAS["events"], replay.event_logs, 2, files_per_trigger=1)
    return counts.groupBy("ip", "url").agg(F.sum("times").alias("times"))


# --- the optional subpackage ------------------------------------------------


def _optional(name: str):
    """A module that may have been removed, or that needs libraries which are not there."""
    try:
        return importlib.import_module(name)
    except ImportError:
        return None


_llm = _optional("surgewatch.llm.queries")
_pipeline = _llm and _optional("corpus_pipeline")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator and job."""
    more = dict(_llm.QUERIES) if _llm else {}
    if _pipeline:
        more["pipeline"] = _pipeline.run
    return {
        "source_scan": source_scan,
        "start_at_timestamp": start_at_timestamp,
        "parse_lines_tab": parse_lines_tab,
        "parse_lines_literal": parse_lines_literal,
        "malformed_counts": malformed_counts_tab,
        "dim_changes_parse": dim_changes_parse,
        "processing_time": processing_time,
        "dim_latest": dim_latest,
        "dim_latest_parts": dim_latest_parts,
        "dim_versions": dim_versions,
        "dim_versions_parts": dim_versions_parts,
        "lookup_join_rows": lookup_join_rows,
        "lookup_join_parts": lookup_join_parts,
        "temporal_join_rows": temporal_join_rows,
        "temporal_join_sorted": temporal_join_sorted,
        "temporal_join_parts": temporal_join_parts,
        "temporal_join_bootstrap": temporal_join_bootstrap,
        "tumble_counts": tumble_counts_rows,
        "tumble_counts_by_threshold": tumble_counts_by_threshold,
        "hop_counts": hop_counts_by_threshold,
        "hop_counts_panes": hop_counts_panes,
        "threshold_coercion": threshold_coercion,
        "fixed_threshold_alerts": fixed_threshold_alerts,
        "lookup_alerts": lookup_alerts,
        "lookup_alerts_parts": lookup_alerts_parts,
        "temporal_alerts": temporal_alerts,
        "temporal_alerts_parts": temporal_alerts_parts,
        "hop_temporal_alerts": hop_temporal_alerts,
        "alert_json": alert_json_lookup,
        "stream_fixed_threshold_alerts": stream_fixed_threshold_alerts,
        "stream_alert_table": stream_alert_table,
        "stream_lookup_alerts": stream_lookup_alerts,
        "stream_lookup_alerts_parts": stream_lookup_alerts_parts,
        "stream_temporal_alerts": stream_temporal_alerts,
        "stream_bootstrap_alerts": stream_bootstrap_alerts,
        "stream_hop_temporal_alerts": stream_hop_temporal_alerts,
        "stream_hop_counts_panes": stream_hop_counts_panes,
        "stream_dim_latest": stream_dim_latest,
        "stream_dim_latest_parts": stream_dim_latest_parts,
        "stream_processing_time_counts": stream_processing_time_counts,
        **more,
    }


# --- reference SQL ----------------------------------------------------------

_LOGS = "SELECT CAST(user_id AS VARCHAR) AS ip, event_type AS url, ts FROM events"

_LOOKUP = """SELECT * FROM (VALUES (1, 3, 'click'), (2, 2, 'error'), (3, 5, 'purchase'),
    (4, 2, 'purchase')) AS v(id, trigger_value, url)"""

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_CHANGES = f"""SELECT (['click', 'error', 'purchase', 'signup', 'view'])[{_K} % 5 + 1] AS url,
    CAST({_K} % 3 + 1 AS VARCHAR) AS trigger_value, ts AS proc_time, event_id AS seq
    FROM events WHERE event_type = 'signup'"""

_THRESHOLDS = """SELECT event_type AS url, CAST(count(*) % 3 + 1 AS VARCHAR) AS trigger_value,
    TIMESTAMP '1970-01-01' AS proc_time, CAST(0 AS BIGINT) AS seq FROM events GROUP BY event_type"""

_ORDER_LOGS = """SELECT CAST(l_suppkey AS VARCHAR) AS ip, 'part-' || l_partkey AS url,
    l_shipdate AS ts FROM lineitem"""

_ORDER_CHANGES = """SELECT 'part-' || l_partkey AS url,
    CAST(l_linenumber % 3 + 1 AS VARCHAR) AS trigger_value, l_shipdate AS proc_time,
    l_orderkey * 10 + l_linenumber AS seq FROM lineitem WHERE l_returnflag = 'R'"""

_PARTS = """SELECT p_partkey AS id, p_size % 3 + 1 AS trigger_value,
    'part-' || p_partkey AS url FROM part"""

_CHANGE_JSON = f"""SELECT CASE seq % 10
        WHEN 1 THEN 'not json ' || url
        WHEN 2 THEN '{{"url":"' || url || '"}}'
        WHEN 3 THEN '{{"url":"' || url || '","trigger_value":"many"}}'
        ELSE '{{"url":"' || url || '","trigger_value":' || trigger_value || '}}'
    END AS value, proc_time, seq FROM ({_CHANGES})"""

_PARSED_CHANGES = f"""SELECT
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.url') END AS url,
    CASE WHEN json_valid(value) THEN json_extract_string(value, '$.trigger_value') END
        AS trigger_value,
    proc_time, seq FROM ({_CHANGE_JSON})"""

_LINES_TAB = """SELECT event_id, CASE event_id % 50
        WHEN 0 THEN CAST(user_id AS VARCHAR)
        WHEN 1 THEN user_id || chr(9)
        WHEN 2 THEN user_id || chr(9) || chr(9) || event_type
        ELSE user_id || chr(9) || event_type || chr(10) || chr(9) || event_id
    END AS line FROM events"""

_LINES_LITERAL = r"""SELECT event_id, CASE event_id % 50
        WHEN 0 THEN CAST(user_id AS VARCHAR)
        WHEN 1 THEN user_id || '\t'
        WHEN 2 THEN user_id || '\t\t' || event_type
        WHEN 3 THEN user_id || 't\t'
        ELSE user_id || '\t' || event_type || chr(10)
    END AS line FROM events"""


def _fields_tab() -> str:
    return f"""SELECT event_id,
        string_split(rtrim(replace(line, chr(10), ''), chr(9)), chr(9)) AS f
        FROM ({_LINES_TAB})"""


def _fields_literal() -> str:
    return rf"""SELECT event_id,
        string_split(regexp_replace(replace(line, chr(10), ''), '(\\t)+$', ''), '\t') AS f
        FROM ({_LINES_LITERAL})"""


def _parsed(fields: str) -> str:
    return f"""SELECT CASE WHEN len(f) >= 2 THEN f[1] ELSE 'error' END AS ip,
        CASE WHEN len(f) >= 2 THEN f[2] ELSE 'error' END AS url, event_id FROM ({fields})"""


def _latest(changes: str) -> str:
    return f"""SELECT url, trigger_value, proc_time FROM ({changes})
        QUALIFY row_number() OVER (PARTITION BY url
            ORDER BY proc_time DESC, seq DESC, trigger_value DESC) = 1"""


def _versions(changes: str) -> str:
    return f"""SELECT url, trigger_value, proc_time, seq, lead(proc_time) OVER (
        PARTITION BY url ORDER BY proc_time, seq, trigger_value) AS valid_to FROM ({changes})"""


def _lookup(logs: str, dim: str) -> str:
    return f"""SELECT s.ip, s.url, s.ts, d.trigger_value, d.url AS dim_url
        FROM ({logs}) s JOIN ({dim}) d ON s.url = d.url"""


def _as_of(logs: str, changes: str) -> str:
    return f"""SELECT s.ip, s.url, s.ts, d.trigger_value, d.url AS dim_url
        FROM ({logs}) s ASOF JOIN (
            SELECT * FROM ({changes}) QUALIFY row_number() OVER (PARTITION BY url, proc_time
                ORDER BY seq DESC, trigger_value DESC) = 1
        ) d ON s.url = d.url AND s.ts >= d.proc_time"""


def _start(seconds: int) -> str:
    width = f"CAST({seconds * 1_000_000} AS BIGINT)"
    return f"make_timestamp(epoch_us(ts) // {width} * {width})"


def _tumble(rows: str, seconds: int, keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS times, {_start(seconds)} AS window_start,
        {_start(seconds)} + INTERVAL {seconds} SECOND AS window_end
        FROM ({rows}) GROUP BY {keys}, {_start(seconds)}"""


def _hop(rows: str, seconds: int, slide: int, keys: str) -> str:
    begin = f"({_start(slide)} - CAST(i AS INTEGER) * INTERVAL {slide} SECOND)"
    return f"""SELECT {keys}, count(*) AS times, {begin} AS window_start,
        {begin} + INTERVAL {seconds} SECOND AS window_end
        FROM ({rows}) CROSS JOIN range({seconds // slide}) AS r(i) GROUP BY {keys}, {begin}"""


def _alerts(counts: str, limit: str) -> str:
    return f"""SELECT ip, url, times, window_start, window_end FROM ({counts})
        WHERE times >= {limit}"""


def _json(alert_rows: str) -> str:
    return f"""SELECT '{{"ip":"' || ip || '","url":"' || url || '","times":' || times
        || ',"window_start":"' || strftime(window_start, '%Y-%m-%d %H:%M:%S')
        || '","window_end":"' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '"}}' AS value
        FROM ({alert_rows})"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    keys, by_threshold = "ip, url", "ip, url, trigger_value"
    number = "TRY_CAST(trigger_value AS BIGINT)"
    as_of = _as_of(_LOGS, _CHANGES)
    order_as_of = _as_of(_ORDER_LOGS, _ORDER_CHANGES)
    lookup_counted = _tumble(_lookup(_LOGS, _LOOKUP), SIZE, by_threshold)
    lookup_alerted = _alerts(lookup_counted, "trigger_value")
    bootstrap = _as_of(_LOGS, f"({_CHANGES}) UNION ALL ({_THRESHOLDS})")
    parts_counted = _tumble(_lookup(_ORDER_LOGS, _PARTS), YEAR, by_threshold)
    parts_alerted = _alerts(parts_counted, "trigger_value")
    fixed_alerted = _alerts(_tumble(_LOGS, SIZE, keys), "2")
    temporal_alerted = _alerts(_tumble(as_of, SIZE, by_threshold), number)
    hop_alerted = _alerts(_hop(as_of, SIZE, SLIDE, by_threshold), number)
    more = dict(_llm.ORACLES) if _llm else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        more["pipeline"] = _pipeline.ORACLE_SQL
    return {
        "source_scan": _LOGS,
        "start_at_timestamp": f"SELECT * FROM ({_LOGS}) WHERE ts >= TIMESTAMP '{START}'",
        "parse_lines_tab": _parsed(_fields_tab()),
        "parse_lines_literal": _parsed(_fields_literal()),
        "malformed_counts": f"""SELECT count(*) AS lines,
            count(*) FILTER (WHERE len(f) < 2) AS malformed FROM ({_fields_tab()})""",
        "dim_changes_parse": _PARSED_CHANGES,
        "processing_time": f"SELECT ip, url, true AS is_now FROM ({_LOGS})",
        "dim_latest": _latest(_CHANGES),
        "dim_latest_parts": _latest(_ORDER_CHANGES),
        "dim_versions": _versions(_CHANGES),
        "dim_versions_parts": _versions(_ORDER_CHANGES),
        "lookup_join_rows": _lookup(_LOGS, _LOOKUP),
        "lookup_join_parts": _lookup(_ORDER_LOGS, _PARTS),
        "temporal_join_rows": as_of,
        "temporal_join_sorted": as_of,
        "temporal_join_parts": order_as_of,
        "temporal_join_bootstrap": bootstrap,
        "tumble_counts": _tumble(_LOGS, SIZE, keys),
        "tumble_counts_by_threshold": lookup_counted,
        "hop_counts": _hop(as_of, SIZE, SLIDE, by_threshold),
        "hop_counts_panes": _hop(_LOGS, 36_000, 7200, keys),
        "threshold_coercion": f"""SELECT * FROM (
            SELECT url, trigger_value, count(*) AS times FROM ({_PARSED_CHANGES}) GROUP BY ALL)
            WHERE times >= {number}""",
        "fixed_threshold_alerts": fixed_alerted,
        "lookup_alerts": lookup_alerted,
        "lookup_alerts_parts": parts_alerted,
        "temporal_alerts": temporal_alerted,
        "temporal_alerts_parts": _alerts(_tumble(order_as_of, YEAR, by_threshold), number),
        "hop_temporal_alerts": hop_alerted,
        "alert_json": _json(lookup_alerted),
        "stream_fixed_threshold_alerts": fixed_alerted,
        "stream_alert_table": _json(fixed_alerted),
        "stream_lookup_alerts": lookup_alerted,
        "stream_lookup_alerts_parts": parts_alerted,
        "stream_temporal_alerts": temporal_alerted,
        "stream_bootstrap_alerts": _alerts(_tumble(bootstrap, SIZE, by_threshold), number),
        "stream_hop_temporal_alerts": hop_alerted,
        "stream_hop_counts_panes": _hop(_LOGS, 36_000, 7200, keys),
        "stream_dim_latest": _latest(_CHANGES),
        "stream_dim_latest_parts": _latest(_ORDER_CHANGES),
        "stream_processing_time_counts": f"""SELECT ip, url, count(*) AS times FROM ({_LOGS})
            GROUP BY ip, url""",
        **more,
    }
