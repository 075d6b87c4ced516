"""Small log and threshold tables, and brute-force answers in plain Python."""

from __future__ import annotations

from datetime import datetime, timedelta

EPOCH = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return EPOCH + timedelta(seconds=seconds)


def make_logs(spark, rows):
    """Rows are (ip, url, seconds)."""
    data = [(ip, url, at(s)) for ip, url, s in rows]
    return spark.createDataFrame(data, "ip string, url string, ts timestamp_ntz")


def make_changes(spark, rows):
    """Rows are (url, trigger_value, seconds, seq)."""
    data = [(url, v, at(s), seq) for url, v, s, seq in rows]
    return spark.createDataFrame(
        data, "url string, trigger_value string, proc_time timestamp_ntz, seq bigint"
    )


def found(df, *columns):
    """Rows as a sorted list of tuples, times as seconds."""
    names = columns or df.columns

    def plain(value):
        if isinstance(value, datetime):
            return (value - EPOCH).total_seconds()
        return value

    rows = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def as_of(logs, changes):
    """(ip, url, seconds, threshold) for each log row with a valid change."""
    result = []
    for ip, url, s in logs:
        known = [c for c in changes if c[0] == url and url is not None and c[2] <= s]
        if known:
            best = max(known, key=lambda c: (c[2], c[3], c[1] is not None, c[1] or ""))
            result.append((ip, url, s, best[1]))
    return in_order(result)


def windows_of(s, size, slide):
    start = s // slide * slide
    while start + size > s:
        yield start
        start -= slide


def hop_counts(rows, size, slide):
    """Counts per key and window; rows are (key..., seconds)."""
    counts = {}
    for *key, s in rows:
        for start in windows_of(s, size, slide):
            group = (*key, start)
            counts[group] = counts.get(group, 0) + 1
    return in_order([(*g[:-1], n, g[-1], g[-1] + size) for g, n in counts.items()])
