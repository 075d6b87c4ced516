"""Typed parameters of the four jobs."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import MISSING, dataclass, field, fields

from surgewatch.functions.parse import TAB
from surgewatch.operators.windows import check_window
from surgewatch.sources.positions import StartPosition, start_time

# Parameters that only a connector understands.
CONNECTOR_KEYS = ("project_env", "aws_region", "ak", "sk")

# Seconds per unit of a duration.
UNITS = {"ms": 0.001, "s": 1, "min": 60, "h": 3600, "d": 86400}


def seconds_of(duration: str | float) -> float:
    """Seconds of ``3600``, ``'3600s'``, ``'1 h'``, ``'500ms'``."""
    match = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*(ms|s|min|h|d)?\s*", str(duration))
    if not match:
        raise ValueError(f"not a duration: {duration!r}")
    return float(match[1]) * UNITS[match[2] or "s"]


def _whole(name: str, value: object) -> int:
    if isinstance(value, bool) or not re.fullmatch(r"\s*[+-]?\d+\s*", str(value)):
        raise ValueError(f"{name} must be a whole number: {value!r}")
    return int(value)


@dataclass(frozen=True)
class JobParams:
    """What all jobs share: streams, start position and window size."""

    input_stream_name: str
    target_stream_name: str
    window_size: int
    stream_init_position: StartPosition | str = StartPosition.LATEST
    stream_initial_timestamp: str | None = None
    delimiter: str = TAB
    connector: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        for name in ("window_size", "window_interval", "trigger_value", "cache_maxrows"):
            if getattr(self, name, None) is not None:
                object.__setattr__(self, name, _whole(name, getattr(self, name)))
        position = StartPosition.of(self.stream_init_position)
        object.__setattr__(self, "stream_init_position", position)
        if position is StartPosition.AT_TIMESTAMP:
            if self.stream_initial_timestamp is None:
                raise ValueError("AT_TIMESTAMP needs stream_initial_timestamp")
            start_time(self.stream_initial_timestamp)
        check_window(self.window_size, getattr(self, "window_interval", None))

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> JobParams:
        """From text parameters; missing and unknown names are errors."""
        names = {f.name for f in fields(cls)} - {"connector"}
        required = {
            f.name
            for f in fields(cls)
            if f.default is MISSING and f.default_factory is MISSING
        }
        missing = sorted(required - set(options))
        unknown = sorted(set(options) - names - set(CONNECTOR_KEYS))
        if missing:
            raise ValueError(f"missing parameters: {', '.join(missing)}")
        if unknown:
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")
        return cls(
            **{k: v for k, v in options.items() if k in names},
            connector={k: v for k, v in options.items() if k in CONNECTOR_KEYS},
        )


@dataclass(frozen=True, kw_only=True)
class FixedThresholdParams(JobParams):
    trigger_value: int


@dataclass(frozen=True, kw_only=True)
class LookupParams(JobParams):
    mysql_host: str
    mysql_table: str
    mysql_user: str | None = None
    mysql_password: str | None = field(default=None, repr=False)
    cache_ttl: str | float = 0
    cache_maxrows: int | None = None

    def __post_init__(self) -> None:
        super().__post_init__()
        object.__setattr__(self, "cache_ttl", seconds_of(self.cache_ttl))


@dataclass(frozen=True, kw_only=True)
class TemporalParams(JobParams):
    dim_stream_name: str
    dim_stream_init_position: StartPosition | str = StartPosition.TRIM_HORIZON

    def __post_init__(self) -> None:
        super().__post_init__()
        position = StartPosition.of(self.dim_stream_init_position)
        if position is StartPosition.AT_TIMESTAMP:
            raise ValueError("dim_stream_init_position is LATEST or TRIM_HORIZON")
        object.__setattr__(self, "dim_stream_init_position", position)


@dataclass(frozen=True, kw_only=True)
class HopTemporalParams(TemporalParams):
    window_interval: int
