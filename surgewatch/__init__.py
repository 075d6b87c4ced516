"""Rate alerts on access logs, written as Spark DataFrame transformations."""

from surgewatch.plans.alerts import (
    fixed_threshold_alerts,
    hop_temporal_alerts,
    lookup_alerts,
    temporal_alerts,
)

__all__ = [
    "fixed_threshold_alerts",
    "hop_temporal_alerts",
    "lookup_alerts",
    "temporal_alerts",
]
