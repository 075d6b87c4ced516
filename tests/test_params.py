import pytest

from surgewatch.params import (
    FixedThresholdParams,
    HopTemporalParams,
    LookupParams,
    TemporalParams,
    seconds_of,
)
from surgewatch.sources.positions import StartPosition

BASE = {"input_stream_name": "in", "target_stream_name": "out", "window_size": "10"}
LOOKUP = {**BASE, "mysql_host": "jdbc:x", "mysql_table": "dim_tb", "mysql_password": "hidden"}
TEMPORAL = {**BASE, "dim_stream_name": "dim"}


def test_text_becomes_typed():
    params = FixedThresholdParams.from_options({**BASE, "trigger_value": "50"})
    assert (params.window_size, params.trigger_value) == (10, 50)
    assert params.stream_init_position is StartPosition.LATEST
    hop = HopTemporalParams.from_options({**TEMPORAL, "window_interval": "5"})
    assert hop.window_interval == 5
    assert hop.dim_stream_init_position is StartPosition.TRIM_HORIZON
    lookup = LookupParams.from_options({**LOOKUP, "cache_ttl": "3600s", "cache_maxrows": "1000"})
    assert (lookup.cache_ttl, lookup.cache_maxrows) == (3600, 1000)


def test_secrets_are_not_printed():
    params = LookupParams.from_options({**LOOKUP, "ak": "key", "sk": "secret"})
    assert params.connector == {"ak": "key", "sk": "secret"}
    assert not any(word in repr(params) for word in ("hidden", "secret", "key"))


@pytest.mark.parametrize(
    "kind,options",
    [
        (FixedThresholdParams, BASE),
        (FixedThresholdParams, {**BASE, "trigger_value": "many"}),
        (FixedThresholdParams, {**BASE, "trigger_value": "5", "window_size": "0"}),
        (FixedThresholdParams, {**BASE, "trigger_value": "5", "windowsize": "1"}),
        (FixedThresholdParams, {**BASE, "trigger_value": "5", "stream_init_position": "NOW"}),
        (
            FixedThresholdParams,
            {**BASE, "trigger_value": "5", "stream_init_position": "at_timestamp"},
        ),
        (LookupParams, BASE),
        (LookupParams, {**LOOKUP, "cache_ttl": "soon"}),
        (TemporalParams, {**TEMPORAL, "dim_stream_init_position": "AT_TIMESTAMP"}),
        (HopTemporalParams, {**TEMPORAL, "window_interval": "11"}),
        (HopTemporalParams, TEMPORAL),
    ],
)
def test_bad_parameters_are_refused(kind, options):
    with pytest.raises(ValueError):
        kind.from_options(options)


def test_durations():
    assert [seconds_of(t) for t in ("3600s", "1 h", "500ms", "2min", 7, "1d")] == [
        3600, 3600, 0.5, 120, 7, 86400
    ]
