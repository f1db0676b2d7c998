import pytest

from telemere.functions.window import (
    TimeBounds,
    WindowError,
    intersect,
    metrics_window,
    search_window,
    service_map_window,
)
from telemere.operators.search import combine_terms, measure

NOW = 1700003600


def test_service_map_windows():
    assert (service_map_window("-1h", "now", NOW).start, service_map_window("-1h", "now", NOW).end) == (
        1700000000,
        NOW,
    )
    assert service_map_window(" NOW-15M ", "now", NOW).start == NOW - 900
    assert service_map_window("1700000000", "1700000001", NOW).end == 1700000001
    assert service_map_window("-2w", "now", NOW).start == NOW - 2 * 604800


@pytest.mark.parametrize(
    "start, end",
    [
        ("now", "-1h"),
        ("", "now"),
        ("-h", "now"),
        ("-0h", "now"),
        ("-1y", "now"),
        ("-5", "now"),
        ("12a", "now"),
        ("-99999999999999999999h", "now"),
        ("0", "9223372037"),
        ("0", "99999999999999999999"),
    ],
)
def test_bad_service_map_windows(start, end):
    with pytest.raises(WindowError):
        service_map_window(start, end, NOW)


def test_metric_windows_keep_their_own_rules():
    assert metrics_window("now-0s", "NOW", NOW).start == NOW
    assert metrics_window("-1d", "now", NOW).start == NOW - 86400
    for bad in ("NOW-1h", "-1w", "-1H", "-5", "abc", ""):
        with pytest.raises(WindowError):
            metrics_window(bad, "now", NOW)


def test_search_windows():
    assert search_window("now-15m", "now", NOW * 1000).start_nanos == (NOW - 900) * 10**9
    assert search_window("1700000000000", "2023-11-14T22:13:21.5Z").end == 1700000001500
    assert search_window("10", "5").empty


def test_intersection_only_narrows_epoch_windows():
    bounds = TimeBounds().tighten(">", 1_500_000).tighten(">=", 500_000).tighten("<", 9_000_001)
    assert bounds == TimeBounds(1, 10)
    assert intersect("0", "20", bounds) == ("1", "10", False)
    assert intersect("5", "8", bounds) == ("5", "8", False)
    assert intersect("now-15m", "now", bounds) == ("now-15m", "now", False)
    assert intersect("2024-01-01", "20", bounds) == ("2024-01-01", "20", False)
    assert intersect("11", "20", bounds) == ("11", "10", True)
    assert TimeBounds().tighten("<=", -1_500_000).upper_ms == -1
    assert TimeBounds().tighten(">=", -1_500_000).lower_ms == -2


def test_search_text_combination():
    assert combine_terms("*", ["service:a", "status:b", "service:a"]) == "service:a AND status:b"
    assert combine_terms("env:prod", ["service:a", "status:b"]) == "(env:prod) AND service:a AND status:b"
    assert combine_terms("env:prod", []) == "env:prod"


def test_durations():
    assert measure("1.5s") == 1_500_000_000
    assert measure("2ms") == 2_000_000
    assert measure(7) == 7 and measure("7") == 7
    with pytest.raises(ValueError):
        measure("soon")
