"""Resolution of textual time windows, done once per job with an explicit ``now``."""

import re
import time as _time
from dataclasses import dataclass
from datetime import datetime, timezone

# Seconds per relative unit.
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}

_INT64_MIN, _INT64_MAX = -(2**63), 2**63 - 1
_NANOS = 1_000_000_000
# Whole seconds whose nanoseconds fit 64 bits.
_MIN_SECONDS, _MAX_SECONDS = -(2**63 // _NANOS), _INT64_MAX // _NANOS

_ISO = re.compile(r"^\d{4}-\d{2}-\d{2}")


class WindowError(ValueError):
    """A window endpoint that cannot be resolved."""


@dataclass(frozen=True)
class Window:
    """A half-open time range; ``unit`` is 's' or 'ms'."""

    start: int
    end: int
    unit: str = "s"

    @property
    def start_nanos(self):
        return self.start * (_NANOS if self.unit == "s" else 1_000_000)

    @property
    def end_nanos(self):
        return self.end * (_NANOS if self.unit == "s" else 1_000_000)

    @property
    def empty(self):
        return self.start > self.end


def _relative(text, units, minimum, name):
    """Seconds of a '-15m' style offset."""
    match = re.fullmatch(r"-([0-9]+)([a-z])", text)
    if not match or match[2] not in units:
        raise WindowError(f"{name}={text!r} is no offset; write a minus, a number and one of {' '.join(units)}")
    seconds = int(match[1]) * UNIT_SECONDS[match[2]]
    if int(match[1]) < minimum or seconds > _INT64_MAX:
        raise WindowError(f"{name}={text!r} lies outside what can be counted in seconds")
    return seconds


def _service_map_endpoint(value, now, name):
    text = value.strip().lower()
    if text == "now":
        return now
    bare = text[3:] if text.startswith("now-") else text
    if bare.startswith("-"):
        resolved = now - _relative(bare, "smhdw", 1, name)
        if resolved < _INT64_MIN:
            raise WindowError(f"{name}={text!r} lies outside what can be counted in seconds")
        return resolved
    if not re.fullmatch(r"[0-9]+", text):
        raise WindowError(f"{name}={text!r} is neither a second since 1970, nor now, nor an offset back from it")
    if int(text) > _INT64_MAX:
        raise WindowError(f"{name}={text!r} is too large for a second since 1970")
    return int(text)


def service_map_window(start, end, now=None):
    """Window of a service-dependency read, in seconds.

    Case does not matter, units are s m h d w, and a relative offset is positive.
    """
    now = int(_time.time()) if now is None else now
    low, high = _service_map_endpoint(start, now, "from"), _service_map_endpoint(end, now, "to")
    if low > high:
        raise WindowError("the window ends before it starts")
    if not (_MIN_SECONDS <= low <= _MAX_SECONDS and _MIN_SECONDS <= high <= _MAX_SECONDS):
        raise WindowError("nanoseconds cannot express this window")
    return Window(low, high, "s")


def _metric_endpoint(value, now, name):
    text = value.strip()
    if text.lower() == "now":
        return now
    bare = text[3:] if text.startswith("now-") else text
    if re.fullmatch(r"-[0-9]+[smhd]", bare):
        return now - _relative(bare, "smhd", 0, name)
    if re.fullmatch(r"\+?[0-9]+", bare) and int(bare) <= _INT64_MAX:
        return int(bare)
    raise WindowError(f"cannot read {name}={value!r} as a time")


def metrics_window(start, end, now=None):
    """Window of a metric read, in seconds.

    Only the word ``now`` ignores case, units are s m h d, and a zero offset is allowed.
    """
    now = int(_time.time()) if now is None else now
    low, high = _metric_endpoint(start, now, "from"), _metric_endpoint(end, now, "to")
    if low > high:
        raise WindowError("the window ends before it starts")
    return Window(low, high, "s")


def _search_endpoint(value, now_ms, name):
    text = value.strip()
    if re.fullmatch(r"-?[0-9]+", text):
        return int(text)
    if _ISO.match(text):
        try:
            moment = datetime.fromisoformat(text)
        except ValueError as error:
            raise WindowError(f"cannot read {name}={value!r} as an ISO time") from error
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return (delta.days * 86400 + delta.seconds) * 1000 + delta.microseconds // 1000
    lowered = text.lower()
    if lowered == "now":
        return now_ms
    bare = lowered[3:] if lowered.startswith("now-") else lowered
    return now_ms - _relative(bare, "smhdw", 0, name) * 1000


def search_window(start, end, now_ms=None):
    """Window of a log or span search, in milliseconds: relative, epoch ms, or ISO endpoints."""
    now_ms = int(_time.time() * 1000) if now_ms is None else now_ms
    return Window(_search_endpoint(start, now_ms, "from"), _search_endpoint(end, now_ms, "to"), "ms")


def is_epoch_ms(text):
    return bool(re.fullmatch(r"-?[0-9]+", text)) and _INT64_MIN <= int(text) <= _INT64_MAX


@dataclass(frozen=True)
class TimeBounds:
    """Bounds taken from time predicates, in whole milliseconds rounded outwards; None is open."""

    lower_ms: int | None = None
    upper_ms: int | None = None

    def tighten(self, op, nanos):
        """Bounds with one more ``>``, ``>=``, ``<`` or ``<=`` predicate; the tightest wins."""
        if op in (">", ">="):
            ms = nanos // 1_000_000
            return TimeBounds(ms if self.lower_ms is None else max(self.lower_ms, ms), self.upper_ms)
        if op in ("<", "<="):
            ms = -(-nanos // 1_000_000)
            return TimeBounds(self.lower_ms, ms if self.upper_ms is None else min(self.upper_ms, ms))
        raise ValueError(f"not a range comparison: {op}")


def intersect(start, end, bounds):
    """Endpoints after intersecting a window with time bounds.

    Only a window with two epoch-millisecond endpoints is narrowed, and never
    widened; relative and ISO endpoints come back untouched. The third value is
    True when nothing can match.
    """
    if bounds == TimeBounds() or not (is_epoch_ms(start) and is_epoch_ms(end)):
        return start, end, False
    low = int(start) if bounds.lower_ms is None else max(int(start), bounds.lower_ms)
    high = int(end) if bounds.upper_ms is None else min(int(end), bounds.upper_ms)
    return str(low), str(high), low > high
