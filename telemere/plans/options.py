"""Checked options of readers and attachments."""

from dataclasses import dataclass, fields

SORTS = ("timestamp", "-timestamp")


class OptionError(ValueError):
    """An option with a value it cannot have."""


class NotConfigured(ValueError):
    """A relation that needs configuration it was not given."""


def check_limits(sort="timestamp", page_size=1000, max_rows=0, retries=4, timeout=60):
    """Limits shared by all readers."""
    if sort not in SORTS:
        raise OptionError(f"cannot sort by {sort!r}; known orders: {', '.join(SORTS)}")
    if not 1 <= page_size <= 1000:
        raise OptionError(f"page_size is {page_size}; a page has 1 to 1000 rows")
    if max_rows < 0:
        raise OptionError("max_rows is negative; give 0 to read everything")
    if retries < 0:
        raise OptionError("retries is negative; give 0 to try once")
    if timeout < 1:
        raise OptionError("timeout is below one second")


@dataclass(frozen=True)
class Provider:
    """Whose data this is: fills ``provider`` columns and the ``<name>.site`` attribute."""

    name: str = "provider"
    site: str = "localhost"


_TEXT = {
    "secret": False,
    "sort": True,
    "service_map_env": False,
    "service_map_start_time": True,
    "service_map_end_time": True,
    "service_map_primary_tag": False,
    "metrics_query": False,
    "metrics_start_time": True,
    "metrics_end_time": True,
}
_WHOLE = ("page_size", "max_rows", "retries", "timeout")


@dataclass(frozen=True)
class AttachOptions:
    """Options of an attachment; anything not given keeps its default."""

    secret: str | None = None
    indexes: tuple | None = None
    sort: str = "timestamp"
    page_size: int = 1000
    max_rows: int = 0
    retries: int = 4
    timeout: int = 60
    service_map_env: str | None = None
    service_map_start_time: str = "-1h"
    service_map_end_time: str = "now"
    service_map_primary_tag: str | None = None
    metrics_query: str | None = None
    metrics_start_time: str = "now-15m"
    metrics_end_time: str = "now"

    @classmethod
    def parse(cls, options):
        """Options by case-insensitive name; unknown names and NULL values are refused."""
        known = [f.name for f in fields(cls)]
        values = {}
        for name, value in options.items():
            key = name.lower()
            if key not in known:
                raise OptionError(f"unsupported option '{name}'; supported are {', '.join(known)}")
            values[key] = _checked(key, value)
        return cls(**values)

    def __post_init__(self):
        check_limits(self.sort, self.page_size, self.max_rows, self.retries, self.timeout)
        if not self.service_map_start_time or not self.service_map_end_time:
            raise OptionError("service map times must not be empty")


def _checked(key, value):
    if key == "indexes":
        if isinstance(value, str) or not isinstance(value, (list, tuple)):
            raise OptionError("indexes must be a list of names")
        if any(not isinstance(name, str) or not name for name in value):
            raise OptionError("indexes must hold only non-empty names")
        return tuple(dict.fromkeys(value))
    if key in _WHOLE:
        if isinstance(value, bool) or not isinstance(value, int):
            raise OptionError(f"{key} must be a non-null integer")
        return value
    if not isinstance(value, str):
        raise OptionError(f"{key} must be a non-null text")
    if not value and not _TEXT[key]:
        raise OptionError(f"{key} must not be empty")
    return value
