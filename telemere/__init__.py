"""telemere: observability telemetry as Spark DataFrames."""

from telemere.plans.catalog import attach
from telemere.plans.landing import Landing, land_pages, materialise
from telemere.plans.options import AttachOptions, Provider
from telemere.plans.readers import (
    read_indexes,
    read_log_stats,
    read_logs,
    read_metrics,
    read_open_alerts,
    read_service_dependencies,
    read_spans,
)
from telemere.sinks.logs import log_batches
from telemere.sinks.spans import agent_spans, trace_batches

__all__ = [
    "AttachOptions",
    "Landing",
    "Provider",
    "agent_spans",
    "attach",
    "land_pages",
    "log_batches",
    "materialise",
    "read_indexes",
    "read_log_stats",
    "read_logs",
    "read_metrics",
    "read_open_alerts",
    "read_service_dependencies",
    "read_spans",
    "trace_batches",
]
