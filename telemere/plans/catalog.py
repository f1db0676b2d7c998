"""Attachments: landed telemetry as a set of named, read-only views."""

import re

from pyspark.sql import functions as F

from telemere import schemas
from telemere.plans import readers
from telemere.plans.landing import Landing
from telemere.plans.options import AttachOptions, NotConfigured, Provider

# Tables an attachment has besides one log table per index.
FIXED_TABLES = {
    "alerts.open": schemas.ALERTS,
    "service_map.dependencies": schemas.DEPENDENCIES,
    "traces.spans": schemas.SPANS,
    "metrics.series": schemas.METRICS,
}


class Attachment:
    """Tables of a landing folder: ``logs.<index>`` plus the fixed ones.

    Relative windows are resolved whenever a table is asked for, so a long-lived
    attachment keeps returning the latest window; ``refresh`` does the same for
    the registered views.
    """

    def __init__(self, spark, name, landing, options, provider):
        self.spark, self.name, self.options, self.provider = spark, name, options, provider
        self.landing = landing
        indexes = options.indexes
        if indexes is None:
            # The list of indexes is small by nature: it names catalog tables.
            indexes = tuple(row["name"] for row in readers.read_indexes(spark, landing).collect())
        self.tables = [f"logs.{index}" for index in indexes] + list(FIXED_TABLES)

    def schema(self, table):
        """Schema of a table, known without reading anything or being configured."""
        self._known(table)
        return schemas.LOGS if table.startswith("logs.") else FIXED_TABLES[table]

    def table(self, table, now=None):
        """A table as a DataFrame; a relation that lacks configuration raises here."""
        self._known(table)
        options, spark, landing = self.options, self.spark, self.landing
        limits = dict(retries=options.retries, timeout=options.timeout)
        now_ms = None if now is None else now * 1000
        if table.startswith("logs.") or table == "traces.spans":
            paged = dict(
                sort=options.sort, page_size=options.page_size, max_rows=options.max_rows, now_ms=now_ms, **limits
            )
            if table == "traces.spans":
                return readers.read_spans(spark, landing, **paged)
            return readers.read_logs(spark, landing, indexes=(table.removeprefix("logs."),), **paged)
        if table == "alerts.open":
            return readers.read_open_alerts(spark, landing, **limits)
        if table == "service_map.dependencies":
            if not options.service_map_env:
                raise NotConfigured("the service map is not configured: attach with service_map_env")
            return readers.read_service_dependencies(
                spark,
                landing,
                options.service_map_env,
                options.service_map_start_time,
                options.service_map_end_time,
                options.service_map_primary_tag,
                provider=self.provider,
                now=now,
                **limits,
            )
        if not options.metrics_query:
            raise NotConfigured("metrics are not configured: attach with metrics_query")
        return readers.read_metrics(
            spark,
            landing,
            options.metrics_query,
            options.metrics_start_time,
            options.metrics_end_time,
            options.max_rows,
            provider=self.provider,
            now=now,
            **limits,
        )

    def view_name(self, table):
        return re.sub(r"\W", "_", f"{self.name}_{table}")

    def refresh(self, now=None):
        """(Re)register all views; one that lacks configuration fails only when it is scanned."""
        for table in self.tables:
            try:
                rows = self.table(table, now)
            except NotConfigured as error:
                rows = self._failing(table, str(error))
            rows.createOrReplaceTempView(self.view_name(table))
        return self

    def detach(self):
        for table in self.tables:
            self.spark.catalog.dropTempView(self.view_name(table))

    def _failing(self, table, message):
        rows = self.spark.range(1).select(*schemas.project(self.schema(table), {}))
        return rows.where(F.raise_error(F.lit(message)).cast("boolean"))

    def _known(self, table):
        if table not in self.tables:
            raise KeyError(f"no table {table} in attachment {self.name}")


def attach(spark, name, path, provider=Provider(), now=None, **options):
    """Attach a landing folder under a name and register its views ``<name>_<schema>_<table>``."""
    parsed = AttachOptions.parse(options)
    return Attachment(spark, name, Landing(path), parsed, provider).refresh(now)
