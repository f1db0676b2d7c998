"""Triggered-monitor pages as the open-alert relation, one row per monitor group."""

from pyspark.sql import functions as F

from telemere import schemas
from telemere.functions import json as J
from telemere.sources.pages import guarded

# States that count as open (case-sensitive), and the API's page size.
OPEN_STATUSES = ("Alert", "Warn", "No Data")
ALERT_PAGE_SIZE = 100


def _first_problem(problems):
    return F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0))


def _mistyped(doc, name, wanted):
    found = J.kind(doc, f"$.{name}")
    return found.isNotNull() & (found != "VOID") & ~wanted(found)


def _whole_number(name):
    # A JSON integer too long for BIGINT arrives as a decimal without fraction digits.
    return (name == "BIGINT") | name.rlike(r"^DECIMAL\(\d+,0\)$")


def _group_problem(group):
    def is_text(name):
        return name == "STRING"

    problem = F.when(~J.is_object(group), F.lit("alert group is not an object"))
    for name, wanted, label in (
        ("monitor_id", _whole_number, "an integer"),
        ("monitor_name", is_text, "a string"),
        ("group", is_text, "a string"),
        ("status", is_text, "a string"),
        ("last_triggered_ts", _whole_number, "an integer"),
        ("last_nodata_ts", _whole_number, "an integer"),
        ("group_tags", lambda n: n.startswith("ARRAY"), "an array"),
    ):
        problem = problem.when(
            _mistyped(group, name, wanted), F.lit(f"alert group field {name} must be {label} or null")
        )
    stray = F.exists(J.array_at(group, "$.group_tags"), lambda t: J.kind_of(t) != "STRING")
    return problem.when(stray, F.lit("alert group tags must be strings"))


def page_problem(doc):
    """Why an alert page is malformed; NULL when it is sound."""
    groups = J.array_at(doc, "$.groups")
    meta = J.kind(doc, "$.metadata")
    return (
        F.when(doc.isNull(), F.lit("alert page is not valid JSON"))
        .when(groups.isNull(), F.lit("alert page has no groups array"))
        .when(
            (meta != "VOID") & ~meta.startswith("OBJECT"),
            F.lit("alert page metadata must be an object or null"),
        )
        .when(
            _mistyped(doc, "metadata.total_count", _whole_number)
            | (F.try_variant_get(doc, "$.metadata.total_count", "long") < 0),
            F.lit("alert page total_count must be a non-negative integer"),
        )
        .otherwise(_first_problem(F.transform(groups, _group_problem)))
    )


def _moment(seconds):
    # Zero is the API's way of saying "never".
    return F.when(seconds > 0, F.timestamp_seconds(seconds)).cast("timestamp_ntz")


def normalise_alerts(pages, carry=(), open_only=True, on_malformed="raise"):
    """Alert groups of landing pages; only open ones unless ``open_only`` is off."""
    parsed = pages.select(*carry, J.parse_whole(F.col("body")).alias("doc"))
    groups = guarded(J.array_at(F.col("doc"), "$.groups"), page_problem(F.col("doc")), on_malformed)
    rows = parsed.select(*carry, F.explode(groups).alias("g"))
    group = F.col("g")

    def text(name):
        return F.try_variant_get(group, f"$.{name}", "string")

    def number(name):
        return F.try_variant_get(group, f"$.{name}", "long")

    columns = {
        "monitor_id": number("monitor_id"),
        "monitor_name": text("monitor_name"),
        "group_name": text("group"),
        "group_tags": F.try_variant_get(group, "$.group_tags", "array<string>"),
        "status": text("status"),
        "last_triggered_at": _moment(number("last_triggered_ts")),
        "last_nodata_at": _moment(number("last_nodata_ts")),
    }
    if open_only:
        rows = rows.where(columns["status"].isin(*OPEN_STATUSES))
    return rows.select(*carry, *schemas.project(schemas.ALERTS, columns))


def alert_rejects(pages, keep=("scan_id", "page_no")):
    """The malformed pages and why."""
    parsed = pages.select(*keep, J.parse_whole(F.col("body")).alias("doc"))
    return parsed.select(*keep, page_problem(F.col("doc")).alias("reason")).where("reason is not null")


def with_alert_page_header(pages):
    """Add ``n_rows`` (groups before any status filter) and ``total_count``."""
    missing = {
        "n_rows": F.coalesce(F.json_array_length(F.get_json_object("body", "$.groups")), F.lit(0)).cast("long"),
        "total_count": F.get_json_object("body", "$.metadata.total_count").try_cast("long"),
    }
    return pages.select(
        "*", *[column.alias(name) for name, column in missing.items() if name not in pages.columns]
    )
