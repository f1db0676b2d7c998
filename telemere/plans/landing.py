"""Landing folders: where raw pages lie, and how normalised tables are written.

A landing folder holds one Parquet table of raw bodies per kind::

    logs/                  scan_id, page_no, cursor, body [, index, from_ms, to_ms, received_unix_nano]
    spans/                 scan_id, page_no, cursor, body [, from_ms, to_ms, received_unix_nano]
    metrics/               query, start_s, end_s, body [, scan_id, received_unix_nano]
    alerts/                scan_id, page_no, body [, scope, received_unix_nano]
    service_dependencies/  environment, primary_tag, start_s, end_s, body
    indexes/               body

Columns in brackets are optional. With ``received_unix_nano`` (and the searched window, where there is one),
reads that overlap count once: see ``operators.coverage`` and ``plans.readers``. :func:`land_pages` and
:func:`land_alert_pages` add ``after``, ``n_rows``, ``live``, ``first_nanos``, ``last_nanos`` and, as a
partition, ``dt``, the day of a page's latest event.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from telemere.functions.time import event_time
from telemere.operators.paging import with_cursor_chain, with_offset_chain
from telemere.session import shared_dir
from telemere.sources.alerts import with_alert_page_header
from telemere.sources.pages import with_page_header, with_page_times


@dataclass(frozen=True)
class Landing:
    """A landing folder; ``table(kind)`` reads one of its tables lazily."""

    path: str

    def table(self, spark, kind):
        return spark.read.parquet(f"{self.path}/{kind}")


def land_pages(pages, path, partition_by=()):
    """Write search pages with their paging header, whether they count, and their times; nothing passes the driver.

    A call lands whole scans. Pages are worked out once: they are put down with their header, whether they count is
    found from narrow columns, and only bodies of scans that go on behind their last page are shuffled for it.
    """
    _land(with_page_times(with_page_header(pages)), with_cursor_chain, path, partition_by)


def land_alert_pages(pages, path, partition_by=()):
    """Write alert pages with their paging header and whether they count; a call lands whole scans."""
    _land(with_alert_page_header(pages), with_offset_chain, path, partition_by)


def _land(headed, with_chain, path, partition_by):
    if "dt" in partition_by and "dt" not in headed.columns:
        headed = headed.withColumn("dt", F.to_date(event_time(F.col("last_nanos"))))
    if "live" in headed.columns:
        write_bodies(headed, path, partition_by)
        return
    spark = headed.sparkSession
    held = shared_dir(spark, "headed")
    write_bodies(headed, held)
    write_bodies(with_chain(spark.read.schema(headed.schema).parquet(held), look=True), path, partition_by)
    folder = spark._jvm.org.apache.hadoop.fs.Path(held)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Bodies are long and compress well: a reader takes up to a row group of them into memory at once, a writer a page.
BODY_BLOCKS = {
    "parquet.block.size": str(4 * 1024 * 1024),
    "parquet.block.row.count.limit": "128",
    "parquet.page.row.count.limit": "32",
}


def write_bodies(rows, path, partition_by=()):
    """Append rows that hold whole bodies, in row groups that are small however well the bodies compress."""
    writer = rows.write.mode("append").options(**BODY_BLOCKS)
    return (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def materialise(rows, path, time="time_unix_nano", partition_by=("index", "dt")):
    """Write a normalised relation partitioned for pruning by index and day.

    A rebalance groups each partition's rows into few files while adaptive
    execution splits the partitions that are too large, so a hot index or day is
    written by many tasks.
    """
    dated = rows.withColumn("dt", F.to_date(event_time(F.col(time)))) if "dt" in partition_by else rows
    return dated.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
