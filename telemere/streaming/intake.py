"""Continuous log intake with Structured Streaming.

Requests arrive as rows or whole-body files; sound ones become rows of the
18-column table, refused ones rows of a rejects table. One streaming query reads and
judges each request once. A micro-batch is staged below the checkpoint and its files are moved
into the two tables under names that carry the batch's number; a batch that runs again after
a failure first takes its files back. So a request is stored completely and once, also when
executors or the driver are lost. Until a failed batch has run again, the tables may lack some of it.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import functions as F

from telemere import schemas
from telemere.sources import intake


@dataclass(frozen=True)
class IntakeOptions:
    """Where an intake reads and writes, and what it accepts."""

    source: str
    table: str
    rejects: str
    checkpoint: str
    layout: str = "requests"
    content_type: str = "application/json"
    api_key: str = ""
    max_body_bytes: int = intake.MAX_BODY_BYTES
    create_table: bool = True
    max_files_per_trigger: int | None = None

    def __post_init__(self):
        if self.layout not in ("requests", "bodies"):
            raise ValueError("layout must be 'requests' (request rows) or 'bodies' (one file per body)")
        if self.max_body_bytes < 1:
            raise ValueError("max_body_bytes must be >= 1")
        if self.layout == "bodies" and self.api_key:
            raise ValueError("body files carry no key: api_key needs layout 'requests'")
        for name in ("source", "table", "rejects", "checkpoint"):
            if not getattr(self, name):
                raise ValueError(f"{name} must not be empty")


def request_stream(spark, options):
    """Streaming request rows of either layout; gzip and zstd files are read as they are."""
    reader = spark.readStream
    if options.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", options.max_files_per_trigger)
    if options.layout == "requests":
        return reader.schema(intake.REQUESTS).parquet(options.source)
    return body_requests(reader.text(options.source, wholetext=True), options.content_type)


def body_requests(files, content_type):
    """Request rows from whole-file text: the file is the request, its time the receive time."""
    received = F.unix_micros(F.col("_metadata.file_modification_time")) * 1000
    return files.select(
        F.col("_metadata.file_path").alias("request_id"),
        received.alias("received_unix_nano"),
        F.lit(content_type).alias("content_type"),
        F.lit("").alias("api_key"),
        F.col("value").alias("body"),
    )


def ensure_target(spark, path, create=True):
    """Make sure the target holds exactly the 18 log columns, creating it if allowed."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(location):
        found = spark.read.parquet(path).schema
        if not schemas.same_layout(found, schemas.LOGS):
            raise ValueError(f"target {path} must have the 18 log columns in order")
    elif create:
        spark.createDataFrame([], schemas.LOGS).write.parquet(path)
    else:
        raise ValueError(f"target {path} does not exist and create_table is off")


_running = {}


def _publish(rows, staging, table, prefix):
    """Write ``rows`` and move their files into ``table``, in place of files that have the same prefix."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = path(staging), path(table)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    for earlier in files.globStatus(path(f"{table}/{prefix}*")) or []:
        files.delete(earlier.getPath(), False)
    if spark.read.schema(rows.schema).parquet(staging).isEmpty():
        return
    parts = [f.getPath() for f in files.listStatus(source) if f.getPath().getName().startswith("part-")]
    for number, part in enumerate(sorted(parts, key=lambda p: p.getName())):
        if not files.rename(part, path(f"{table}/{prefix}{number:05d}.parquet")):
            raise OSError(f"could not move {part} into {table}")


def batch_writer(options):
    """A function (batch, number) that stores a micro-batch of requests; storing it again changes nothing."""
    # Intakes that share a table have checkpoints of their own.
    intake_id = hashlib.sha256(options.checkpoint.encode()).hexdigest()[:12]

    def store(requests, number):
        staging, prefix = f"{options.checkpoint}/staging", f"intake-{intake_id}-{number:012d}-"
        judged = intake.judged_logs(intake.assess(requests, options.api_key, options.max_body_bytes))
        judged.write.mode("overwrite").parquet(f"{staging}/judged")
        held = requests.sparkSession.read.schema(judged.schema).parquet(f"{staging}/judged")
        accepted = held.where(F.col("code") == intake.ACCEPTED).select(*schemas.LOGS.fieldNames())
        refused = held.where(F.col("code") != intake.ACCEPTED).select(*intake.REJECTS.fieldNames())
        _publish(accepted, f"{staging}/logs", options.table, prefix)
        _publish(refused, f"{staging}/rejects", options.rejects, prefix)

    return store


def start(spark, name, options, once=False):
    """Start an intake, or return the running query when the options are the same; ``once`` takes what is there and stops."""
    key = (spark.sparkContext.applicationId, name)
    current = _running.get(key)
    if current and current[1].isActive:
        if current[0] != options:
            raise ValueError(f"an intake named {name} already runs with different options")
        return current[1]
    ensure_target(spark, options.table, options.create_table)
    writer = (
        request_stream(spark, options)
        .writeStream.foreachBatch(batch_writer(options))
        .queryName(name)
        .option("checkpointLocation", f"{options.checkpoint}/requests")
    )
    query = (writer.trigger(availableNow=True) if once else writer).start()
    _running[key] = (options, query)
    return query


def stop(name):
    """Stop an intake: 'stopped', or 'not found'."""
    keys = [key for key in _running if key[1] == name]
    for key in keys:
        _running.pop(key)[1].stop()
    return "stopped" if keys else "not found"


def run_available(spark, name, options):
    """Take in everything that has arrived, then stop."""
    start(spark, name, options, once=True).awaitTermination()
    _running.pop((spark.sparkContext.applicationId, name), None)
