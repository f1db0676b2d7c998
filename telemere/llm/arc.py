"""Converting legacy ARC archives to WARC, and reading both.

An ARC file opens with a version block, whose second line gives the version and whose
third names the fields of all header lines: five in version 1, ten in version 2. Each
record is a header line, as many bytes as its last field declares, and a line feed.
A record becomes a WARC record with an identifier made from its place and content, its
time as an ISO timestamp, a type, and SHA-1 digests of block and payload. Of records
with equal payloads one is a response, that with the largest page id; the others are
revisits that refer to it and carry the HTTP header alone.

Archives are written and read by Spark's own file sources, one archive of about
``ARCHIVE_BYTES`` a file, gzip-compressed, so they can lie in any store and lost tasks
are run again. A record larger than that is an archive of its own. Which payloads are equal
is found from narrow rows; of the payloads themselves only those that a Bloom filter
cannot clear are moved.

Defined cases: a null html is an empty payload; a null or blank url is ``urn:page:`` and
the id; white space in a url is percent-encoded; a null page id is kept as such and
smaller than any other; rows that repeat an id and a payload are separate records of which
one is the response. Columns other than ``page_id``, ``url`` and ``html`` may have any name.
Payloads to be written must be UTF-8; ``parse_arc`` reads any bytes. A header line with too
few fields, or a length that runs past the end, fails the job. An empty table gives no rows.
"""

import base64
import gzip
import hashlib
import uuid
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import functions as F

from telemere.llm import bloom
from telemere.llm.tables import join_groups, kept, map_arrow
from telemere.session import shared_dir

ARCHIVE_BYTES = 8 << 20
#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 0

# Field lines of the two ARC versions and the WARC profile of revisits (fixed values of the formats).
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ORIGIN = "telemere"
_EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
_IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:telemere:arc")

RECORD = (
    "archive string, position long, page_id long, uri string, ip string, date string, mime string, "
    "head binary, payload binary, payload_bytes long, digest string"
)


def sha1(data):
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ARC


def _arc_head(name, date, version):
    body = f"{version} 0 {_ORIGIN}\n{FIELDS[version]}\n\n"
    middle = "200 - - 0 " + name + " " if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain {middle}{len(body)}\n{body}"


def _url(url, page_id):
    url = "".join(f"%{ord(c):02X}" if c.isspace() and ord(c) < 128 else c for c in url or "")
    return "".join("%20" if c.isspace() else c for c in url) or f"urn:page:{'' if page_id is None else page_id}"


def arc_record(page_id, url, html, version, name="-"):
    """One ARC record of a page: header line, HTTP response, line feed."""
    payload = (html or "").encode()
    mark = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(payload)}\r\n\r\n"
    block = block.encode() + payload
    date = (_EPOCH + timedelta(seconds=(page_id or 0) % (10 * 365 * 86400))).strftime("%Y%m%d%H%M%S")
    middle = f"200 {sha1(payload)} - 0 {name} " if version == 2 else ""
    line = f"{_url(url, page_id)} 127.0.0.1 {date} text/html {middle}{len(block)}\n"
    return line.encode() + block + b"\n"


def _packed(records, head):
    """Archives of about ARCHIVE_BYTES as texts, each without its last line feed, which the text sink writes."""
    parts, size = [], 0
    for record in records:
        if parts and size + len(record) > ARCHIVE_BYTES:
            yield _archive(head, parts)
            parts, size = [], 0
        parts.append(record)
        size += len(record)
    if parts:
        yield _archive(head, parts)


def _archive(head, parts):
    name = uuid.uuid5(_IDS, hashlib.sha1(b"".join(parts)).hexdigest()).hex
    return (head(name) + b"".join(parts))[:-1].decode()


def _texts(archives):
    for text in archives:
        yield pa.record_batch([pa.array([text], pa.string())], names=["value"])


def write_arc(pages, path, version=1):
    """Pages as ARC archives below ``path``."""

    def run(batches):
        rows = (
            row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        )
        records = (arc_record(page_id, url, html, version) for page_id, url, html in rows)
        return _texts(_packed(records, lambda name: _arc_head(name, "20240101000000", version).encode()))

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    _write(map_arrow(rows, run, "value string"), path)


def _write(archives, path):
    quick = {"maxRecordsPerFile": 1, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    archives.write.options(**quick).text(path)


def _split(block):
    """HTTP header and payload of a block."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    return (head + mark, payload) if mark and head.startswith(b"HTTP/") else (b"", block)


def _http_field(head, name):
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("latin-1")
    return None


def parse_arc(data):
    """Yield (position, fields, block) of the records of an ARC file; fields by the names of its version block."""
    line, at = _line(data, 0)
    opening = line.split(" ")
    if not opening[0].startswith("filedesc://"):
        raise ValueError("an ARC file opens with a version block")
    body = data[at : at + int(opening[-1])].decode("latin-1").split("\n")
    version = int(body[0].split(" ")[0])
    names = (body[1] if len(body) > 1 and body[1].strip() else FIELDS[version]).split(" ")
    at += int(opening[-1])
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        start = at
        line, at = _line(data, at)
        values = line.split(" ")
        if len(values) != len(names):
            raise ValueError(f"an ARC header line of version {version} has {len(names)} fields, not {len(values)}")
        fields = dict(zip(names, values, strict=True))
        end = at + int(fields["Archive-length"])
        if end > len(data):
            raise ValueError("an ARC record runs past the end of its file")
        yield start, fields, data[at:end]
        at = end


def _line(data, at):
    end = data.find(b"\n", at)
    if end < 0:
        raise ValueError("a header line has no end")
    return data[at:end].rstrip(b"\r").decode("utf-8", "surrogateescape"), end + 1


def _files(spark, path):
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _contents(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            content = batch.column(1)[i].as_py()
            if content[:2] == b"\x1f\x8b":
                content = gzip.decompress(content)
            if content:
                yield batch.column(0)[i].as_py(), content


def _schema(text):
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in text.split(", "))])


def _emit(rows, schema):
    """Rows as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes)) + 200
        if size > ARCHIVE_BYTES:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def read_arc(spark, path, payloads=True):
    """The records of all ARC files below ``path``."""

    def rows(batches):
        for name, data in _contents(batches):
            for position, fields, block in parse_arc(data):
                head, payload = _split(block)
                page = _http_field(head, b"x-page-id")
                yield (
                    name,
                    position,
                    None if page is None else int(page),
                    fields["URL"],
                    fields["IP-address"],
                    fields["Archive-date"],
                    fields["Content-type"],
                    head if payloads else b"",
                    payload if payloads else b"",
                    len(payload),
                    sha1(payload),
                )

    schema = _schema(RECORD)
    return map_arrow(_files(spark, path), lambda batches: _emit(rows(batches), schema), RECORD)


# WARC


def record_id(uri, date, digest, page_id):
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{uri} {date} {digest} {page_id}')}>"


def _timestamp(date):
    return datetime.strptime(date[:14].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def _warc_record(fields, block):
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def warc_record(record):
    """The WARC record of an ARC record whose type is decided."""
    revisit = record["record_type"] == "revisit"
    block = record["head"] + (b"" if revisit else record["payload"])
    fields = [
        ("WARC-Type", record["record_type"]),
        ("WARC-Record-ID", record_id(record["uri"], record["date"], record["digest"], record["page_id"])),
        ("WARC-Date", _timestamp(record["date"])),
        ("WARC-Target-URI", record["uri"]),
        ("WARC-IP-Address", record["ip"]),
        ("WARC-Payload-Digest", "sha1:" + record["digest"]),
        ("WARC-Block-Digest", "sha1:" + sha1(block)),
        ("Content-Type", "application/http; msgtype=response" if record["head"] else record["mime"]),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record["refers_to_id"]),
            ("X-Payload-Length", record["payload_bytes"]),
            ("X-Refers-To-Page", record["refers_to"]),
        ]
    return _warc_record(fields, block)


def _warc_head(name):
    block = f"software: {_ORIGIN}\r\nformat: WARC File Format 1.1\r\n".encode()
    fields = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.UUID(name)}>"),
        ("WARC-Date", _EPOCH.strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Filename", f"{name}.warc.gz"),
        ("Content-Type", "application/warc-fields"),
    ]
    return _warc_record(fields, block)


def decide(records, narrow, least=LEAST_REVISIT):
    """``records`` with record_type, refers_to and refers_to_id. ``narrow``: the same records without payloads."""
    keys = kept(
        narrow.filter(F.col("payload_bytes") >= least).select(
            F.unhex(F.sha2("digest", 256)).alias("content"), "digest", "page_id", "archive", "position", "uri", "date"
        ),
        "payloads",
    )
    total = keys.count()
    bits = bloom.filter_bits(total)
    order = F.struct("page_id", "archive", "position")
    groups = (
        keys.groupBy("digest")
        .agg(
            F.max_by(F.struct("page_id", "archive", "position", "uri", "date"), order).alias("first"),
            F.count(F.lit(1)).alias("copies"),
        )
        .filter("copies > 1")
    )
    probed = bloom.probe(
        records.withColumn("content", F.unhex(F.sha2("digest", 256))),
        bloom.repeated(keys, "content", bits),
        F.col("content"),
        bits,
        "suspect",
    ).drop("content")
    suspect = F.col("suspect") & (F.col("payload_bytes") >= least)
    alone = probed.filter(~suspect).drop("suspect")
    none = F.lit(None)
    alone = alone.withColumns(
        {"record_type": F.lit("response"), "refers_to": none.cast("long"), "refers_to_id": none.cast("string")}
    )
    found = join_groups(probed.filter(suspect).drop("suspect"), groups, "digest", "copies", max(total, 1))
    first = F.col("first.archive").isNull() | (
        (F.col("first.archive") == F.col("archive")) & (F.col("first.position") == F.col("position"))
    )
    found = found.withColumns(
        {
            "record_type": F.when(first, "response").otherwise("revisit"),
            "refers_to": F.when(~first, F.col("first.page_id")),
            "refers_to_id": F.when(~first, F.to_json("first")),
        }
    )
    return alone.unionByName(found.select(alone.columns))


def write_warc(records, path):
    """Decided records as WARC archives below ``path``."""
    names = ["page_id", "uri", "ip", "date", "mime", "head", "payload", "payload_bytes", "digest"]
    names += ["record_type", "refers_to", "refers_to_uri", "refers_to_date"]
    first = F.from_json("refers_to_id", "uri string, date string")
    rows = records.withColumns({"refers_to_uri": first["uri"], "refers_to_date": first["date"]}).select(*names)

    def run(batches):
        def made():
            for batch in batches:
                for i in range(batch.num_rows):
                    record = {n: batch.column(j)[i].as_py() for j, n in enumerate(names)}
                    if record["record_type"] == "revisit":
                        record["refers_to_id"] = record_id(
                            record["refers_to_uri"], record["refers_to_date"], record["digest"], record["refers_to"]
                        )
                    yield warc_record(record)

        return _texts(_packed(made(), _warc_head))

    _write(map_arrow(rows, run, "value string"), path)


def parse_warc(data):
    """Yield (fields, block) of the records of a WARC file."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError("a WARC record opens with its version")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        at = end + 4 + int(fields["content-length"])
        if at > len(data):
            raise ValueError("a WARC record runs past the end of its file")
        yield fields, data[end + 4 : at]


def read_warc(spark, path):
    """Response and revisit records of all WARC files below ``path``; digests of responses are checked."""
    text = (
        "page_id long, uri string, date string, record_id string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )

    def rows(batches):
        for _, data in _contents(batches):
            for fields, block in parse_warc(data):
                if fields["warc-type"] not in ("response", "revisit"):
                    continue
                head, payload = _split(block)
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                size = len(payload)
                refers = None
                if fields["warc-type"] == "revisit":
                    size = int(fields["x-payload-length"])
                    refers = fields.get("x-refers-to-page")
                elif sha1(payload) != digest:
                    raise ValueError(f"the payload of {fields['warc-record-id']} does not match its digest")
                page = _http_field(head, b"x-page-id")
                yield (
                    None if page is None else int(page),
                    fields["warc-target-uri"],
                    fields["warc-date"],
                    fields["warc-record-id"],
                    size,
                    digest,
                    fields["warc-type"],
                    None if refers is None else int(refers),
                )

    schema = _schema(text)
    return map_arrow(_files(spark, path), lambda batches: _emit(rows(batches), schema), text)


def convert(spark, arc_path, warc_path, least=LEAST_REVISIT):
    """Convert all ARC archives below one path to WARC archives below another."""
    write_warc(decide(read_arc(spark, arc_path), read_arc(spark, arc_path, payloads=False), least), warc_path)


def round_trip(pages, version=1, least=LEAST_REVISIT):
    """Pages written as ARC, converted to WARC and read back: one row per page."""
    spark = pages.sparkSession
    old, new = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    write_arc(pages, old, version)
    convert(spark, old, new, least)
    return read_warc(spark, new).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
