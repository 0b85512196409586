"""WARC archives: written by Spark's text writer, read by a Python data source with header push-down."""

import gzip
import posixpath
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The marks of the format, version 1.1.
VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 50_000
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
SKIP_BYTES = 1 << 20

#: Columns that come from named header fields; push-down works on these.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "record_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
SCHEMA = ", ".join(
    [*(f"{name} string" for name in HEADERS), "headers map<string,string>", "content_length long", "http map<string,string>",
     "payload binary", "file string", "position long"]
)


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html"
) -> None:
    """Write one record per row to gzip files under ``path``.

    Of rows with equal payloads of at least 1000 bytes the one with the largest id is the response and the others are
    revisits of it; rows that repeat that largest id are responses too, and so are all rows if no id is known. A null
    body is an empty payload; a null url or id leaves its field out; a row without an id is a revisit if some id owns
    its payload. Equal means equal SHA-1. Line breaks in a url are percent-encoded.

    Owners come from an aggregate of (digest, id) with map-side partials, joined back on the digest; if one payload holds
    a third of all rows, adaptive execution splits that side of the join. The text writer commits files by task, so a
    lost executor leaves no half archive.
    """
    body = F.coalesce(F.col(body_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("body")).withColumns(
        {"digest": F.sha1(F.encode("body", "UTF-8")), "size": F.octet_length("body")}
    )
    owners = (
        rows.where(F.col("size") >= MIN_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("id").alias("owner"), F.count("*").alias("copies"))
        .where("copies > 1 and owner is not null")
        .select("digest", "owner")
    )
    revisit = F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.concat("http", F.when(F.col("revisit"), F.lit("")).otherwise(F.col("body")))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    record = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page("id")),
        line("WARC-Target-URI", url),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(F.col("revisit"), page("owner"))),
        line("WARC-Profile", F.when(F.col("revisit"), F.lit(IDENTICAL_PAYLOAD))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(RECORD_END),
        F.col("block"),
    )
    marked = rows.join(owners, "digest", "left").withColumn("revisit", revisit)
    shaped = marked.withColumn("http", http).withColumn("block", block).select(record.alias("value"))
    shaped.write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


@dataclass
class FileSpan(InputPartition):
    files: list[str] = field(default_factory=list)


def parse_fields(lines: bytes) -> dict[str, str]:
    """Header fields by lower-case name; folded lines continue the one before; the last of equal names wins."""
    fields: dict[str, str] = {}
    name = ""
    for raw in lines.split(b"\n"):
        text = raw.rstrip(b"\r").decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            fields[name] += " " + text.strip()
        elif ":" in text:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def admits(value: str | None, test: Filter) -> bool:
    match test:
        case EqualTo():
            return value == test.value
        case In():
            return value in test.value
        case IsNotNull():
            return value is not None
    if value is None:
        return False
    match test:
        case StringStartsWith():
            return value.startswith(test.value)
        case StringEndsWith():
            return value.endswith(test.value)
        case StringContains():
            return test.value in value
    return True


def records(stream, tests: list[tuple[str, Filter]], payload: bool, name: str) -> Iterator[dict]:
    """Records of one archive in order. The header is read first; the block of a record that a test refuses, or whose
    payload is not asked for, is passed over in steps without being decoded or kept."""
    position = 0
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            position += len(line)
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no record starts at byte {position}")
        start = position
        head = []
        position += len(line)
        while (line := stream.readline()).strip():
            head.append(line)
            position += len(line)
        position += len(line)
        fields = parse_fields(b"".join(head))
        length = int(fields.get("content-length", "-1"))
        if not line or length < 0:
            raise ValueError(f"{name}: the header at byte {start} is cut or has no length")
        wanted = all(admits(fields.get(HEADERS[column]), test) for column, test in tests)
        left = length
        http: dict[str, str] = {}
        body = None
        if wanted and fields.get("content-type", "").startswith("application/http"):
            lines = []
            while left and (line := stream.readline(left)):
                left -= len(line)
                if not line.strip():
                    break
                lines.append(line)
            http = parse_fields(b"".join(lines[1:]))
        if wanted and payload:
            body = stream.read(left)
            left -= len(body)
        while left:
            skipped = len(stream.read(min(left, SKIP_BYTES)))
            if not skipped:
                raise ValueError(f"{name}: the block at byte {start} is cut")
            left -= skipped
        position += length
        if wanted:
            yield {
                **{column: fields.get(key) for column, key in HEADERS.items()},
                "headers": list(fields.items()),
                "content_length": length,
                "http": list(http.items()),
                "payload": body,
                "file": name,
                "position": start,
            }


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: pa.Schema):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.schema = schema
        self.tests: list[tuple[str, Filter]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes tests of header columns; hands the rest back."""
        for test in filters:
            column = getattr(test, "attribute", ("",))
            known = isinstance(test, EqualTo | In | IsNotNull | StringStartsWith | StringEndsWith | StringContains)
            if known and len(column) == 1 and column[0] in HEADERS:
                self.tests.append((column[0], test))
            else:
                yield test

    def partitions(self) -> list[FileSpan]:
        """Archives under the path, packed in order of name to parts of about 128 MB; an archive is never cut."""
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(self.path) if ":/" in self.path else (fs.LocalFileSystem(), self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        spans, size = [FileSpan()], 0
        for info in sorted(found, key=lambda i: i.path):
            name = posixpath.basename(info.path)
            if info.type != fs.FileType.File or name.startswith(("_", ".")):
                continue
            if size + info.size > PARTITION_BYTES and spans[-1].files:
                spans.append(FileSpan())
                size = 0
            spans[-1].files.append(info.path)
            size += info.size
        return spans

    def read(self, partition: FileSpan) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system = fs.FileSystem.from_uri(self.path)[0] if ":/" in self.path else fs.LocalFileSystem()
        rows, size = [], 0
        for name in partition.files:
            with system.open_input_stream(name, compression=None) as raw:
                stream = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else pa.PythonFile(raw, mode="r")
                stream = stream if name.endswith(".gz") else Plain(raw)
                for row in records(stream, self.tests, self.payload, name):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 1000
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, self.schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, self.schema)


class Plain:
    """Lines and bytes of an uncompressed Arrow stream."""

    def __init__(self, raw):
        import io

        self.lines = io.BufferedReader(raw, SKIP_BYTES)

    def readline(self, size: int = -1) -> bytes:
        return self.lines.readline(size)

    def read(self, size: int) -> bytes:
        return self.lines.read(size)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``; option ``payload`` (true) says whether payloads are read."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        text, long, binary = pa.string(), pa.int64(), pa.binary()
        kinds = {"headers": pa.map_(text, text), "http": pa.map_(text, text), "payload": binary}
        kinds |= {"content_length": long, "position": long}
        return WarcReader(self.options, pa.schema([(f.name, kinds.get(f.name, text)) for f in schema.fields]))


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives under a path. Tests of record type and header columns reach the reader, if they are plain
    comparisons; refused records are passed over by their length, header only."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages, read them back, and describe each record.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, url). Size and digest of a response are taken from
    the payload read; a revisit has none, so they are its header's.
    """
    write_archives(pages, path)
    got = read_archives(pages.sparkSession, path)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    full = F.col("record_type") == "response"
    return got.select(
        number("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("http")["content-length"].try_cast("long")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
        F.col("target_uri").alias("url"),
    )
