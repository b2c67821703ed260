"""Web archives: written with an index, read back through it.

Each task writes archive files of its own and one index row per record: file, offset, length, URL, digest. Readers start from
the index: the selected records of a stretch of a file are sorted by offset, and neighbours are fetched with
one read. Each record is a gzip member of its own, so any of them can be read alone. Files go to the shared
folder through pyarrow's file systems (local and mounted paths, s3, gs, hdfs).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_folder

#: An archive is closed once it is that large, a read covers at most a stretch, and gaps up to the last are read over.
ARCHIVE_BYTES, STRETCH_BYTES, GAP_BYTES = 512 << 20, 16 << 20, 64 << 10
#: One time for all records: the tables have none, and results must not depend on the clock.
DATE = "1970-01-01T00:00:00Z"
_INDEX = "archive string, offset long, length long, page_id long, url string, digest string, record_type string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit holds no payload but names the response that does."""
    body = b"" if kind == "revisit" else payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + body + b"\r\n\r\n", 1, mtime=0)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of a record."""
    head, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record: {version[:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return headers, rest[:size]


class _Archive:
    """The file that a task is writing; the next one begins when it is full."""

    def __init__(self, folder: str):
        self.files, self.path = fs.FileSystem.from_uri(folder)
        self.folder, self.out, self.name, self.at = folder, None, "", 0
        self.files.create_dir(self.path, recursive=True)

    def add(self, raw: bytes) -> tuple[str, int]:
        if self.out is None or self.at >= ARCHIVE_BYTES:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.files.open_output_stream(f"{self.path}/{self.name}", compression=None)
        at, self.at = self.at, self.at + len(raw)
        self.out.write(raw)
        return f"{self.folder}/{self.name}", at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(folder)
        for batch in batches:
            rows = []
            ids, urls, payloads, firsts = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                page_id, url, first = ids[i].as_py(), urls[i].as_py(), firsts[i].as_py()
                payload = payloads[i].as_py() or b""
                kind = "response" if first is None or page_id is None or first == page_id else "revisit"
                digest = payload_digest(payload)
                raw = record(page_id, url, payload, digest, kind, first)
                rows.append((*archive.add(raw), len(raw), page_id, url, digest, kind))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in _INDEX.split(", ")]
            )
        archive.close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    revisit_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write a record per page below ``folder`` (default: the shared folder) and return the stored index.

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of at least ``revisit_bytes`` bytes that
    with the largest page_id is a response and the others revisit it; smaller ones are all responses. Rows that repeat
    the largest page_id are responses too, and so are rows with a null page_id. A task that is repeated writes new
    files; the index names those of the attempt that counted.
    """
    spark = pages.sparkSession
    folder = (folder or new_folder(spark, "warc")).rstrip("/")
    if "://" not in folder:
        folder = "file://" + folder
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("key", F.when(F.octet_length("payload") >= revisit_bytes, F.sha1("payload")))
    # sizes go along with the digest: a hot payload is one row per task here
    last = rows.where("key is not null").groupBy("key").agg(F.max("page_id").alias("first"))
    index_path = f"{folder}/index"
    (
        rows.join(last, "key", "left")
        .select("page_id", "url", "payload", "first")
        .mapInArrow(_written(f"{folder}/archives"), _INDEX)
        .write.parquet(index_path)
    )
    return spark.read.schema(_INDEX).parquet(index_path)


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of index rows (archive, offset, length), sorted: one read for neighbours."""
    opened, files = (None, None), {}
    pending: list[tuple[int, int]] = []

    def read() -> Iterator[pa.RecordBatch]:
        start, end = pending[0][0], pending[-1][0] + pending[-1][1]
        opened[1].seek(start)
        raw = opened[1].read(end - start)
        rows = []
        for at, length in pending:
            headers, body = parse(raw[at - start : at - start + length])
            if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != "sha1:" + payload_digest(body):
                raise ValueError(f"payload of {headers['WARC-Record-ID']} does not have its digest")
            own = headers["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
            other = headers.get("WARC-Refers-To", "").removeprefix("<urn:page:").removesuffix(">")
            rows.append(
                (
                    int(own) if own else None,
                    headers.get("WARC-Target-URI"),
                    headers["WARC-Type"],
                    headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                    int(other) if other else None,
                    body if headers["WARC-Type"] == "response" else None,
                )
            )
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
            names=["page_id", "url", "record_type", "digest", "refers_to", "payload"],
        )
        pending.clear()

    for batch in batches:
        for name, at, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if pending:
                start, end = pending[0][0], pending[-1][0] + pending[-1][1]
                if name != opened[0] or at - end > GAP_BYTES or at + length - start > STRETCH_BYTES:
                    yield from read()
            if name != opened[0]:
                if opened[1] is not None:
                    opened[1].close()
                folder, _, last = name.rpartition("/")
                if folder not in files:
                    files[folder] = fs.FileSystem.from_uri(folder)
                system, path = files[folder]
                opened = name, system.open_input_file(f"{path}/{last}")
            if not pending or (at, length) != pending[-1]:
                pending.append((at, length))
    if pending:
        yield from read()
    if opened[1] is not None:
        opened[1].close()


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of an index name: page_id, url, record_type, digest (base32 SHA-1), refers_to, payload.

    A revisit's payload is null; ``with_full_payloads`` finds its size. ``index`` may be any selection of an index; a row
    that occurs twice within a stretch is read once. No rows give no records.
    """
    stretch = F.floor(F.col("offset") / STRETCH_BYTES)
    partitions = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        index.select("archive", "offset", "length", stretch.alias("stretch"))
        .repartition(partitions, "archive", "stretch")
        .sortWithinPartitions("archive", "offset")
        .select("archive", "offset", "length")
        .mapInArrow(
            _fetched, "page_id long, url string, record_type string, digest string, refers_to long, payload binary"
        )
    )


def payload_sizes(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record, by what was read.

    Size and digest of a response are those of its payload; a revisit's are those of the response that it refers to.
    """
    measured = records.select(
        "page_id",
        "record_type",
        "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
    )
    responses = (
        measured.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("full_bytes"))
    )
    return measured.join(responses, ["refers_to", "payload_digest"], "left").select(
        "page_id",
        F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


def round_trip(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` and read all records back through the index."""
    return payload_sizes(read_records(write_archives(pages, **options)))
