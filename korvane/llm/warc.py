"""WARC archives as a data source: a writer, and a reader that splits compressed archives into byte ranges.

spark.dataSource.register(WarcSource) makes format "korvane_warc" known. Each record is a gzip member of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import new_path, stage

MAGIC = b"\x1f\x8b\x08"
RANGE_BYTES = 16 << 20
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"
SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of so many bytes and more are stored once.
DEDUP_BYTES = 1000

RECORDS = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary, offset long, file string"
WRITES = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def one_line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(r: dict) -> bytes:
    """One record, compressed. Revisits hold the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_bytes']}\r\n\r\n".encode()
    block = http + (r["payload"] or b"" if r["record_type"] == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {r['record_type']}",
        f"WARC-Record-ID: <{one_line(r['record_id'])}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(r['payload_digest'])).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if r["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {one_line(r['target_uri'])}")
    if r["record_type"] == "revisit":
        head += [f"WARC-Profile: {SAME}", f"WARC-Refers-To: <{one_line(r['refers_to'])}>"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def sha1_of(digest: str) -> str | None:
    """Lower-case hex of a payload digest header in base 32 or hex; None for another algorithm or spelling."""
    value = digest.removeprefix("sha1:")
    if not digest.startswith("sha1:"):
        return None
    if re.fullmatch("[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch("[A-Za-z2-7]{32}", value) else None


def parse(raw: bytes) -> dict | None:
    """The record that a decoded member holds; None if it holds none."""
    if not raw.startswith(b"WARC/1."):
        return None
    end = raw.find(b"\r\n\r\n")
    head = dict(x.split(": ", 1) for x in raw[:end].decode("utf-8", "replace").split("\r\n")[1:] if ": " in x) if end > 0 else {}
    if not head.get("Content-Length", "").isdigit() or "WARC-Type" not in head:
        return None
    block = raw[end + 4 : end + 4 + int(head["Content-Length"])]
    if len(block) != int(head["Content-Length"]):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    whole = re.search(rb"(?i)^content-length: *(\d+)", http, re.M)
    return {
        "record_id": head.get("WARC-Record-ID", "").strip("<>") or None,
        "record_type": head["WARC-Type"],
        "target_uri": head.get("WARC-Target-URI"),
        "refers_to": head["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in head else None,
        "payload_digest": hashlib.sha1(payload).hexdigest() if head["WARC-Type"] == "response" else sha1_of(head.get("WARC-Payload-Digest", "")),
        "payload_bytes": len(payload) if head["WARC-Type"] == "response" else int(whole[1]) if whole else None,
        "payload": payload if head["WARC-Type"] == "response" else None,
    }


class Tape:
    """Bytes of a file from `start` on, read as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.start, self.held = file, start, bytearray()
        file.seek(start)

    def reach(self, size: int) -> bool:
        """Hold the first `size` bytes, if there are so many."""
        while len(self.held) < size:
            more = self.file.read(max(READ_BYTES, size - len(self.held)))
            if not more:
                return False
            self.held += more
        return True


def member(tape: Tape, at: int) -> tuple[bytes, int] | None:
    """The decoded gzip member that starts at `at`, and where it ends. None: it is none, or no WARC record."""
    unpack, out, done = zlib.decompressobj(31), bytearray(), at
    while not unpack.eof:
        if done >= len(tape.held) and not tape.reach(done + 1):
            return None
        piece = bytes(tape.held[done : done + 65536])
        done += len(piece)
        try:
            out += unpack.decompress(piece)
        except zlib.error:
            return None
        if not out[:7] == b"WARC/1."[: len(out)]:
            return None
    return bytes(out), done - len(unpack.unused_data)


def records_in(file, start: int, end: int, damaged: bool = False) -> Iterator[tuple[int, dict]]:
    """(offset, record) of each record whose member starts in [start, end).

    The range is searched for the gzip magic. A candidate counts only if it decodes, checksum included, to a WARC record;
    the next member is then looked for right behind it, and by search again after damage. A member that starts inside is
    read to its end, beyond the range if need be; one that starts before belongs to the range before. With `damaged`, a
    stretch behind a record or at the file's start that holds no record gives an entry of type "damaged" at its offset.
    """
    tape, at = Tape(file, start), 0
    due = 0 if start == 0 else None  # where a record has to start
    while start + at < end:
        if damaged and due is not None and at > due:
            yield start + due, {"record_type": "damaged"}
            due = None
        tape.reach(at + READ_BYTES)
        at = tape.held.find(MAGIC, at)
        while at < 0 and start + len(tape.held) < end + len(MAGIC):
            before = max(0, len(tape.held) - len(MAGIC) + 1)
            if not tape.reach(len(tape.held) + READ_BYTES) and before >= len(tape.held) - len(MAGIC) + 1:
                break
            at = tape.held.find(MAGIC, before)
        if at < 0 or start + at >= end:
            if damaged and due is not None and start + due < min(end, start + len(tape.held)):
                yield start + due, {"record_type": "damaged"}
            return
        if damaged and due is not None and at > due:
            yield start + due, {"record_type": "damaged"}
            due = None
        found = member(tape, at)
        parsed = parse(found[0]) if found else None
        if parsed:
            yield start + at, parsed
            at = due = found[1]
            if at > 4 * READ_BYTES:  # what lies behind is not needed again
                del tape.held[:at]
                start, at, due = start + at, 0, 0
        else:
            at += 1


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    path: str
    rows: int


class WarcReader(DataSourceReader):
    """Options: path (a folder or a file), rangeBytes, damaged (true: rows of type "damaged" for stretches without a record)."""

    def __init__(self, options: dict):
        self.damaged = str(options.get("damaged", "")).lower() == "true"
        self.path, self.size = options["path"], int(options.get("rangebytes") or options.get("rangeBytes") or RANGE_BYTES)

    def partitions(self) -> list[Range]:
        system, path = fs.FileSystem.from_uri(self.path)
        info = system.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
        found = [Range(f.path, a, min(a + self.size, f.size)) for f in sorted(files, key=lambda f: f.path) if f.path.endswith(".warc.gz") and "/." not in f.path for a in range(0, f.size, self.size)]
        return found or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        arrow = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in RECORDS.split(", "))])
        if not partition.path:
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        rows, size = [], 0
        with system.open_input_file(partition.path) as file:
            for offset, r in records_in(file, partition.start, partition.end, self.damaged):
                rows.append(r | {"offset": offset, "file": partition.path})
                size += len(r.get("payload") or b"")
                if size > 8 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_pylist(rows, arrow)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)


class WarcWriter(DataSourceArrowWriter):
    """Tasks write archives into a hidden folder of the job. A committed job drops what failed attempts left and shows the folder by one move."""

    def __init__(self, options: dict):
        self.path, self.job = options["path"], uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(f"{path}/.{self.job}", recursive=True)
        target, rows = f"{path}/.{self.job}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", 0
        with system.open_output_stream(target, compression=None) as out:
            for batch in iterator:
                for r in batch.to_pylist():
                    out.write(record(r))
                    rows += 1
        return Written(target, rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(f"{path}/.{self.job}", recursive=True)
        done = {m.path.rpartition("/")[2] for m in messages if m and m.rows}
        for f in system.get_file_info(fs.FileSelector(f"{path}/.{self.job}")):
            if f.base_name not in done:
                system.delete_file(f.path)
        system.move(f"{path}/.{self.job}", f"{path}/{self.job}")

    def abort(self, messages: list[Written | None]) -> None:
        system, path = fs.FileSystem.from_uri(self.path)
        if system.get_file_info(f"{path}/.{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/.{self.job}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "korvane_warc"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A record for each row of pages, in the columns of WRITES.

    Of rows with equal payloads of DEDUP_BYTES and more the one with the largest id is the response and the others
    revisit it; a null html is an empty payload, a null url leaves out the header. A null id is never revisited, and
    rows that share the largest id are all responses.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    groups = stage(rows.where(F.col("payload_bytes") >= DEDUP_BYTES).groupBy("payload_digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").drop("n"), "warc-groups")
    rows = rows.join(groups, "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    name = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("none:"), F.expr("uuid()")))
    return rows.select(
        F.concat(F.lit("urn:page:"), name).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(again, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Append the records of page_records to the archives under path. An empty table adds none."""
    pages.sparkSession.dataSource.register(WarcSource)
    page_records(pages, id_col, url_col, html_col).write.format("korvane_warc").mode("append").option("path", path).save()


def read_archives(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, damaged: bool = False) -> DataFrame:
    """All records of the archives under path: columns RECORDS. damaged adds rows for stretches that hold no record."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("korvane_warc").option("path", path).option("rangeBytes", str(range_bytes)).option("damaged", str(damaged).lower()).load()


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives in the shared folder and read back."""
    path = new_path(spark, "warc")
    write_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    number = lambda c: F.try_to_number(F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1), F.lit("S9999999999999999999")).cast("long")
    out = read_archives(spark, path)
    return out.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), F.col("target_uri").alias("url"))


OP3_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload FROM pages
), g AS (
  SELECT payload, max(page_id) AS first FROM p WHERE strlen(payload) >= 1000 GROUP BY payload HAVING count(*) > 1
)
SELECT p.page_id, strlen(p.payload) AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN g.first IS NULL OR g.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.first != p.page_id THEN g.first END AS refers_to, p.url
FROM p LEFT JOIN g ON p.payload = g.payload
"""
