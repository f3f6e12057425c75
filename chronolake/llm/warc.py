"""Legacy archives (ARC) written, converted to WARC, and read back.

``write_arc`` puts pages into ARC files (version 1 or 2 header lines). ``convert`` reads ARC files of
either version, whose version block names the fields of every header line, follows the declared
lengths, and synthesises WARC records: identifiers from address, date, digest and place; dates from
the 14-digit form; type response, or revisit for what repeats a payload; payload digests. ``read``
reads WARC files back.

Files are written and read by Spark's own text and binary sources, so any file system that Spark
reaches will do. A task gathers records, each a gzip member of its own, to files of some ``BYTES`` bytes
(a larger record is a file alone); the writer ends a file with a zero byte, which gzip takes as padding.
A file is read as one value, as it is compressed, and its records are unpacked one after the other, so
that a task holds a file and a record. Archives that others wrote may be compressed in any number of
members, or not at all.

Of the records with equal payloads of at least ``LEAST`` bytes, that with the largest page_id (of
rows that repeat it, the first in the archive) is the response and the others are revisits. Only keys
and digests are shuffled for that. Archives are then converted in slices of ``FILES`` files and ``AGAIN``
revisits at most (a file with more is a slice alone), so that a slice's list of revisits can be sent to all
tasks and contents are never shuffled. The driver knows files by name and count only, as any scan does.

Nulls: a null html is an empty payload; a null url is written as ``about:blank``; a null page_id stays
null and loses against any other. Blanks and control characters in a url are percent-coded. Repeated
rows are records of their own. A page may be very long. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.llm import common

LEAST, BYTES, FILES, AGAIN = 1000, 16 << 20, 4096, 500_000
ADDRESS, DATE = "0.0.0.0", "20240101000000"

# The field lists of the two ARC versions and the line ends of the two formats.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_END, WARC_END = b"\n", b"\r\n\r\n"

def _member(record: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def _gathered(records, head: Callable[[int], bytes], most: int):
    """Files of records, each begun with ``head`` of its number."""
    out, size, n = [], 0, 0
    for record in records:
        if not out:
            out, n = [_member(head(n))], n + 1
            size = len(out[0])
        out.append(_member(record))
        size += len(out[-1])
        if size >= most:
            yield b"".join(out)
            out = []
    if out:
        yield b"".join(out)


def _write(rows: DataFrame, path: str, mode: str = "error") -> None:
    """A file for each row of ``record``."""
    rows.select(F.col("record").cast("string")).write.mode(mode).options(lineSep="\0", maxRecordsPerFile=1, compression="none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _unpacked(content: bytes, step: int = 1 << 16):
    """The bytes of a file of any number of gzip members, or of none, in parts."""
    view, at = memoryview(content), 0
    if content[:2] != b"\x1f\x8b":
        yield from (bytes(view[k : k + step]) for k in range(0, len(view), step))
        return
    while at < len(view):
        if not view[at]:  # padding
            at += 1
            continue
        z = zlib.decompressobj(31)
        while not z.eof and at < len(view):
            part = view[at : at + step]
            out = z.decompress(part)
            at += len(part) - len(z.unused_data)
            if out:
                yield out
        if not z.eof:
            raise ValueError("the archive ends within a gzip member")


class Stream:
    """Reads an archive from front to back."""

    def __init__(self, content: bytes):
        self.parts, self.buffer, self.at = _unpacked(content), bytearray(), 0

    def _more(self) -> bool:
        part = next(self.parts, b"")
        self.buffer += part
        return bool(part)

    def take(self, n: int) -> bytes:
        """The next n bytes, or what there is."""
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.at += len(out)
        return out

    def until(self, mark: bytes) -> bytes | None:
        """The bytes before the next ``mark``, which is passed; None if there is none."""
        start = 0
        while (i := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return None
        out = self.take(i)
        self.take(len(mark))
        return out


def _version_block(version: int, name: str) -> bytes:
    block = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    rest = f" 0 - - 0 {name}" if version == 2 else ""
    return f"filedesc://{name} {ADDRESS} {DATE} text/plain{rest} {len(block)}\n".encode() + block


def write_arc(pages: DataFrame, path: str, version: int = 1, most: int = BYTES) -> None:
    """Writes page_id, url, html as ARC files of some ``most`` bytes."""

    def records(batches):
        n = 0
        for batch in common.parts(batches):
            for page_id, url, html in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html")), strict=True):
                n += 1
                payload = (html or "").encode("utf-8", "surrogatepass")
                named = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
                body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n%s" % (named, len(payload), payload)
                url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
                rest = f" 200 {zlib.crc32(body):08x} - {n} pages.arc" if version == 2 else ""
                yield f"{url} {ADDRESS} {DATE} text/html{rest} {len(body)}\n".encode() + body + ARC_END

    def work(batches):
        for file in _gathered(records(batches), lambda n: _version_block(version, f"pages-{n}.arc") + ARC_END, most):
            yield pa.RecordBatch.from_arrays([pa.array([file], pa.binary())], names=["record"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    _write(rows.mapInArrow(work, "record binary"), path)


def arc_records(content: bytes):
    """(offset, fields, body) of each record after the version block, whatever the version. Offsets count
    unpacked bytes."""
    stream, names = Stream(content), []
    while True:
        at = stream.at
        line = stream.until(b"\n")
        if line is None:
            break
        if not line:  # the separator between records
            continue
        said = line.decode("utf-8", "replace").split(" ")
        length = int(said[-1])
        body = stream.take(length)
        if len(body) < length:
            raise ValueError(f"ARC record at {at}: {length} bytes declared, {len(body)} there")
        if said[0].startswith("filedesc://"):
            names = body.decode("utf-8", "replace").split("\n")[1].split(" ")
        elif len(said) != len(names):
            raise ValueError(f"ARC record at {at}: {len(said)} fields, {len(names)} named by the version block")
        else:
            yield at, dict(zip(names, said, strict=True)), body


def _http(body: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    head, _, payload = body.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return head + b"\r\n\r\n", payload, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _identity(path: str, at: int, fields: dict[str, str], digest: str) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{fields['URL']} {fields['Archive-date']} {digest} {path.rsplit('/', 1)[-1]} {at}"))


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def _table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _index(files: DataFrame) -> DataFrame:
    """path, at, page_id, bytes, digest, id of every ARC record."""
    kinds = {"path": pa.string(), "at": pa.int64(), "page_id": pa.int64(), "bytes": pa.int64(), "digest": pa.string(), "id": pa.string()}

    def work(batches):
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                rows = []
                for at, fields, body in arc_records(content):
                    _, payload, said = _http(body)
                    digest = hashlib.sha1(payload).hexdigest()
                    rows.append((path, at, _number(said.get("x-page-id")), len(payload), digest, _identity(path, at, fields, digest)))
                yield _table(rows, kinds)

    return files.mapInArrow(work, "path string, at long, page_id long, bytes long, digest string, id string")


def _iso(stamp: str) -> str:
    d = (stamp + "00000000000000")[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _record(kind: str, name: str, date: str, block: bytes, more: list[str]) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}", *more, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + WARC_END


def slices(counts, most_files: int, most_rows: int):
    """Lists of paths from (path, n) in order, each of ``most_files`` paths and ``most_rows`` at most, or of one path."""
    out, rows = [], 0
    for path, n in counts:
        if out and (len(out) == most_files or rows + n > most_rows):
            yield out
            out, rows = [], 0
        out.append(path)
        rows += n
    if out:
        yield out


def _slice(spark: SparkSession, paths: list[str], again: DataFrame) -> DataFrame:
    """path, content and again of the files at the sorted ``paths``."""
    files = spark.read.format("binaryFile").load([re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]).select("path", "content")
    return files.join(F.broadcast(again.filter(F.col("path").between(paths[0], paths[-1]))), "path", "left")


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST, most: int = BYTES, most_files: int = FILES, most_again: int = AGAIN) -> None:
    """Writes the WARC equivalent of all ARC files below ``arc_path``."""
    index = common.staged(_index(_files(spark, arc_path)), "arc-index")
    order = F.struct(F.col("page_id").isNotNull(), "page_id", F.col("path").alias("p"), "at")
    kept = index.filter(F.col("bytes") >= least).groupBy("digest").agg(F.max_by("id", order).alias("to"), F.count("*").alias("n")).filter("n > 1")
    again = index.filter(F.col("bytes") >= least).join(kept, "digest").filter(F.col("id") != F.col("to"))
    again = again.groupBy("path").agg(F.collect_list(F.struct("at", "to")).alias("again"))  # no more than a file has records
    again = common.staged(again.sort("path"), "arc-again")
    counts = _files(spark, arc_path).select("path").join(again.select("path", F.size("again").alias("n")), "path", "left").select("path", F.coalesce("n", F.lit(0)).alias("n"))

    def records(path, content, refers):
        for at, fields, body in arc_records(content):
            head, payload, _ = _http(body)
            sha = hashlib.sha1(payload)
            more = [f"WARC-Target-URI: {fields['URL']}", f"WARC-IP-Address: {fields['IP-address']}", f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode()}", "Content-Type: application/http; msgtype=response"]
            if at in refers:
                more += [f"WARC-Refers-To: <urn:uuid:{refers[at]}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
            kind, block = ("revisit", head) if at in refers else ("response", body)
            yield _record(kind, _identity(path, at, fields, sha.hexdigest()), _iso(fields["Archive-date"]), block, more)

    def work(batches):
        for batch in batches:
            for path, content, seen in zip(*(batch[c].to_pylist() for c in ("path", "content", "again")), strict=True):
                name = path.rsplit("/", 1)[-1]
                info = f"software: converter\r\nformat: WARC File Format 1.1\r\nconverted-from: {name}\r\n".encode()
                head = lambda n, name=name, info=info: _record("warcinfo", str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name} {n}")), _iso(DATE), info, ["Content-Type: application/warc-fields"])
                for file in _gathered(records(path, content, {x["at"]: x["to"] for x in seen or []}), head, most):
                    yield pa.RecordBatch.from_arrays([pa.array([file], pa.binary())], names=["record"])

    _write(spark.createDataFrame([], "record binary"), warc_path)  # the folder, where there are no archives
    for paths in slices(counts.sort("path").toLocalIterator(), most_files, most_again):
        _write(_slice(spark, paths, again).mapInArrow(work, "record binary"), warc_path, "append")


def warc_records(content: bytes):
    """(headers, block) of each record."""
    stream = Stream(content)
    while True:
        at = stream.at
        head = stream.until(b"\r\n\r\n")
        if head is None:
            break
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        said = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = stream.take(int(said["content-length"]))
        if stream.take(4) != WARC_END:
            raise ValueError(f"the WARC record at {at} doesn't end where it says")
        yield said, block


def read(spark: SparkSession, warc_path: str, with_payload: bool = False) -> DataFrame:
    """id, type, url, date, page_id, payload_bytes, payload_digest (hex), refers_to_id and, if asked
    for, payload of every record but warcinfo. A response's digest is checked against its payload."""
    kinds = {"id": pa.string(), "type": pa.string(), "url": pa.string(), "date": pa.string(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to_id": pa.string(), "payload": pa.binary()}
    if not with_payload:
        del kinds["payload"]

    def work(batches):
        for batch in batches:
            for content in batch["content"].to_pylist():
                rows, size = [], 0
                for said, block in warc_records(content):
                    if said["warc-type"] == "warcinfo":
                        continue
                    _, payload, http = _http(block)
                    digest = base64.b32decode(said["warc-payload-digest"].removeprefix("sha1:")).hex()
                    kept = said["warc-type"] == "response"
                    if kept and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{said['warc-record-id']}: payload doesn't have its digest")
                    length = len(payload) if kept else int(http["content-length"])
                    row = (said["warc-record-id"], said["warc-type"], said["warc-target-uri"], said["warc-date"], _number(http.get("x-page-id")), length, digest, said.get("warc-refers-to"), payload)
                    rows.append(row[: len(kinds)])
                    size += len(payload) if with_payload else 0
                    if size > BYTES:
                        yield _table(rows, kinds)
                        rows, size = [], 0
                yield _table(rows, kinds)

    schema = "id string, type string, url string, date string, page_id long, payload_bytes long, payload_digest string, refers_to_id string" + ", payload binary" * with_payload
    return _files(spark, warc_path).mapInArrow(work, schema)


def archive(pages: DataFrame, version: int = 1, most: int = BYTES) -> str:
    """Pages into ARC files and those into WARC files; returns the folder of the latter."""
    spark = pages.sparkSession
    arc, warc = common.staged_path(spark, "arc"), common.staged_path(spark, "warc")
    write_arc(pages, arc, version, most)
    convert(spark, arc, warc, most=most)
    return warc


def op9_warc(spark, sf_dir: str) -> DataFrame:
    records = common.staged(read(spark, archive(common.table(spark, sf_dir, "pages"))), "warc-index")
    kept, again = records.filter("type = 'response'"), records.filter("type <> 'response'")
    target = kept.select(F.col("id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    rows = kept.withColumn("refers_to", F.lit(None).cast("long")).unionByName(again.join(target, "refers_to_id", "left"))
    return rows.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""
