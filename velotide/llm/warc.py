"""WARC records in ZIP packages, written and read by Spark tasks.

``write_archives`` writes ``archive/data.warc.gz`` (one gzip member a record)
and ``indexes/index.cdxj`` as stored members of ZIP packages in a shared folder.
A task streams its records into packages of at most ``MAX_BYTES`` /
``MAX_RECORDS``; a package is named by a fresh id and counts only once its task
has returned its manifest row, so a lost or repeated task leaves no double
records.  Of equal payloads of ``min_bytes`` or more, the record with the
smallest id is the response and the others are revisits that refer to it.

``read_archives`` reads packages back without extracting them: directory (ZIP64
too) -> index member -> record ranges, dealt over tasks by position, so one
large package is read by many tasks.

Defined results: a null html is an empty payload; a null id sorts last and is
written as an empty record id; rows that repeat the smallest id are all
responses; control characters of a url are percent-encoded; no rows give no
package.  Extra columns are ignored."""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib
import re
import uuid
from typing import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.llm.common import written
from velotide.llm.zip_archive import ZipWriter, directory
from velotide.session import scratch_path

MAX_BYTES, MAX_RECORDS = 1 << 30, 100_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, "
          "refers_to_record string, payload binary")
SPAN = 4 << 20  # records are read together in ranges of about this many bytes


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _id(urn: str | None) -> int | None:
    """The page of one of our own record ids; None for any other."""
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def warc_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    safe = "".join(c if c > "\x1f" and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date),
            ("WARC-Target-URI", safe), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    block = HTTP if revisit else HTTP + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


_NAMES = {n.lower(): n for n in ("WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Refers-To", "Content-Length")}


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record; a revisit's payload is empty.  Header names
    are given as WARC writes them, whatever their case."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    head, _, rest = data.partition(b"\r\n\r\n")
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    headers = {_NAMES.get(k.strip().lower(), k.strip()): v.strip() for k, _, v in pairs}
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    if headers.get("WARC-Type") in ("response", "revisit") and block.startswith(b"HTTP/"):
        return headers, block.partition(b"\r\n\r\n")[2]
    return headers, block


class _Package:
    """One ZIP package being written; the index (bounded by MAX_RECORDS) follows the data."""

    def __init__(self, folder: str):
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        self.file = system.open_output_stream(file_system(self.path)[1])
        self.zip, self.index = ZipWriter(self.file), []
        self.zip.begin(DATA)

    def add(self, record: bytes, **entry) -> None:
        data = gzip.compress(record, 6, mtime=0)
        at = self.zip.write(data)
        self.index.append(json.dumps(entry | {"filename": DATA.rpartition("/")[2], "offset": at, "length": len(data)}))

    def full(self) -> bool:
        return self.zip.size >= MAX_BYTES or len(self.index) >= MAX_RECORDS

    def close(self) -> tuple[str, int, int]:
        self.zip.end()
        self.zip.begin(INDEX)
        for line in self.index:
            self.zip.write(line.encode() + b"\n")
        self.zip.end()
        self.zip.close()
        self.file.close()
        return self.path, len(self.index), self.zip.at


def _writer(folder: str, date: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for b in batches:
            for page, url, payload, digest, revisit, first in zip(*(b.column(i) for i in range(6))):
                package = package or _Package(folder)
                page, digest, revisit = page.as_py(), digest.as_py(), revisit.as_py()
                record = warc_record(page, url.as_py(), payload.as_py(), digest, first.as_py(), revisit, date)
                package.add(record, id=page, type="revisit" if revisit else "response", digest=digest)
                if package.full():
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["archive", "records", "bytes"])
    return rows


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every page as a WARC record; returns the manifest (archive, records, bytes)."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    # digests meet without their payloads; what a page refers to comes back by page
    slim = p.filter(F.octet_length("payload") >= min_bytes).select("page_id", "digest")
    owners = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # a page that stands there twice, or has no id, has its digest to be told by
    page = F.coalesce("page_id", F.lit((1 << 63) - 1)).alias("page")
    firsts = written(slim.join(owners, "digest").select(page, "digest", "first").distinct(), "first-pages")
    p = p.withColumn("page", page).join(firsts, ["page", "digest"], "left")
    revisit = F.coalesce(F.coalesce(F.col("page_id") > F.col("first"), F.col("first").isNotNull()), F.lit(False))
    p = p.select("page_id", "url", "payload", "digest", revisit.alias("revisit"), "first")
    return written(p.mapInArrow(_writer(folder, date), "archive string, records long, bytes long"), "manifest")


def index_entries(text: bytes, members: dict[str, tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(member, offset, length) of the lines of an index: JSON, or CDXJ (key, time
    and JSON).  A line without a file name means the only archive member."""
    archives = {name.rpartition("/")[2]: name for name in members if name.startswith("archive/")}
    for line in text.splitlines():
        at = line.find(b"{")
        if at < 0:  # a header or an empty line
            continue
        entry = json.loads(line[at:])
        name = entry.get("filename")
        member = (next(iter(archives.values())) if len(archives) == 1 else None) if name is None else archives.get(name.rpartition("/")[2])
        if member is None:
            raise ValueError(f"the index names no archive member: {name}")
        yield member, int(entry["offset"]), int(entry["length"])


def walk_member(f, at: int, size: int, packed: bool) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of a member without an index, read in pieces."""
    done = 0
    while done < size:
        f.seek(at + done)
        if packed:  # a record is a gzip member: its end is where the next one starts
            unzip, read = zlib.decompressobj(31), 0
            while not unzip.eof:
                piece = f.read(min(1 << 16, size - done - read))
                if not piece:
                    raise ValueError("a record ends behind its member")
                read += len(piece)
                unzip.decompress(piece)
            length = read - len(unzip.unused_data)
        else:
            head = b""
            while b"\r\n\r\n" not in head:
                piece = f.read(min(1 << 12, size - done - len(head)))
                if not piece:
                    raise ValueError("a record without an end of its head")
                head += piece
            found = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
            length = head.index(b"\r\n\r\n") + 4 + int(found[1]) + 4
        yield done, length
        done += length


def _locate(batches):
    """(archive, at, length, packed) of every record of a package's archive members."""
    def ranges(archive):
        system, path = file_system(archive)
        with system.open_input_file(path) as f:
            members = directory(f, f.size())
            own = {n: m for n, m in members.items() if re.fullmatch(r"archive/.*\.warc(\.gz)?", n)}
            indexes = [m for n, m in members.items() if re.fullmatch(r"indexes/.*\.(cdxj?|json|jsonl)(\.gz)?", n)]
            if any(method for _, _, method in [*own.values(), *indexes]):
                raise ValueError(f"{archive}: members must be stored")
            seen = set()
            for index, length, _ in indexes:
                f.seek(index)
                text = f.read(length)
                for name, offset, n in index_entries(gzip.decompress(text) if text[:2] == b"\x1f\x8b" else text, members):
                    at, size, _ = own[name]
                    if offset + n > size:
                        raise ValueError(f"{archive}: the index points past {name}")
                    seen.add(name)
                    yield at + offset, n, name.endswith(".gz")
            for name, (at, size, _) in own.items():
                if name not in seen:  # no index knows it
                    for offset, n in walk_member(f, at, size, name.endswith(".gz")):
                        yield at + offset, n, name.endswith(".gz")

    for b in batches:
        for archive in b.column(0).to_pylist():
            rows = list(dict.fromkeys(ranges(archive)))  # two indexes may name a record
            if rows:
                at, length, packed = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array([archive] * len(rows)), pa.array(at, pa.int64()), pa.array(length, pa.int64()), pa.array(packed)],
                                                 names=["archive", "at", "length", "packed"])


def _read_record(data: bytes, packed: bool, payloads: bool) -> tuple:
    headers, payload = parse_record(gzip.decompress(data) if packed else data)
    kind, digest = headers["WARC-Type"], headers.get("WARC-Payload-Digest")
    response = kind != "revisit"
    if digest and digest.startswith("sha256:"):
        digest = digest.removeprefix("sha256:")
        if response and re.fullmatch("[0-9a-f]{64}", digest) and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload and digest differ")
    name, other = headers.get("WARC-Record-ID"), headers.get("WARC-Refers-To")
    return (_id(name), headers.get("WARC-Target-URI"), len(payload) if response else None, digest, kind,
            None if response else _id(other), name, None if response else other, payload if payloads and response else None)


def _reader(payloads: bool):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_record", pa.string()),
                        ("payload", pa.binary())])

    def spans(batches):
        """Neighbouring records of one archive, about SPAN bytes at a time."""
        held: list[tuple[str, int, int, bool]] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (row[0] != held[0][0] or row[1] != held[-1][1] + held[-1][2] or row[1] - held[0][1] >= SPAN):
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def rows(batches):
        name, f = None, None
        for span in spans(batches):
            if span[0][0] != name:
                if f:
                    f.close()
                name = span[0][0]
                system, path = file_system(name)
                f = system.open_input_file(path)
            base = span[0][1]
            f.seek(base)
            data = f.read(span[-1][1] + span[-1][2] - base)
            out = [_read_record(data[at - base:at - base + n], packed, payloads) for _, at, n, packed in span]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
        if f:
            f.close()
    return rows


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the packages named in ``manifest.archive``, of all their archive
    members: ``page_id`` and ``refers_to`` are set for our own record ids, foreign ids
    stand in ``record_id`` and ``refers_to_record``."""
    ranges = manifest.select("archive").mapInArrow(_locate, "archive string, at long, length long, packed boolean")
    ranges = ranges.withColumn("part", F.floor(F.col("at") / (4 * SPAN)))
    ranges = ranges.repartition("archive", "part").sortWithinPartitions("archive", "at").select("archive", "at", "length", "packed")
    return ranges.mapInArrow(_reader(payloads), RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages' archives, read them back, and give every record its full
    payload's length: a revisit has it from the response it refers to."""
    manifest = write_archives(pages, scratch_path(spark, "archives"))
    records = written(read_archives(manifest).drop("payload"), "records")
    full = records.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("_full"))
    out = records.join(full, ["refers_to", "payload_digest"], "left")
    return out.select("page_id", F.coalesce("payload_bytes", "_full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
