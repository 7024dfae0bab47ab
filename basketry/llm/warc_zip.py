"""WARC records in ZIP packages, written per partition and read by ranges.

A package is a ZIP file with two kinds of members, both stored without compression:
``archive/data.warc.gz``, gzip members of one record each, and ``indexes/index.cdxj``, a line
per record with its offset and length inside the archive member. Packages are read without
extraction: the end record, the ZIP64 records and the central directory are parsed from the
tail of the file, the local header gives the place of a stored member, and each task then
reads one range of the package that holds a run of records.

Of records with equal payloads of at least ``MIN_SHARED`` bytes the one with the smallest
page id is a response and the others are revisits, which carry the digest and the length of
the payload but not the payload. Null html is an empty payload. Rows that repeat the smallest
page id are all responses; a null page id never leads a group, and is a revisit of it.
An empty table gives no packages and no rows.

Hot payloads: only (digest, page id) pairs are grouped, with a minimum that is taken before
the shuffle; the join back spreads over tasks by adaptive skew handling, since one side is
one row per payload. Files get names of their own per attempt, and only those named in the
written manifest are read, so lost or repeated tasks do no harm.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import map_stream, stage

MIN_SHARED = 100
#: Bytes of archive after which a task starts a new package, and bytes of one range read.
PACKAGE_BYTES, RANGE_BYTES = 256 << 20, 4 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Fixed values of the formats.
EOCD, EOCD64, LOCATOR64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
CENTRAL, LOCAL, ZIP64_EXTRA = b"PK\x01\x02", b"PK\x03\x04", 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_input(path: str):
    """A file that can be read at any place, from any store that the Arrow file systems know."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def open_output(path: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(name)


# -- packages -----------------------------------------------------------------------------------


class PackageWriter:
    """Streams stored members into a ZIP file; sizes follow the data in descriptors.

    ``always64`` writes ZIP64 records even where the small ones would do.
    """

    def __init__(self, out, always64: bool = False) -> None:
        self.out, self.at, self.members, self.always64 = out, 0, [], always64

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def start(self, name: str) -> None:
        raw = name.encode()
        self.members.append([raw, self.at, 0, 0])
        # Version 4.5, flag 8: sizes in the descriptor; method 0: stored.
        self._put(LOCAL + struct.pack("<5H3I2H", 45, 8 | 0x800, 0, 0, 33, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 20)
                  + raw + struct.pack("<2H2Q", ZIP64_EXTRA, 16, 0, 0))

    def write(self, data: bytes) -> None:
        m = self.members[-1]
        m[2], m[3] = m[2] + len(data), zlib.crc32(data, m[3])
        self._put(data)

    def end(self) -> None:
        _, _, size, crc = self.members[-1]
        self._put(b"PK\x07\x08" + struct.pack("<I2Q", crc, size, size))

    def close(self) -> None:
        begin = self.at
        for raw, offset, size, crc in self.members:
            big = self.always64 or max(size, offset) >= 0xFFFFFFFF
            extra = struct.pack("<2H3Q", ZIP64_EXTRA, 24, size, size, offset) if big else b""
            sizes = (0xFFFFFFFF,) * 2 if big else (size, size)
            self._put(CENTRAL + struct.pack("<6H3I5H2I", 45, 45, 8 | 0x800, 0, 0, 33, crc, *sizes, len(raw), len(extra),
                                            0, 0, 0, 0, 0xFFFFFFFF if big else offset) + raw + extra)
        length, count = self.at - begin, len(self.members)
        if self.always64 or max(begin, length) >= 0xFFFFFFFF or count >= 0xFFFF:
            where = self.at
            self._put(EOCD64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, count, count, length, begin))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, where, 1))
            count, length, begin = 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF
        self._put(EOCD + struct.pack("<4H2IH", 0, 0, count, count, length, begin, 0))


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    size: int
    method: int


def read_at(f, offset: int, size: int) -> bytes:
    f.seek(offset)
    return bytes(f.read(size))


def directory(f, size: int) -> list[Member]:
    """The members of a ZIP file, from its central directory; ZIP64 values where present."""
    tail_size = min(size, 65535 + 22 + 20)
    tail = read_at(f, size - tail_size, tail_size)
    end = tail.rfind(EOCD)
    if end < 0:
        raise ValueError("no end of central directory")
    _, _, _, count, length, begin, _ = struct.unpack("<4H2IH", tail[end + 4:end + 22])
    if 0xFFFF in (count,) or 0xFFFFFFFF in (length, begin):
        if tail[end - 20:end - 16] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        _, where, _ = struct.unpack("<IQI", tail[end - 16:end])
        record = read_at(f, where, 56)
        if record[:4] != EOCD64:
            raise ValueError("no ZIP64 end record")
        _, _, _, _, _, _, count, length, begin = struct.unpack("<Q2H2I4Q", record[4:])
    raw, at, found = read_at(f, begin, length), 0, []
    for _ in range(count):
        if raw[at:at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        _, _, _, method, _, _, _, packed, unpacked, n, x, c, _, _, _, offset = struct.unpack("<6H3I5H2I", raw[at + 4:at + 46])
        name, extra = raw[at + 46:at + 46 + n].decode(), raw[at + 46 + n:at + 46 + n + x]
        at += 46 + n + x + c
        while len(extra) >= 4:
            kind, k = struct.unpack("<2H", extra[:4])
            if kind == ZIP64_EXTRA:
                wide = list(struct.unpack(f"<{k // 8}Q", extra[4:4 + k // 8 * 8]))
                unpacked = wide.pop(0) if unpacked == 0xFFFFFFFF else unpacked
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + k:]
        found.append(Member(name, offset, packed, method))
    return found


def data_start(f, member: Member) -> int:
    """Where the bytes of a stored member begin: after its local header."""
    if member.method:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    head = read_at(f, member.offset, 30)
    if head[:4] != LOCAL:
        raise ValueError("damaged local header")
    n, x = struct.unpack("<2H", head[26:30])
    return member.offset + 30 + n + x


# -- records ------------------------------------------------------------------------------------


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def warc_record(page_id, url: str, payload: bytes | None, digest: str, size: int, refers_to=None) -> bytes:
    """One record; ``payload`` is None for a revisit."""
    head = [b"WARC/1.1", b"WARC-Type: " + (b"response" if payload is not None else b"revisit"),
            b"WARC-Record-ID: " + record_id(page_id).encode(), b"WARC-Date: 1970-01-01T00:00:00Z",
            b"WARC-Target-URI: " + url.encode("utf-8", "surrogatepass").replace(b"\r", b"%0D").replace(b"\n", b"%0A"),
            b"WARC-Payload-Digest: sha256:" + digest.encode(), b"WARC-Payload-Length: %d" % size]
    if page_id is not None:
        head.append(b"WARC-Page-ID: %d" % page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if payload is None:
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: " + record_id(refers_to).encode(),
                 b"WARC-Refers-To-Page-ID: %d" % refers_to]
    block = http + (payload or b"")
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields (lower case) and the payload after the HTTP header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower().decode(): v.strip().decode("utf-8", "surrogatepass")
              for k, _, v in (x.partition(b":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def payload_decisions(pages: DataFrame) -> DataFrame:
    """``r_page, r_digest, refers_to`` of the revisits only; a page id with several payloads is told by their digests."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    marks = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha2(html, 256).alias("digest"), F.length(html).alias("bytes"))
    marks = stage(marks.filter(F.col("bytes") >= MIN_SHARED).select("page_id", F.unhex("digest").alias("digest")), "warc-digests")
    groups = marks.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    groups = stage(groups.filter("n > 1 and refers_to is not null").select("digest", "refers_to"), "warc-groups")
    return marks.join(groups, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to").distinct()


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as packages below ``folder`` (a URI); returns the manifest ``path, bytes, records``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    same = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.unhex("digest") == F.col("r_digest"))
    marked = rows.join(payload_decisions(pages), same, "left").select("page_id", "url", "html", "digest", "refers_to")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        package = None
        for batch in batches:
            for page, url, html, digest, refers in zip(
                    batch["page_id"], batch["url"], batch["html"], batch["digest"], batch["refers_to"], strict=True):
                page, refers = (None if pd.isna(x) else int(x) for x in (page, refers))
                payload = html.encode("utf-8", "surrogatepass")
                raw = warc_record(page, url, payload if refers is None else None, digest, len(payload), refers)
                if package is None:
                    path = f"{folder}/{uuid.uuid4().hex}.wacz"
                    out = open_output(path)
                    package = PackageWriter(out)
                    package.start(ARCHIVE)
                    lines, at = [], 0
                data = gzip.compress(raw, 1, mtime=0)
                package.write(data)
                lines.append(b"%d %d\n" % (at, len(data)))
                at += len(data)
                if at >= PACKAGE_BYTES:
                    yield _closed(package, out, path, lines)
                    package = None
        if package is not None:
            yield _closed(package, out, path, lines)

    return stage(map_stream(marked, run, "path string, bytes long, records long"), "warc-manifest")


def _closed(package: PackageWriter, out, path: str, lines: list[bytes]) -> pd.DataFrame:
    package.end()
    package.start(INDEX)
    package.write(b"".join(lines))
    package.end()
    package.close()
    out.close()
    return pd.DataFrame({"path": [path], "bytes": [package.at], "records": [len(lines)]})


def record_ranges(path: str, size: int, limit: int = RANGE_BYTES) -> Iterator[tuple[int, list[int]]]:
    """``(offset, lengths)`` in the package of runs of whole records, each about ``limit`` bytes."""
    with open_input(path) as f:
        members = {m.name: m for m in directory(f, size)}
        base = data_start(f, members[ARCHIVE])
        index = members[INDEX]
        lines = read_at(f, data_start(f, index), index.size).split(b"\n")[:-1]
    begin, run = 0, []
    for line in lines:
        at, n = map(int, line.split())
        if run and sum(run) + n > limit:
            yield base + begin, run
            run = []
        if not run:
            begin = at
        run.append(n)
    if run:
        yield base + begin, run


def read_packages(manifest: DataFrame) -> DataFrame:
    """One row per record: ``page_id, url, record_type, payload, payload_digest, payload_bytes, refers_to``.

    Responses are digested anew; a record whose payload does not match its header fails the job.
    """

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size in zip(batch["path"], batch["bytes"], strict=True):
                found = list(record_ranges(path, int(size)))
                yield pd.DataFrame({"path": [path] * len(found), "offset": [a for a, _ in found], "lengths": [n for _, n in found]})

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, offset, lengths in zip(batch["path"], batch["offset"], batch["lengths"], strict=True):
                with open_input(path) as f:
                    data = memoryview(read_at(f, int(offset), int(sum(lengths))))
                rows, at = [], 0
                for length in lengths:
                    fields, payload = parse_record(zlib.decompress(data[at:at + length], 31))
                    at += length
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    size = int(fields["warc-payload-length"])
                    kind = fields["warc-type"]
                    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record in {path}")
                    rows.append((int(fields["warc-page-id"]) if "warc-page-id" in fields else None, fields["warc-target-uri"], kind,
                                 payload if kind == "response" else None, digest, size,
                                 int(fields["warc-refers-to-page-id"]) if kind == "revisit" else None))
                out = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "payload", "payload_digest", "payload_bytes", "refers_to"], dtype=object)
                yield out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    width = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    listed = map_stream(manifest, ranges, "path string, offset long, lengths array<int>")
    return map_stream(listed.repartition(width), records, (
        "page_id long, url string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to long"))


def archive_report(pages: DataFrame) -> DataFrame:
    """Write all pages, read the packages back, and report each record."""
    spark = pages.sparkSession
    manifest = write_packages(pages, scratch_folder(spark, "warc"))
    return read_packages(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
