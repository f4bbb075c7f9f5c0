"""WARC archives with a two-level capture index.

*Writing.*  Payloads are digested by Spark; of equal payloads of at least ``least`` bytes the one of the largest id is the
response, and the others are written as revisits that name it.  Each task writes one archive of gzip members, one per
record, to the shared folder and returns where its records lie.  A task that runs again writes a file of another
name; only files named in the stored list of records are ever read.

*Index.*  Captures are range-partitioned and sorted by reversed-host key and id.  Each partition becomes one index file of
compressed blocks of ``block_lines`` lines and, at its end, a sparse directory with the first key of every block.  The top
level holds the first key of every index file; there are at most ``MOST_INDEX_FILES`` of them, so it is
broadcast.

*Reading.*  Requests are routed to their index file by the top level, find their block by binary search in the directory, read
that range, and find their line in it by binary search.  Records are then read in the order of
their place in the archives, in large ranges; payloads are checked against their digest.

Defined cases: a null payload is empty; a null URL is the empty URL; a null id is written as such, is no response to others, and
becomes a revisit if its payload has a response; repeated rows are records of their own, and each reads back a record of their
id, URL and payload; rows that share id and URL but not the payload each read back their own, as the digest is part of a capture's key; an
empty table has no records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import Stored, new_folder

LEAST_REVISIT_BYTES = 1000
BLOCK_LINES = 1000
MOST_INDEX_FILES = 10_000
READ_BYTES = 4 << 20
CHUNK_BITS = 23
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI that Spark wrote in any of its forms."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the right, then port, path and query; without control characters."""
    clean = quote((url or "").strip(), safe="!#$%&'()*+,/:;=?@[]~|^`{}\"\\<>", encoding="utf-8", errors="replace")
    try:
        parts = urlsplit(clean)
        host = parts.hostname or ""
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return clean
    if not host:
        return clean
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + query + (f"#{parts.fragment}" if parts.fragment else "")


def entry_key(url: str | None, page: int | None, digest: str) -> str:
    """Key of a capture: URL key, id and payload digest, in an order that text comparison keeps."""
    return f"{url_key(url)} {'' if page is None else f'{page + (1 << 63):020d}'} {digest}"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Target-URI: {quote(url or '', safe=chr(37) + '/:?#[]@!$&()*+,;=~', errors='replace')}", f"WARC-Date: {DATE}",
            f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + pack.flush()


@dataclass
class Record:
    page: int | None
    kind: str
    url: str
    payload: bytes | None
    payload_bytes: int
    digest: str
    refers_to: int | None


def parsed(member: bytes) -> Record:
    """Read one gzip member back; a response whose payload does not have its digest is an error."""
    data = zlib.decompress(member, 31)
    end = data.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in data[:end].decode().split("\r\n")[1:])
    block = data[end + 4:end + 4 + int(head["Content-Length"])]
    cut = block.index(b"\r\n\r\n") + 4
    size = int(re.search(rb"Content-Length: (\d+)", block[:cut])[1])
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()

    def number(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", head.get(name, ""))
        return int(found[1]) if found else None

    payload = None
    if head["WARC-Type"] == "response":
        payload = block[cut:]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    return Record(number("WARC-Record-ID"), head["WARC-Type"], head["WARC-Target-URI"], payload, size, digest, number("WARC-Refers-To"))


def payload_digest(payload: Column) -> Column:
    """Hexadecimal SHA-1 of a payload's UTF-8 bytes; null is empty."""
    return F.sha1(F.coalesce(payload, F.lit("")).cast("binary"))


def _decided(pages: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """``page_id, url, payload, digest, refers_to, revisit`` of every row."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"),
                        payload_digest(F.col(payload)).alias("digest"))
    shared = (rows.where(F.length("payload") >= least).groupBy("digest")
              .agg(F.max("page_id").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "lead"))
    # Only payloads that occur again are kept; stored, so that the join is planned by their measured size.
    leads = Stored(shared, "warc-repeated").df
    revisit = F.coalesce((F.length("payload") >= least) & ~F.col("page_id").eqNullSafe(F.col("lead")) & F.col("lead").isNotNull(),
                         F.lit(False))
    return (rows.join(leads, "digest", "left").withColumn("revisit", revisit)
            .select("page_id", "url", "payload", "digest", F.when(F.col("revisit"), F.col("lead")).alias("refers_to"), "revisit"))


def write(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST_REVISIT_BYTES,
          folder: str | None = None) -> DataFrame:
    """Write archives below ``folder`` and return the stored list ``entry, page_id, file, offset, length`` of their records."""
    folder = folder or new_folder(pages.sparkSession, "warc")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name, sink, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                out = []
                for page, address, body, digest, lead, again in zip(*(batch.column(i) for i in range(6))):
                    page, address, digest = page.as_py(), address.as_py(), digest.as_py()
                    member = record(page, address, body.as_py(), digest, lead.as_py(), again.as_py())
                    sink = sink or system.open_output_stream(f"{path}/{name}", compression=None)
                    sink.write(member)
                    out.append((entry_key(address, page, digest), page, name, offset, len(member)))
                    offset += len(member)
                if out:
                    yield _rows(out)
        finally:
            if sink:
                sink.close()

    written = _decided(pages, key, url, payload, least).mapInArrow(archive, CAPTURE)
    return Stored(written.withColumn("file", F.concat(F.lit(f"{folder}/"), "file")), "warc-records").df


CAPTURE = "entry string, page_id bigint, file string, offset bigint, length bigint"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["entry", "page_id", "file", "offset", "length"])


@dataclass
class Index:
    """Top level: first entry, URI and directory place of each index file, in order."""

    firsts: list[str]
    files: list[tuple[str, int, int]]


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES, folder: str | None = None) -> Index:
    """Write index files over ``captures`` and return the top level."""
    spark = captures.sparkSession
    folder = folder or new_folder(spark, "cdx")
    parts = min(_tasks(spark), MOST_INDEX_FILES)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name, sink, offset, lines, directory = f"{uuid.uuid4().hex}.cdx", None, 0, [], []

        def flush():
            nonlocal offset, lines
            packed = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode(), 6)
            directory.append((lines[0][0], offset, len(packed)))
            sink.write(packed)
            offset, lines = offset + len(packed), []

        for batch in batches:
            sink = sink or system.open_output_stream(f"{path}/{name}", compression=None)
            for line in zip(*(batch.column(i).to_pylist() for i in range(4))):
                lines.append(line)
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if sink:
            packed = zlib.compress(json.dumps(directory).encode(), 6)
            sink.write(packed)
            sink.close()
        if directory:
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name]), pa.array([offset]), pa.array([len(packed)])],
                                             names=["first", "file", "offset", "length"])

    ordered = captures.select("entry", "file", "offset", "length").repartitionByRange(parts, "entry", "file", "offset")
    ordered = ordered.sortWithinPartitions("entry", "file", "offset")
    top = Stored(ordered.mapInArrow(blocks, "first string, file string, offset bigint, length bigint"), "cdx-top").df
    rows = sorted(tuple(r) for r in top.collect())      # at most MOST_INDEX_FILES rows
    return Index([r[0] for r in rows], [(f"{folder}/{r[1]}", r[2], r[3]) for r in rows])


def lookup(requests: DataFrame, index: Index, key: str = "page_id", url: str = "url", digest: str = "digest") -> DataFrame:
    """``page_id, file, offset, length`` of the capture of each requested (id, URL, payload digest) that the index has."""
    shared = requests.sparkSession.sparkContext.broadcast(index)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        for batch in batches:
            pages = batch.column(0).to_pylist()
            entries = [entry_key(u, p, d) for u, p, d in zip(batch.column(1).to_pylist(), pages, batch.column(2).to_pylist())]
            places = [max(bisect_right(top.firsts, e) - 1, 0) for e in entries]
            # An entry that fills several files is found in the first that starts with it.
            places = [top.firsts.index(e) if top.firsts[p] == e else p for p, e in zip(places, entries)]
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(entries), pa.array(pages, pa.int64())],
                                             names=["place", "entry", "page_id"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, file, directory, firsts, block, lines, keys = None, None, [], [], None, [], []
        for batch in batches:
            out = []
            for place, entry, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if place != at:
                    at, block = place, None
                    uri, offset, length = shared.value.files[place]
                    system, path = opened(uri)
                    file = system.open_input_file(path)
                    directory = json.loads(zlib.decompress(file.read_at(length, offset)))
                    firsts = [d[0] for d in directory]
                # The last block that starts before the entry, or the first that starts with it.
                number = max(bisect_right(firsts, entry) - 1, 0)
                while number and firsts[number] == entry:
                    number -= 1
                while number < len(directory):
                    if block != number:
                        block = number
                        lines = [x.split("\t") for x in zlib.decompress(file.read_at(directory[number][2], directory[number][1]))
                                 .decode().split("\n")]
                        keys = [x[0] for x in lines]
                    line = bisect_right(keys, entry) - 1
                    if line >= 0 and keys[line] == entry:
                        while line and keys[line - 1] == entry:
                            line -= 1
                        out.append((entry, page, lines[line][1], int(lines[line][2]), int(lines[line][3])))
                        break
                    number += 1
                    if number >= len(directory) or firsts[number] > entry:
                        break
            if out:
                yield _rows(out)

    if not index.files:
        return requests.sparkSession.createDataFrame([], CAPTURE).drop("entry")
    routed = requests.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(digest).alias("digest")).mapInArrow(
        route, "place bigint, entry string, page_id bigint")
    dealt = routed.repartitionByRange(_tasks(requests.sparkSession), "place", "entry").sortWithinPartitions("place", "entry")
    return dealt.mapInArrow(search, CAPTURE).drop("entry")


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(places: DataFrame, texts: bool = False) -> DataFrame:
    """Records at ``page_id, file, offset, length``: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    ``texts`` adds the payload itself as ``payload`` (null for revisits).
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * texts
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * texts

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file, start, held = None, None, 0, b""
        for batch in batches:
            out = []
            for page, name, offset, length in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if name != uri:
                    uri, (system, path) = name, opened(name)
                    file, start, held = system.open_input_file(path), 0, b""
                if not start <= offset <= offset + length <= start + len(held):
                    start, held = offset, file.read_at(max(length, READ_BYTES), offset)
                found = parsed(held[offset - start:offset - start + length])
                out.append((page, found.payload_bytes, found.digest, found.kind, found.refers_to) + ((found.payload,) if texts else ()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    # A range of an archive is one task's; archives of any size are read by many.
    chunk = F.shiftright("offset", CHUNK_BITS)
    # Rows are small but stand for whole records, so their number of tasks is not left to their size.
    dealt = (places.select("page_id", "file", "offset", "length").repartition(_tasks(places.sparkSession), "file", chunk)
             .sortWithinPartitions("file", "offset"))
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return dealt.mapInArrow(records, schema + (", payload binary" if texts else ""))


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT_BYTES, key: str = "page_id", url: str = "url",
               payload: str = "html") -> DataFrame:
    """Write all pages, index them, look every page up, and read its record back."""
    index = build_index(write(pages, key, url, payload, least))
    asked = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload_digest(F.col(payload)).alias("digest"))
    return read(lookup(asked, index))
