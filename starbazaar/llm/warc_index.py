"""WARC archives with a two-level capture index.

Every task writes its pages as one archive of gzip members, a member for each record, and reports where each lies. The index sorts
the captures by reversed-host URL key over range partitions; each partition becomes one file of compressed blocks of
``BLOCK`` lines, followed by its sparse directory (first key, place and length of each block) and the directory's length. A look-up
binary-searches the files' first keys, a file's directory and the block's lines, and then reads only the ranges of the records.

Files have a name of their own for each attempt of a task and are known only from the rows of the attempt that counted, so that
repeated or lost tasks do no harm. They are opened through ``pyarrow.fs`` by URI, in the shared folder.

Of records with equal payloads that with the largest page_id is the response and the others revisit it, from ``REVISIT`` bytes on.

Defined results: null html is an empty payload, a null url an empty one; rows that share the largest page_id of a payload are all responses; a
null page_id is written as an empty number and is a response only if no equal payload has one; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import batched, groupby
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbazaar.llm.common import slices, table, written
from starbazaar.session import app_dir

BLOCK = 500
REVISIT = 0
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes at an index file's end that hold its directory's length.
_TAIL = 8
_CAPTURE = "key string, page_id bigint, file string, offset bigint, length bigint"


def surt(url: str) -> str:
    """A key that sorts the URLs of a host and its subdomains together: ``com,example)/path?query``."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:
        return f"){url}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~', errors='replace')}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record says: page_id, payload (None for a revisit), payload_bytes, payload_digest, record_type, refers_to."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    own = fields["WARC-Record-ID"][10:-1]
    found = {
        "page_id": int(own) if own else None, "record_type": fields["WARC-Type"], "payload": None, "payload_bytes": int(told["Content-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "url": fields["WARC-Target-URI"],
        "refers_to": int(fields["WARC-Refers-To"][10:-1]) if "WARC-Refers-To" in fields else None,
    }
    if found["record_type"] == "response":
        if len(payload) != found["payload_bytes"] or digest(payload) != found["payload_digest"]:
            raise ValueError(f"damaged record of page {found['page_id']}")
        found["payload"] = payload
    return found


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class _Files:
    """Open files of a task, the last few of them."""

    def __init__(self, most: int = 32) -> None:
        self.most, self.open = most, {}

    def read(self, uri: str, offset: int, length: int) -> bytes:
        return self._file(uri).read_at(length, offset)

    def size(self, uri: str) -> int:
        return self._file(uri).size()

    def _file(self, uri: str):
        if uri not in self.open:
            if len(self.open) >= self.most:
                self.open.pop(next(iter(self.open))).close()
            fs, path = _place(uri)
            self.open[uri] = fs.open_input_file(path)
        return self.open[uri]


def archived(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html); the captures (key, page_id, file, offset, length)."""
    own = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("sha1", F.sha1("payload"))
    groups = written(
        own.where(F.octet_length("payload") >= REVISIT).groupBy("sha1").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
        .where("n > 1 AND kept IS NOT NULL").drop("n"), "equal-payloads")
    typed = own.join(groups, "sha1", "left").select("page_id", "url", "payload", F.when(
        ~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, uri = None, 0, f"{folder}/archive/{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in slices(batches, "payload"):
                rows = []
                for page, url, payload, kept in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None:
                        fs, path = _place(uri)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(path, compression=None)
                    member = _gzip(record(page, url, payload, kept, kept is not None))
                    out.write(member)
                    rows.append((surt(url), page, uri, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    ["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return written(typed.mapInArrow(write, _CAPTURE), "captures")


def _line(row: tuple) -> str:
    key, page, file, offset, length = row
    return f"{quote(key, safe=',)/?=&:;@!$+*(~', errors='replace')} {'-' if page is None else page} {file} {offset} {length}"


def indexed(captures: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Write the index; its blocks (first_key, file, offset, length), a row for each."""
    captures = captures.select(F.expr("coalesce(key, '')").alias("key"), "page_id", "file", "offset", "length")
    # Rows of one key spread over partitions by the rest of the order.
    order = ["key", "page_id", "file", "offset"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, uri, waiting, directory = None, 0, f"{folder}/index/{uuid.uuid4().hex}.idx", [], []

        def put(lines: list[str]) -> None:
            nonlocal out, at
            if out is None:
                fs, path = _place(uri)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(path, compression=None)
            data = _gzip("\n".join(lines).encode())
            out.write(data)
            directory.append((lines[0].split(" ", 1)[0], at, len(data)))
            at += len(data)

        try:
            for batch in batches:
                waiting += map(_line, zip(*(c.to_pylist() for c in batch.columns)))
                while len(waiting) >= block:
                    put(waiting[:block])
                    del waiting[:block]
            if waiting:
                put(waiting)
            if out is not None:
                data = _gzip("\n".join(f"{k} {a} {n}" for k, a, n in directory).encode())
                out.write(data + len(data).to_bytes(_TAIL, "big"))
        finally:
            if out is not None:
                out.close()
        if directory:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in directory]), pa.array([uri] * len(directory)), pa.array([d[1] for d in directory], pa.int64()),
                 pa.array([d[2] for d in directory], pa.int64())], ["first_key", "file", "offset", "length"])

    # Bytes, not the locale: Spark and Python both compare keys by their UTF-8 bytes once they are quoted.
    laid = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(laid.mapInArrow(write, "first_key string, file string, offset bigint, length bigint"), "index-blocks")


def _captures(block: bytes) -> list[list[str]]:
    return [line.split(" ") for line in zlib.decompress(block, 31).decode().split("\n")]


def _fetch(files: _Files, lines: Iterable[list[str]]) -> Iterator[dict]:
    for _, _, file, offset, length in lines:
        yield parse(zlib.decompress(files.read(file, int(offset), int(length)), 31))


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
           ("record_type", pa.string()), ("refers_to", pa.int64())]
_RECORD = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _batch(found: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], t) for n, t in _FIELDS], [n for n, _ in _FIELDS])


def read_all(blocks: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives, block by block of the index."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files()
        for batch in batches:
            for uri, offset, length in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                found = []
                # Records of a block lie in many archives; in their order a file is opened once.
                for f in _fetch(files, sorted(_captures(files.read(uri, offset, length)), key=lambda c: (c[2], int(c[3])))):
                    found.append(f if with_payload else {**f, "payload": None})
                    if len(found) >= 64:
                        yield _batch(found)
                        found = []
                if found:
                    yield _batch(found)

    spread = blocks.repartition(max(2, blocks.sparkSession.sparkContext.defaultParallelism), "file", "offset")
    return spread.mapInArrow(read, _RECORD)


def index_blocks(urls: DataFrame, blocks: DataFrame) -> DataFrame:
    """key, file, offset and length of every index block that may hold captures of ``urls`` (column url), by binary search in the directories.

    The first keys of the index files are broadcast: one line for each range partition of the index.
    """
    tops = sorted((r["first"], r["file"]) for r in blocks.groupBy("file").agg(F.min("first_key").alias("first")).collect())
    given = urls.sparkSession.sparkContext.broadcast(tops)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, tops, directories = _Files(), given.value, {}
        firsts = [t[0] for t in tops]

        def directory(uri: str) -> tuple[list[str], list[tuple[int, int]]]:
            if uri not in directories:
                size = files.size(uri)
                n = int.from_bytes(files.read(uri, size - _TAIL, _TAIL), "big")
                lines = [line.split(" ") for line in zlib.decompress(files.read(uri, size - _TAIL - n, n), 31).decode().split("\n")]
                directories[uri] = [k for k, _, _ in lines], [(int(a), int(m)) for _, a, m in lines]
            return directories[uri]

        def places(key: str) -> Iterator[tuple[str, str, int, int]]:
            # A key's captures may begin in the block before the first that starts with it.
            for uri in [t[1] for t in tops[max(0, bisect.bisect_left(firsts, key) - 1):bisect.bisect_right(firsts, key)]]:
                keys, own = directory(uri)
                for at, n in own[max(0, bisect.bisect_left(keys, key) - 1):bisect.bisect_right(keys, key)]:
                    yield key, uri, at, n

        for batch in batches:
            found = [p for url in batch.column(0).to_pylist() for p in places(_line((surt(url or ""), None, "", 0, 0)).split(" ", 1)[0])]
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["key", "file", "offset", "length"])

    return urls.select(F.col("url").cast("string")).distinct().mapInArrow(
        search, "key string, file string, offset bigint, length bigint").distinct()


def look_up(urls: DataFrame, blocks: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records captured for ``urls`` (column url). Blocks are dealt over tasks, so the captures of one key may be any number."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files()

        def records(block: tuple[str, int, int], keys: list[str]) -> Iterator[pa.RecordBatch]:
            lines, wanted = _captures(files.read(*block)), []
            for key in keys:
                begin = bisect.bisect_left(lines, key, key=lambda c: c[0])
                wanted += lines[begin:bisect.bisect_right(lines, key, key=lambda c: c[0])]
            # Records of a block lie in many archives; in their order a file is opened once.
            for part in batched(_fetch(files, sorted(wanted, key=lambda c: (c[2], int(c[3])))), 64):
                yield _batch([f if with_payload else {**f, "payload": None} for f in part])

        rows = (r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(4))))
        for block, own in groupby(rows, key=lambda r: r[1:]):
            yield from records(block, [r[0] for r in own])

    spread = index_blocks(urls, blocks).repartition(
        max(2, blocks.sparkSession.sparkContext.defaultParallelism), "file", "offset").sortWithinPartitions("file", "offset", "key")
    return spread.mapInArrow(fetch, _RECORD)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{app_dir(spark)}/warc-{uuid.uuid4().hex}"
    pages = table(spark, sf_dir, "pages")
    blocks = indexed(archived(pages, folder), folder)
    return look_up(pages.select("url"), blocks, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
