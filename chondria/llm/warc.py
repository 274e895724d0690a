"""WARC archives with a two-level capture index."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from chondria.llm.common import new_path, stored

LEAST = 1000            # bytes of a payload from which equal ones are revisits
BLOCK = 1024            # captures in a compressed block of the index
OPEN = 32               # archives that a task keeps open
CAPTURED = "1970-01-01T00:00:00Z"
FIELDS = "key string, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """A URL with its host reversed, so that captures of a site sort together: ``com,example,www)/path?query``. No fragment; NULL is empty."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return "".join(url.split())
    site = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return "".join(f"{site}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".split())


def capture_key(url: str | None, page: int | None) -> str:
    """The index key of one capture: URL key, then page id with a fixed width; a NULL id sorts first."""
    return f"{url_key(url)} {'-' if page is None else f'{page + (1 << 63):020d}'}"


def capture_keys(url: Column, page: Column) -> Column:
    @F.pandas_udf("string")
    def keys(urls: pd.Series, pages: pd.Series) -> pd.Series:
        return pd.Series([capture_key(u, int(p) if p is not None and p != "" else None) for u, p in zip(urls, pages)])

    return keys(url, page.cast("string"))


def record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(record: str) -> int | None:
    found = record[len("<urn:page:"):-1]
    return None if found == "none" else int(found)


def member(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A record as a gzip member of its own: a response with its payload, or, with ``refers_to``, a revisit with the response's headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}",
            f"WARC-Date: {CAPTURED}", f"WARC-Target-URI: {''.join((url or '').split())}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", f"Content-Length: {len(body)}"]
    if refers_to is not None:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (the WARC ones, and the HTTP length as ``http-length``) and payload of one gzip member."""
    head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lines = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return fields | {"http-length": lines["Content-Length"]}, payload


def write_archives(pages: DataFrame, folder: str, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """Writes a record for each row of ``pages`` to gzipped archives in ``folder``; returns their captures (key, file, offset, length).

    Of rows with equal payloads of at least ``least`` bytes, the one with the largest id is the response, the others revisit it; rows that tie on that id are
    all responses. Payloads are compared by SHA-1 and length; which row is the response is a partial aggregate. Each task
    writes an archive with a name of its own, and captures name archives of finished attempts only, so what a lost or repeated attempt
    leaves is never read.
    """
    html = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(pages[page_col].cast("long").alias("page"), pages[url_col].cast("string").alias("url"), html.alias("payload"),
                        F.sha1(html).alias("digest"), F.octet_length(html).alias("n"))
    first = rows.where(F.col("n") >= least).groupBy(F.col("digest").alias("d"), F.col("n").alias("m")).agg(
        F.max("page").alias("answer"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    first = stored(first, "responses")      # so that both sides of the join are shuffled for it, and a hot payload can be split
    met = rows.join(first, (F.col("digest") == F.col("d")) & (F.col("n") == F.col("m")), "left")
    met = met.select("page", "url", "payload", "digest", F.when(F.col("page") != F.col("answer"), F.col("answer")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        name, out, offset = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}", compression=None)
            found = []
            for row in zip(*(batch.column(k) for k in range(5))):
                page, url, payload, digest, refers_to = (x.as_py() for x in row)
                raw = member(page, url, payload, digest, refers_to)
                out.write(raw)
                found.append((capture_key(url, page), f"{folder}/{name}", offset, len(raw)))
                offset += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                             names=["key", "file", "offset", "length"])
        if out is not None:
            out.close()

    return stored(met.mapInArrow(write, FIELDS), "captures")


def build_index(captures: DataFrame, folder: str) -> list[tuple[str, str, int, int]]:
    """Sorts captures by key into shards, files in ``folder``, and returns (first key, file, place and length of its directory) of each.

    A shard is a run of compressed blocks of ``BLOCK`` captures, then its directory with each block's first key and place. Directories stay in
    the shards; only one line a shard comes to the driver.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        name, out, place, directory, lines = f"shard-{uuid.uuid4().hex}.idx", None, 0, [], []

        def flush() -> int:
            raw = zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode(), 6)
            out.write(raw)
            directory.append((lines[0][0], place, len(raw)))
            lines.clear()
            return len(raw)

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if out is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                lines.append(row)
                if len(lines) == BLOCK:
                    place += flush()
        if out is not None:
            if lines:
                place += flush()
            raw = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(raw + struct.pack("<qq", place, len(raw)))
            out.close()
            yield pa.RecordBatch.from_pydict({"first": [directory[0][0]], "file": [f"{folder}/{name}"], "place": [place], "length": [len(raw)]})

    ordered = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    shards = stored(ordered.mapInArrow(build, "first string, file string, place long, length long"), "shards")
    return sorted(tuple(r) for r in shards.collect())


class Reader:
    """Range reads from a bounded number of open files."""

    def __init__(self):
        self.files: OrderedDict = OrderedDict()

    def read(self, file: str, place: int, length: int) -> bytes:
        held = self.files.pop(file, None)
        if held is None:
            if len(self.files) >= OPEN:
                self.files.popitem(last=False)[1].close()
            system, path = fs.FileSystem.from_uri(file)
            held = system.open_input_file(path)
        self.files[file] = held
        return held.read_at(length, place)


class Index:
    """Looks captures up: binary search over the shards' first keys, over a shard's directory, then within the blocks that can hold the key."""

    def __init__(self, shards: list[tuple[str, str, int, int]], reader: Reader):
        self.shards, self.first, self.reader = shards, [s[0] for s in shards], reader
        self.directories: OrderedDict = OrderedDict()
        self.block: tuple = (None, [], [])

    def directory(self, at: int) -> tuple[list[str], list]:
        if at not in self.directories:
            if len(self.directories) >= 4:
                self.directories.popitem(last=False)
            _, file, place, length = self.shards[at]
            blocks = json.loads(zlib.decompress(self.reader.read(file, place, length)))
            self.directories[at] = [b[0] for b in blocks], blocks
        return self.directories[at]

    def lines(self, at: int, k: int) -> tuple[list[str], list]:
        if self.block[0] != (at, k):
            _, place, length = self.directory(at)[1][k]
            lines = [x.split("\t") for x in zlib.decompress(self.reader.read(self.shards[at][1], place, length)).decode().split("\n")]
            self.block = (at, k), [x[0] for x in lines], lines
        return self.block[1:]

    def captures(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of every capture with this key, in however many blocks and shards they lie."""
        for at in range(max(0, bisect_left(self.first, key) - 1), bisect_right(self.first, key)):
            firsts, blocks = self.directory(at)
            for k in range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key)):
                keys, lines = self.lines(at, k)
                for i in range(bisect_left(keys, key), bisect_right(keys, key)):
                    yield lines[i][1], int(lines[i][2]), int(lines[i][3])


def read_records(keys: DataFrame, shards: list[tuple[str, str, int, int]]) -> DataFrame:
    """The records of the captures with the distinct ``keys(key)``, range-read through the index: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Keys are sorted into ranges first, so a task reads the blocks of its range once and in order. A response's digest is checked against its payload.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        index = Index(shards, reader)
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                for file, offset, length in index.captures(key):
                    fields, payload = parsed(reader.read(file, offset, length))
                    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    kind = fields["warc-type"]
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{file} at {offset}: the payload doesn't have the digest {digest}")
                    target = fields.get("warc-refers-to")
                    rows.append((page_of(fields["warc-record-id"]), int(fields["http-length"]), digest, kind, page_of(target) if target else None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)],
                                             names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(
        look, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder, indexes them, and reads every page back through the index.

    One row a page: page_id, payload_bytes, payload_digest (SHA-1, hexadecimal), record_type, refers_to. NULL html is an empty payload; NULL urls share the
    empty key; pages with a NULL id are responses. Repeated rows have a record each. Extra columns are not looked at. An empty table gives an empty
    result. The archives' file system must be one that pyarrow can open from the tasks.
    """
    folder = new_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, page_col, url_col, html_col, least)
    shards = build_index(captures, folder)
    keys = pages.select(capture_keys(pages[url_col].cast("string"), pages[page_col].cast("long")).alias("key")).distinct()
    return read_records(keys, shards)
