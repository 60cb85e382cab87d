"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per record, a revisit for all but the first of equal payloads, and gives a line
per record: its reversed-host URL key and where its bytes are. ``build_index`` sorts the lines by key and packs them
into compressed blocks; a sparse directory holds the first key of each block. ``lookup`` finds a key by binary
search in the directory, opens only the blocks it may be in, searches those, and reads byte ranges of the archives.

The directory has at most ``DIRECTORY`` entries (blocks grow with the index beyond that) of at most ``PREFIX``
characters, so it may be sent to every task. A key with many captures runs over as many blocks as it needs.

A task writes files of its own name and its lines name only those, so a repeated task leaves unused files, not wrong ones.
Archives go to the shared folder through the file system its URI names.

Defined results: a NULL payload is empty, a NULL URL has the empty key; rows with equal payloads and the same
smallest id are all responses; a row without id refers to the smallest id of its payload, if there is one. An empty
table makes no files. Further columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.sources.staging import Staged, shared_folder, stage

__all__ = ["CaptureIndex", "build_index", "lookup", "url_key", "write_archives"]

DIRECTORY = 1 << 16
PREFIX = 1024  # of separators; they are as long as it takes to tell a block from the one before
BLOCK_LINES = 256
READ_BYTES = 4 << 20  # neighbouring records are read together up to this size
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_REST = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)"


def url_key(url: Column) -> Column:
    """``http://a.example.com/x?y#z`` as ``com,example,a)/x?y``; other texts as they are. Control characters become blanks."""
    url = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x1F]", " ")
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.")), ",")
    return F.when(url.rlike(_HOST), F.concat(host, F.lit(")"), F.regexp_extract(url, _REST, 1))).otherwise(url)


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(row, date: str) -> bytes:
    payload, revisit = bytes(row.payload), row.refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{row.id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {row.url}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{row.refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode("utf-8", "replace") + block + b"\r\n\r\n") + pack.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) of a record and of its HTTP head (``http-`` before the name), and the payload."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields |= {"http-" + k.lower(): v for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])}
    return fields, payload


#: Ids travel as text, empty for NULL: pandas makes numbers with a NULL among them floats.
LINE = "key string, id string, file string, at long, size long"


def write_archives(
    pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_bytes: int = 256 << 20,
) -> tuple[str, Staged]:
    """Write (id, url, payload binary) rows. Gives the archives' folder and the staged index lines."""
    spark = pages.sparkSession
    root = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    store, folder = _store(root)
    store.create_dir(folder, recursive=True)
    rows = pages.select(F.col("id").cast("long").alias("id"), "url", F.coalesce("payload", F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # only payloads that occur again: a small table as a rule, then no payload is shuffled
    again = stage(rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"), "warc-again").read()
    known = F.octet_length("payload") >= min_bytes
    rows = rows.join(again, "digest", "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), url_key(F.col("url")).alias("key"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x1F]", " ").alias("url"), "payload",
        F.when(known & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string")).alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _store(root)
        out, name, at = None, "", 0
        for batch in batches:
            lines = []
            for row in batch.itertuples(index=False):
                data = _record(row, date)
                if out is None or at + len(data) > file_bytes and at:
                    if out is not None:
                        out.close()
                    name, at = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                out.write(data)
                lines.append((row.key, row.id, name, at, len(data)))
                at += len(data)
            if lines:
                yield pd.DataFrame(lines, columns=["key", "id", "file", "at", "size"])
        if out is not None:
            out.close()

    return root, stage(rows.mapInPandas(write, LINE), "warc-lines")


@dataclass
class Directory:
    """What separates each block from the one before, sorted, and the blocks' names.

    A separator is above the last key before it and not above the first key after it; neighbours that agree in
    ``PREFIX`` characters have these alone, and a key then asks for a block more.
    """

    separators: list[str]
    names: list[str]

    def candidates(self, key: str) -> list[str]:
        """The blocks a key may be in, by binary search: no block before ends as late, none after starts as early."""
        low = bisect.bisect_left(self.separators, key[:PREFIX]) - 1
        high = bisect.bisect_right(self.separators, key)
        return self.names[max(0, low):high]


@dataclass
class CaptureIndex:
    """The folder of the archives, the compressed blocks of index lines, and their directory."""

    root: str
    blocks: Staged
    directory: Directory


def separators(entries: list) -> list[str]:
    """The shortest beginning of each block's first key that is above the last key before."""
    out = []
    for before, entry in zip([None, *entries], entries):
        shared = len(os.path.commonprefix([before["last"], entry["first"]])) if before else 0
        out.append(entry["first"][: shared + 1])
    return out


def build_index(root: str, lines: Staged) -> CaptureIndex:
    """Sort the lines by key into blocks, and take the directory from the blocks' first keys."""
    per_block = max(BLOCK_LINES, math.ceil(lines.rows / DIRECTORY))
    ordered = lines.read().repartitionByRange("key", "id", "file", "at").sortWithinPartitions("key", "id", "file", "at")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def block() -> pd.DataFrame:
            text = "\n".join("\t".join(map(str, line)) for line in held)
            return pd.DataFrame({"block": [f"{part:06d}-{number:06d}"], "first": [held[0][0]], "last": [held[-1][0]], "data": [zlib.compress(text.encode("utf-8", "replace"), 6)]})

        for batch in batches:
            for line in batch.itertuples(index=False, name=None):
                held.append(line)
                if len(held) == per_block:
                    yield block()
                    number, held = number + 1, []
        if held:
            yield block()

    blocks = stage(ordered.mapInPandas(pack, "block string, first string, last string, data binary"), "warc-blocks")
    ends = [F.substring(c, 1, PREFIX).alias(c) for c in ("first", "last")]
    entries = blocks.read().select("block", *ends).orderBy("block").collect()  # about DIRECTORY rows and one more a range
    return CaptureIndex(root, blocks, Directory(separators(entries), [e["block"] for e in entries]))


def lookup(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """All captures of the keys (one column ``key``): (key, id, record_type, refers_to, payload_bytes, payload_digest, payload)."""

    directory = index.directory

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [(key, block) for key in batch["key"] for block in directory.candidates(key)]
            yield pd.DataFrame(pairs, columns=["key", "block"])

    wanted = keys.where(F.col("key").isNotNull()).select("key").distinct().mapInPandas(find, "key string, block string")

    def search(keys: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for data in block["data"]:
            lines = [line.split("\t") for line in zlib.decompress(data).decode().split("\n")]
            first = [line[0] for line in lines]
            for key in keys["key"]:
                out += lines[bisect.bisect_left(first, key):bisect.bisect_right(first, key)]
        found = pd.DataFrame(out, columns=["key", "id", "file", "at", "size"])
        return found.astype({"at": "int64", "size": "int64"})

    lines = wanted.groupBy("block").cogroup(index.blocks.read().select("block", "data").groupBy("block")).applyInPandas(search, LINE)
    root = index.root

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _store(root)
        for batch in batches:
            rows = list(batch.itertuples(index=False))
            i = 0
            while i < len(rows):
                j, end = i + 1, rows[i].at + rows[i].size
                while j < len(rows) and rows[j].file == rows[i].file and rows[j].at == end and end - rows[i].at < READ_BYTES:
                    end, j = end + rows[j].size, j + 1
                with store.open_input_file(f"{folder}/{rows[i].file}") as file:
                    data = file.read_at(end - rows[i].at, rows[i].at)
                yield pd.DataFrame([_capture(row, data[row.at - rows[i].at:][:row.size]) for row in rows[i:j]], columns=_FIELDS)
                i = j

    placed = lines.repartitionByRange("file", "at").sortWithinPartitions("file", "at")
    out = placed.mapInPandas(
        fetch, "key string, id string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary")
    return out.withColumns({"id": F.nullif("id", F.lit("")).cast("long"), "refers_to": F.col("refers_to").cast("long")})


_FIELDS = ["key", "id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
_PAGE = re.compile(r"<urn:page:(-?\d*)>")


def _capture(line, data: bytes) -> tuple:
    fields, payload = parse_record(data)
    page = _PAGE.fullmatch(fields["warc-record-id"])[1]
    if page != line.id:
        raise ValueError(f"the index names page {line.id} where the archive has {page}")
    kind, digest, size = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["http-content-length"])
    if kind == "response" and (digest != payload_digest(payload) or size != len(payload)):
        raise ValueError(f"the payload of page {page} is damaged")
    refers = fields.get("warc-refers-to")
    return line.key, line.id, kind, _PAGE.fullmatch(refers)[1] if refers else None, size, digest, payload if kind == "response" else None
