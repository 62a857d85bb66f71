"""WARC archives: written once, read back through an index in coalesced byte ranges.

Every page becomes one record, a gzip member of its own, so that any record can be read without the others. Of
pages with equal payloads, the one with the largest id is a ``response`` record and the others are ``revisit``
records that name it; payloads under ``least_bytes`` are all responses. Equal payloads meet on their SHA-1, as
slim rows; the pages themselves are joined to that, and a hot payload is split by the join.

Each writing task makes archives of its own in ``folder`` (a place every executor reaches), under names that no
other attempt uses; the index (file, offset, length, url, digest, ...) is a Parquet table beside them and names
only records of tasks that ended well, so lost executors leave unused files at worst. The reader takes any
selection of index rows, deals them by file and stretch over as many tasks as their bytes need, sorts them by offset, and reads neighbours in one go.
Digests of all payloads read are checked.

Edge cases: a null payload is empty; a null url leaves the header out; a null id is no one's response unless all
ids of its payload are null; rows with the same id and payload are all responses; control characters and
non-ASCII in urls and ids are percent-encoded in headers; an empty table makes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from contextlib import closing
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column

LEAST_BYTES = 0
DATE = "2000-01-01T00:00:00Z"
#: A new archive is begun beyond this size.
ARCHIVE_BYTES = 1 << 30
#: Bytes read at once at most, and bytes between two records that are read over rather than skipped.
STRETCH, GAP = 8 << 20, 64 << 10
#: Archive bytes that one reading task is given, about.
TASK_BYTES = 128 << 20

INDEX = "file string, offset bigint, length bigint, url string, digest string, record_id string, record_type string"
READ = "record_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
#: Fixed value: the profile of a revisit that has the same payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_name(page: str | None) -> str:
    return "<urn:x-no-page:>" if page is None else f"<urn:x-page:{quote(page, safe='')}>"


def record(page: str | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """One record; a revisit keeps the HTTP head with the full payload's length, and no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_name(page)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%:/?#[]@!$&()*+,;=~-._' + chr(39))}")
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, the full payload's length and the payload that is there."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    return headers, size, payload


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class Archive:
    """The archive a task is writing; a new one is begun when it is full."""

    def __init__(self, folder: str):
        self.store, self.place = fs.FileSystem.from_uri(folder)
        self.stream, self.file, self.offset = None, None, 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.offset >= ARCHIVE_BYTES:
            self.close()
            self.file, self.offset = f"{uuid.uuid4().hex}.warc.gz", 0
            self.stream = self.store.open_output_stream(f"{self.place}/{self.file}", compression=None)
        packed = _member(data)
        self.stream.write(packed)
        at = (self.file, self.offset, len(packed))
        self.offset += len(packed)
        return at

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def with_leader(pages: DataFrame, key: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """id, url, payload, size, sha1 and leader: the largest id with that payload, null where none is revisited."""
    whole = pages.select(
        column(pages, key).cast("string").alias("id"), column(pages, key).alias("rank"), column(pages, url).alias("url"),
        F.coalesce(column(pages, payload), F.lit("")).alias("payload"),
    ).withColumns({"size": F.octet_length("payload").cast("bigint"), "sha1": F.sha1("payload")})
    leaders = whole.where(F.col("size") >= least_bytes).groupBy("sha1").agg(F.max("rank").cast("string").alias("leader"))
    return whole.drop("rank").join(leaders, "sha1", "left")


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the archives and their index under ``folder`` (new, with a scheme); returns the index as it was written."""
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{place}/archives")
    archives = f"{folder}/archives"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with closing(Archive(archives)) as out:
            for rows in batches:
                index = []
                for r in rows.itertuples(index=False):
                    digest = base64.b32encode(bytes.fromhex(r.sha1)).decode()
                    name, link, leader = (None if x is None or x != x else x for x in (r.id, r.url, r.leader))
                    revisit = leader is not None and leader != name
                    data = record(name, link, r.payload.encode(), r.size, digest, leader, revisit)
                    index.append((*out.add(data), link, digest, record_name(name), "revisit" if revisit else "response"))
                yield pd.DataFrame(index, columns=[c.split()[0] for c in INDEX.split(", ")])

    with_leader(pages, key, url, payload, least_bytes).mapInPandas(run, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index")


def read(selected: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows, as READ (payload null for revisits, or where not wanted).

    The index rows are slim and would be merged into few tasks, so the number of tasks follows the archive bytes
    that they name: one for every ``TASK_BYTES``, and two for every core at least, each with stretches of its own.
    """
    archives = f"{folder}/archives"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = fs.FileSystem.from_uri(archives)
        for rows in batches:
            for file, begin, end, members in _stretches(rows):
                with store.open_input_file(f"{place}/{file}") as source:
                    data = source.read_at(end - begin, begin)
                out = [_checked(zlib.decompress(data[o - begin : o - begin + n], 31), payloads) for o, n in members]
                yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")])

    wanted = selected.select("file", "offset", "length")
    total = wanted.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(-(-total // TASK_BYTES), 2 * selected.sparkSession.sparkContext.defaultParallelism)
    stretch = F.floor(F.col("offset") / min(STRETCH, max(total // (4 * tasks), GAP)))
    return wanted.repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset").mapInPandas(run, READ)


def _stretches(rows: pd.DataFrame) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted rows as (file, begin, end, records): neighbours are read together, up to STRETCH bytes."""
    file, begin, end, members = None, 0, 0, []
    for f, o, n in zip(rows["file"], rows["offset"], rows["length"], strict=True):
        if f != file or o - end > GAP or o + n - begin > STRETCH:
            if members:
                yield file, begin, end, members
            file, begin, members = f, o, []
        end = o + n
        members.append((o, n))
    if members:
        yield file, begin, end, members


def _checked(raw: bytes, payloads: bool) -> tuple:
    headers, size, payload = parse(raw)
    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is not the one that was written")
    body = payload if payloads and kind == "response" else None
    url = headers.get("WARC-Target-URI")
    return headers["WARC-Record-ID"], url, size, digest, kind, headers.get("WARC-Refers-To"), body


def page_id(name: str, kind: str) -> Column:
    """The page id in a record name, as the type ``kind``."""
    raw = F.regexp_extract(name, r"^<urn:x-page:(.*)>$", 1)
    return F.when(F.startswith(F.col(name), F.lit("<urn:x-page:")), F.url_decode(raw)).cast(kind)


def report(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages, read all records: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    kind = dict(pages.dtypes)["page_id"]
    back = read(write(pages, folder), folder, payloads=False)
    return back.select(
        page_id("record_id", kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_id("refers_to", kind).alias("refers_to"),
    )
