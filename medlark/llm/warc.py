"""WARC archives and a two-level capture index over them."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlark.functions.storage import cut_lineage, scratch_path
from medlark.functions.types import col

#: A payload below this size is always stored, even if it repeats another.
LEAST_REVISIT_BYTES = 100
#: An archive file is closed at about this size.
ARCHIVE_BYTES = 1 << 30
#: Captures in one index file, about, and in one of its compressed blocks.
FILE_LINES = 200_000
BLOCK_LINES = 500
#: Repeated payloads are broadcast up to so many, else joined by a shuffle.
MOST_BROADCAST = 500_000

CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def url_key(url: Column) -> Column:
    """The address with its host reversed, so that a domain's captures stand together.

    ``https://www.example.org/a?b`` gives ``org,example,www)/a?b``. White space and control characters
    become ``%20``; a null address has the key of an empty one.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "[\\x00-\\x20\\x7F]", "%20"),
                            "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, "^([^/?#]*)", 1)
    name = F.lower(F.regexp_extract(host, "^(?:[^@]*@)?([^:]*)", 1))
    port = F.regexp_extract(host, "(:[0-9]*)$", 1)
    tail = F.regexp_replace(bare, "^[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(name, "\\.")), ","), port, F.lit(")"),
                    F.when(tail == "", "/").otherwise(tail))


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member of its own."""
    kind = "response" if refers_to is None else "revisit"
    body = _HTTP + payload if refers_to is None else _HTTP
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", "%20", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(body)}")
    text = "WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + body + b"\r\n\r\n") + packer.flush()


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _page(urn: str | None) -> int | None:
    name = urn[len("<urn:page:"):-1] if urn else "None"
    return None if name == "None" else int(name)


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_revisit: int = LEAST_REVISIT_BYTES, most_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per page into WARC files of ``folder``; returns the captures.

    Each task writes files under names of its own, so a repeated or speculative task never touches
    another's; the captures (key, page_id, file, offset, length), stored as a table, name
    the files that count. Payloads of at least ``least_revisit`` bytes that repeat one with a smaller
    page_id become revisit records without a body. Only digests are compared; pages stay where they are
    when the repeated digests are few enough to broadcast.
    """
    own = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"),
                       F.coalesce(col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    marked = own.withColumn("digest", F.sha2("payload", 256))
    repeated = cut_lineage(
        marked.where(F.octet_length("payload") >= least_revisit).groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
        .where((F.col("n") > 1) & F.col("first").isNotNull()).select(F.col("digest").alias("_digest"), "first"))
    few = repeated.count() <= MOST_BROADCAST
    joined = marked.join(F.broadcast(repeated) if few else repeated, F.col("digest") == F.col("_digest"), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    rows = joined.select(url_key(F.col("url")).alias("key"), "page_id", "url", "payload", "digest",
                         refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        out, name, at = None, "", 0
        store.create_dir(root, recursive=True)
        try:
            for batch in batches:
                names, offsets, lengths = [], [], []
                for i in range(batch.num_rows):
                    _, page_id, url, payload, digest, refers_to = (c[i].as_py() for c in batch.columns)
                    if out is None or at >= most_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    member = _record(page_id, url, payload, digest, refers_to)
                    out.write(member)
                    names.append(name)
                    offsets.append(at)
                    lengths.append(len(member))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(offsets, pa.int64()),
                     pa.array(lengths, pa.int64())], names=["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return cut_lineage(rows.mapInArrow(write, CAPTURE))


def build_index(captures: DataFrame, folder: str, file_lines: int = FILE_LINES,
                block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the capture index; returns its files with their first and last key.

    Captures are sorted by key over all files. An index file is a row of compressed blocks and,
    at its end, a sparse directory with the first key and the place of every block. A key with very
    many captures goes over as many files as it takes, since the page id is part of the order.
    """
    n = captures.count()
    ordered = captures.repartitionByRange(n // file_lines + 1, "key", "page_id", "file", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.idx"
        out, at, directory, lines, last = None, 0, [], [], ""

        def block() -> None:
            nonlocal at
            data = zlib.compress("\n".join(lines).encode())
            directory.append(f"{lines[0].partition(chr(9))[0]}\t{at}\t{len(data)}")
            out.write(data)
            at += len(data)
            lines.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                last = row[0]
                lines.append("\t".join(map(str, row)))
                if len(lines) == block_lines:
                    block()
        if out is not None:
            if lines:
                block()
            data = zlib.compress("\n".join(directory).encode())
            out.write(data + struct.pack("<Q", len(data)))
            out.close()
            yield pa.RecordBatch.from_pydict({
                "file": [name], "first_key": [directory[0].partition("\t")[0]], "last_key": [last]})

    files = ordered.sortWithinPartitions("key", "page_id", "file", "offset").mapInArrow(
        write, "file string, first_key string, last_key string")
    return cut_lineage(files)


class _IndexFile:
    """Binary search in one index file; the last block read is kept."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        (n,) = struct.unpack("<Q", self.file.read_at(8, size - 8))
        rows = [x.rsplit("\t", 2) for x in zlib.decompress(self.file.read_at(n, size - 8 - n)).decode().split("\n")]
        self.keys = [r[0] for r in rows]
        self.places = [(int(r[1]), int(r[2])) for r in rows]
        self.held, self.lines, self.line_keys = -1, [], []

    def find(self, key: str) -> Iterator[list[str]]:
        # The key may begin in the block before the first that starts with it.
        for i in range(max(0, bisect_left(self.keys, key) - 1), bisect_right(self.keys, key)):
            if i != self.held:
                at, n = self.places[i]
                self.lines = [x.split("\t") for x in zlib.decompress(self.file.read_at(n, at)).decode().split("\n")]
                self.line_keys, self.held = [x[0] for x in self.lines], i
            yield from self.lines[bisect_left(self.line_keys, key): bisect_right(self.line_keys, key)]


def look_up(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """All captures of the given distinct ``key`` values.

    The list of index files, one row each, is searched first; a task then has the keys of whole files in
    order, searches each file's directory and reads just the blocks that can hold a key.
    """
    files = sorted(((r["first_key"], r["last_key"], r["file"]) for r in index.collect()))
    firsts, lasts, names = ([f[i] for f in files] for i in range(3))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [(names[i], k) for k in b.column(0).to_pylist()
                     for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_pydict({"file": pa.array([p[0] for p in pairs], pa.string()),
                                              "key": pa.array([p[1] for p in pairs], pa.string())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        name, opened = "", None
        for b in batches:
            found: list[list[str]] = []
            for file, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if file != name:
                    name, opened = file, _IndexFile(store, f"{root}/{file}")
                for line in opened.find(key):
                    found.append(line)
                    if len(found) == 10_000:
                        yield _captures(found)
                        found = []
            yield _captures(found)

    routed = keys.select("key").mapInArrow(route, "file string, key string")
    return routed.repartition("file").sortWithinPartitions("file", "key").mapInArrow(search, CAPTURE)


def _captures(lines: list[list[str]]) -> pa.RecordBatch:
    cells = list(zip(*lines)) or [()] * 5
    number = lambda c: pa.array([None if x == "None" else int(x) for x in c], pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(cells[0], pa.string()), number(cells[1]), pa.array(cells[2], pa.string()), number(cells[3]),
         number(cells[4])], names=["key", "page_id", "file", "offset", "length"])


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """Read the records of captures by range: page_id, record_type, payload_bytes, payload_digest, refers_to.

    Size and digest of a response are taken from the payload as read. A revisit has the digest of its
    header and no size here; ``resolve`` takes it from the response.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        name, opened = "", None
        for b in batches:
            out = []
            for file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if file != name:
                    name, opened = file, store.open_input_file(f"{root}/{file}")
                fields, payload = _parse(opened.read_at(length, offset))
                stored = fields["WARC-Type"] == "response"
                out.append((_page(fields["WARC-Record-ID"]), fields["WARC-Type"], len(payload) if stored else None,
                            hashlib.sha256(payload).hexdigest() if stored
                            else fields["WARC-Payload-Digest"].removeprefix("sha256:"),
                            _page(fields.get("WARC-Refers-To"))))
            cells = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=[
                "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"])

    near = captures.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return near.mapInArrow(read, RECORD)


def resolve(records: DataFrame) -> DataFrame:
    """Give each revisit the size of the response it refers to."""
    stored = records.where("record_type = 'response'").groupBy(
        F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).agg(
        F.max("payload_bytes").alias("_bytes"))
    joined = records.join(stored, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")),
                          "left")
    return joined.select("page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), "payload_digest",
                         "record_type", "refers_to")


def archive_round_trip(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                       html_col: str = "html", least_revisit: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write all pages as WARC, index them, look every address up and read the records back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to per page. A null html is an
    empty payload, a null address has an empty key; pages of one address are all found. Of rows that
    repeat the smallest page_id with one payload all are responses; a null page_id is larger than any.
    An empty table gives no rows. Other columns are ignored. Files go to a new folder in the
    shared one unless ``folder`` names another that all executors reach.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, id_col, url_col, html_col, least_revisit)
    index = build_index(captures, f"{folder}/index")
    keys = pages.select(url_key(col(url_col).cast("string")).alias("key")).distinct()
    records = cut_lineage(read_records(look_up(keys, index, f"{folder}/index"), folder))
    return resolve(records)


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM q WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, q.payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM q LEFT JOIN f ON q.payload_digest = f.payload_digest AND payload_bytes >= 100
"""
