"""WARC archives, written from and read as a chunked record table: Python holds a few chunks of a record at a time, never all of it."""

from __future__ import annotations

import base64
import hashlib
import io
import os
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace

CHUNK = 256 * 1024
#: An archive is closed after the record that takes it to this size.
ARCHIVE_BYTES = 64 << 20
CHUNKS = "archive string, record_id string, page_id long, record_type string, refers_to long, chunk_no long, last boolean, chunk binary, payload_bytes long, payload_digest string, declared_digest string"


class Files:
    """Files below a shared folder: local or mounted ones directly, other stores through pyarrow's file systems."""

    def __init__(self, root: str):
        self.root = root
        url = urllib.parse.urlparse(root)
        self.local = urllib.parse.unquote(url.path) if url.scheme in ("", "file") else None

    def open(self, name: str, mode: str):
        if self.local is not None:
            if mode == "wb":
                os.makedirs(self.local, exist_ok=True)
            return open(f"{self.local}/{name}", mode)
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root)
        return store.open_output_stream(f"{base}/{name}") if mode == "wb" else store.open_input_stream(f"{base}/{name}")

    def rename(self, a: str, b: str) -> None:
        if self.local is not None:
            return os.replace(f"{self.local}/{a}", f"{self.local}/{b}")
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root)
        store.move(f"{base}/{a}", f"{base}/{b}")


def base32_of_hex(hex_digits: Column) -> Column:
    """Upper-case base32 of 40 hex digits: each five of them are four letters of five bits."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for k in range(0, 40, 5):
        n = F.conv(F.substring(hex_digits, k + 1, 5), 16, 10).cast("int")
        parts += [F.substr(letters, F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*parts)


def plan(pages: DataFrame, least: int = 0, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """page_id, digest, record_type, refers_to per row: of equal payloads of ``least`` bytes or more, the row with the largest id is the response."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("hex"), F.octet_length(payload).cast("long").alias("n"))
    keeps = rows.where(F.col("n") >= least).groupBy("hex", "n").agg(F.max("page_id").alias("keep"))
    rows = rows.join(keeps, ["hex", "n"], "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return rows.select("page_id", "hex", base32_of_hex(F.col("hex")).alias("digest"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("keep")).alias("refers_to"))


def header(fields: list[tuple[str, object]]) -> bytes:
    clean = lambda v: urllib.parse.quote(str(v), safe="".join(map(chr, range(33, 127))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def record_id(page: int | None, digest: str, copy: int = 0) -> str:
    """The name of a page's record: the same wherever it is written, so that revisits can refer to it. ``copy`` numbers rows that repeat page and payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}' + f':{copy}' * (copy > 0))}>"


def writer(root: str, date: str, archive_bytes: int):
    """A mapInArrow function that writes records from rows of their chunks (page_id, url, n, digest, record_type, refers_to, copy, chunk_no, chunk), in
    order, and returns the archives' names.

    Every record is a gzip member of its own, deflated chunk by chunk as the rows come. A file appears under its final name
    only when it is complete, and the name holds its partition, number and attempt, so a task that runs twice does no harm: only
    names that a successful attempt returned are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, part, attempt = Files(root), TaskContext.get().partitionId(), uuid.uuid4().hex[:8]
        out, name, names, size, left, deflate = None, "", [], 0, 0, None
        for batch in batches:
            heads = [batch.column(c).to_pylist() for c in range(8)]
            for page, url, n, digest, kind, refers_to, copy, no, chunk in zip(*heads, batch.column(8), strict=True):
                if no == 0:
                    if out is None:
                        name, size = f"part-{part:05d}-{len(names):05d}-{attempt}.warc.gz", 0
                        out = files.open(f"{name}.tmp", "wb")
                    left = n if kind == "response" else 0
                    top = header(
                        [
                            ("WARC-Type", kind),
                            ("WARC-Record-ID", record_id(page, digest, copy)),
                            ("WARC-Date", date),
                            ("WARC-Target-URI", url),
                            ("WARC-Payload-Digest", f"sha1:{digest}"),
                            ("WARC-Refers-To", record_id(refers_to, digest) if kind == "revisit" else None),
                            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None),
                            ("X-Page-ID", page),
                            ("X-Refers-To-Page-ID", refers_to),
                            ("X-Payload-Length", n),
                            ("Content-Type", "text/html; charset=utf-8"),
                            ("Content-Length", left),
                        ]
                    )
                    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
                    size += out.write(deflate.compress(top)) or 0
                data = memoryview(chunk.as_buffer()) if left else b""
                size += out.write(deflate.compress(data)) or 0
                left -= len(data)
                if left:
                    continue
                size += out.write(deflate.compress(b"\r\n\r\n") + deflate.flush()) or 0
                if size >= archive_bytes:
                    out.close()
                    files.rename(f"{name}.tmp", name)
                    names.append(name)
                    out = None
        if left:
            raise ValueError("a record lacks chunks")
        if out is not None:
            out.close()
            files.rename(f"{name}.tmp", name)
            names.append(name)
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names)], ["archive"])

    return run


class Inflated(io.RawIOBase):
    """The bytes of a file of gzip members, one after another, without more than a block in memory."""

    def __init__(self, raw, block: int = 1 << 16):
        self.raw, self.block, self.z, self.rest = raw, block, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if self.z.eof:
                self.rest, self.z = self.z.unused_data or self.rest, zlib.decompressobj(31)
            data = self.rest or self.raw.read(self.block)
            if not data:
                return 0
            got = self.z.decompress(data, len(into))
            self.rest = self.z.unconsumed_tail if not self.z.eof else b""
            if self.z.eof and not self.z.unused_data:
                self.z = zlib.decompressobj(31)
            elif self.z.eof:
                self.rest, self.z = self.z.unused_data, zlib.decompressobj(31)
            if got:
                into[: len(got)] = got
                return len(got)


def chunks_of(stream: io.BufferedReader, chunk: int) -> Iterator[dict]:
    """Rows of the chunked record table from one archive; digests go along from chunk to chunk."""
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            fields[k.lower()] = urllib.parse.unquote(v) if k == "WARC-Target-URI" else v
        left, digest, done, no = int(fields["content-length"]), hashlib.sha1(), 0, 0
        page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
        while True:
            data = stream.read(min(chunk, left))
            if len(data) < min(chunk, left):
                raise ValueError("the archive ends within a record")
            left -= len(data)
            done += len(data)
            digest.update(data)
            declared = fields["warc-payload-digest"].removeprefix("sha1:")
            own = base64.b32encode(digest.digest()).decode()
            whole = fields["warc-type"] == "response"
            if not left and whole and own != declared:
                raise ValueError(f"record {fields['warc-record-id']}: payload {own}, header {declared}")
            yield {
                "record_id": fields["warc-record-id"],
                "page_id": int(page) if page else None,
                "record_type": fields["warc-type"],
                "refers_to": int(refers) if refers else None,
                "chunk_no": no,
                "last": not left,
                "chunk": data,
                "payload_bytes": done if whole else int(fields["x-payload-length"]),
                "payload_digest": own if whole else declared,
                "declared_digest": declared,
            }
            no += 1
            if not left:
                break
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record without its end")


def reader(root: str, chunk: int, with_bytes: bool):
    """A mapInArrow function: archive names to rows of CHUNKS; at most a few chunks are in memory."""
    schema = pa.schema([("archive", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("chunk_no", pa.int64()), ("last", pa.bool_()), ("chunk", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("declared_digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open(name, "rb") as raw:
                    for row in chunks_of(io.BufferedReader(Inflated(raw), 1 << 16), chunk):
                        held += len(row["chunk"])
                        if not with_bytes:
                            row["chunk"] = None
                        rows.append(row | {"archive": name})
                        if held >= 4 * chunk or len(rows) >= 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def write_archives(pages: DataFrame, ws: Workspace, root: str, least: int = 0, date: str = "2024-01-01T00:00:00Z", chunk: int = CHUNK, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes one record per row of ``pages`` (page_id, url, html) below ``root``; gives the archives' names.

    Payloads are cut into chunks of ``chunk`` bytes before they go to the writers, a row per record and chunk, so a payload of any length passes
    through Python piece by piece. A revisit refers to its response by that record's WARC-Record-ID, and has no chunk with bytes.

    Null payloads are empty, null urls are left out, extra columns are ignored. Rows that repeat a page_id and payload are all
    records, numbered; each that carries the largest page_id of its payload is a response, and revisits refer to the first of them. A null page_id is
    smaller than any other. No rows give no archives.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("hex"))
    known = plan(pages, least).groupBy("page_id", "hex", "digest", "record_type", "refers_to").agg(F.count("*").alias("rows"))
    known = ws.save(known, "plan")
    same = rows.page_id.eqNullSafe(known.page_id) & (rows.hex == known.hex)
    records = rows.join(known, same).select(rows.page_id, "url", "payload", F.octet_length("payload").cast("long").alias("n"), "digest", "record_type", "refers_to", "rows")
    once = records.withColumn("copy", F.lit(0))
    if known.where("rows > 1").head(1):  # only these rows need an order, for which the payloads are read a second time
        again = records.where("rows > 1").withColumn("copy", F.row_number().over(W.partitionBy("page_id", "digest").orderBy("url")) - 1)
        once = once.where("rows = 1").unionByName(again)
    records = once
    last = F.when(F.col("record_type") == "response", F.greatest(F.ceil(F.col("n") / chunk) - 1, F.lit(0))).otherwise(F.lit(0)).cast("int")
    piece = F.when(F.col("record_type") == "response", F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk))).otherwise(F.lit(b""))
    chunks = records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last))).select("page_id", "url", "n", "digest", "record_type", "refers_to", "copy", "chunk_no", piece.alias("chunk"))
    return ws.save(chunks.mapInArrow(writer(root, date, archive_bytes), "archive string"), "archives")


def read_archives(archives: DataFrame, root: str, chunk: int = CHUNK, with_bytes: bool = True) -> DataFrame:
    """The chunked record table of archives: a row per record and chunk, with the payload's length and SHA-1 up to and including it.

    The row with ``last`` has those of the whole payload, checked against the record's header. A revisit has one empty chunk and
    carries its header's values.
    """
    spread = archives.repartition(max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(reader(root, chunk, with_bytes), CHUNKS)


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk: no chunk is moved between tasks."""
    return chunks.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
