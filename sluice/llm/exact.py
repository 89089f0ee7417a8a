"""Exact deduplication through an extendible-hash index: owner tasks chain the entries of their buckets and compare bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

#: Distinct keys a bucket may hold before it splits, and how many buckets there are about at most; beyond that they hold more.
BUCKET_ENTRIES, MOST_BUCKETS = 1_000, 1 << 17
#: Bytes of distinct texts that a task combines before it passes them on, and bytes of text for each owner task, about.
UNIT_BYTES, OWNER_BYTES = 16 << 20, 128 << 20
#: Bits of a key that the directory may use.
MOST_BITS = 40


@dataclass(frozen=True)
class Directory:
    """Bucket numbers in order of key prefix: bucket k has the keys from ``lows[k]`` up to the next bucket's."""

    depth: int
    buckets: tuple[tuple[int, int], ...]  # (local depth, prefix of that many bits)

    @property
    def lows(self) -> list[int]:
        return [p << (MOST_BITS - d) for d, p in self.buckets]


def grow(counts, capacity: int) -> Directory:
    """Splits overfull buckets, doubling the directory where a bucket already uses all its bits.

    ``counts(depth, prefixes, parent)`` gives the entries per prefix of ``depth`` bits below the given prefixes of ``parent`` bits, and so
    only overfull buckets are counted anew: the driver sees about two counts per bucket, never a key of each row.
    Entries with equal keys can't be parted by bits; such a bucket stops at MOST_BITS and its entries are chained.
    """
    depth, done, full = 0, [], {0: counts(0, None, 0).get(0, 0)}
    if full[0] <= capacity:
        return Directory(0, ((0, 0),))
    while full:
        step = min(MOST_BITS - depth, max(1, min(8, (max(full.values()) // capacity).bit_length())))
        if not step:
            done += [(depth, p) for p in full]
            break
        found = counts(depth + step, list(full), depth)
        after: dict[int, int] = {}

        def split(p: int, d: int) -> None:
            n = sum(found.get(q, 0) for q in range(p << (depth + step - d), (p + 1) << (depth + step - d)))
            if n <= capacity:
                done.append((d, p))
            elif d == depth + step:
                after[p] = n
            else:
                split(2 * p, d + 1)
                split(2 * p + 1, d + 1)

        for p in full:
            split(p, depth)
        depth, full = depth + step, after
    done.sort(key=lambda x: x[1] << (MOST_BITS - x[0]))
    return Directory(max(d for d, _ in done), tuple(done))


def prefix(key: str, bits: int) -> Column:
    """The top ``bits`` of a 64-bit key, as a number."""
    return F.shiftrightunsigned(F.col(key), 64 - bits) if bits else F.lit(0).cast("long")


def directory_of(keys: DataFrame, capacity: int = BUCKET_ENTRIES) -> Directory:
    """The directory over distinct keys (column ``key``)."""

    def counts(bits: int, below: list[int] | None, parent: int) -> dict[int, int]:
        rows = keys.withColumn("p", prefix("key", bits))
        if below is not None and parent:
            rows = rows.where(prefix("key", parent).isin(below)) if len(below) <= 1000 else rows
        return {r["p"]: r["n"] for r in rows.groupBy("p").agg(F.count("*").alias("n")).collect()}

    return grow(counts, max(capacity, keys.count() // MOST_BUCKETS + 1))


ENTRY = "bucket int, key long, n long, sha binary, text binary, keep_id long, group_size long"
INDEX = "bucket int, key long, n long, sha binary, chain int, keep_id long, group_size long"


def entry_batches(lows: np.ndarray):
    """A mapInArrow function: (key, sha, doc_id, text) to entries with their bucket, one per distinct text of a unit of rows.

    So a group of copies, however large, is one entry per unit when it is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            keys = np.array([k for k, _ in held], np.int64)
            slot = (keys.view(np.uint64) >> np.uint64(64 - MOST_BITS)).astype(np.int64)
            bucket = (np.searchsorted(lows, slot, side="right") - 1).astype(np.int32)
            texts, rest = [t for _, t in held], list(zip(*held.values(), strict=True))
            out = [pa.array(bucket), pa.array(keys), pa.array([len(t) for t in texts], pa.int64()), pa.array(rest[0], pa.binary()), pa.array(texts, pa.binary()), pa.array(rest[1], pa.int64()), pa.array(rest[2], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(out, ["bucket", "key", "n", "sha", "text", "keep_id", "group_size"])

        for batch in batches:
            for key, sha, doc, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
                text = text.as_py()
                found = held.get((key, text))
                if found is None:
                    held[key, text] = [sha.as_py(), doc, 1]
                    size += len(text) + 200
                    if size > UNIT_BYTES:
                        yield flush()
                        size = 0
                else:
                    found[2] += 1
                    if doc is not None and (found[1] is None or doc > found[1]):
                        found[1] = doc
        if held:
            yield flush()

    return run


def owner_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of a task's buckets, sorted by bucket, key, length and digest, to the index: one row per distinct text, whose copies are found by comparing bytes.

    Texts with one key form a chain, numbered in that order. Equal ones are neighbours in it, so no more than one text and a batch
    are held. Two texts that differ though length and SHA-256 are equal could not be looked up: they end the job.
    """
    now, text, chain, keep, size = None, b"", 0, None, 0
    out: list[tuple] = []

    def pack() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [()] * 7
        types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["bucket", "key", "n", "sha", "chain", "keep_id", "group_size"])

    for batch in batches:
        heads = zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)
        for head, own, doc, n in zip(heads, batch.column(4), batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
            own = own.as_py()
            if head == now:
                if own != text:
                    raise ValueError(f"different texts with SHA-256 {head[3].hex()}")
                size += n
                keep = doc if keep is None else keep if doc is None else max(keep, doc)
                continue
            if now is not None:
                out.append((*now, chain, keep, size))
            chain = chain + 1 if now is not None and head[1] == now[1] else 0
            now, text, keep, size = head, own, doc, n
        yield pack()
        out = []
    if now is not None:
        out.append((*now, chain, keep, size))
    yield pack()


def build_index(docs: DataFrame, rows: DataFrame, ws: Workspace, capacity: int = BUCKET_ENTRIES) -> tuple[DataFrame, Directory]:
    """The index of ``docs`` (key, sha, doc_id, text) in shared files, written by the owner tasks of its buckets, and the directory.

    ``rows`` are the documents' keys, written. The directory (at most some MOST_BUCKETS numbers) goes to every task.
    """
    directory = directory_of(ws.save(rows.select("key").distinct(), "keys"), capacity)
    lows = np.array(directory.lows, np.int64)
    total = rows.agg(F.sum("n")).first()[0] or 0
    owners = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // OWNER_BYTES))
    owned = docs.mapInArrow(entry_batches(lows), ENTRY).repartitionById(owners, F.pmod("bucket", F.lit(owners)).cast("int")).sortWithinPartitions("bucket", "key", "n", "sha")
    return ws.save(owned.mapInArrow(owner_batches, INDEX), "index"), directory


def exact_dedup(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_ENTRIES, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    ``key`` gives a text's 64-bit key, whose top bits choose the bucket through the directory; a directory that is doubled until no
    bucket holds over ``capacity`` distinct keys. Texts that are equal in their bytes are combined before anything is shuffled, so a group with a
    third of all rows is one entry per task. The owner of a bucket chains the entries of a key and compares their bytes: that decides which texts
    are equal, which row stays, and how large a group is. Every row then looks its place in the chain up by key, length and SHA-256; the index has one row for
    it, so a hot group's rows can be split among tasks.

    Null texts count as empty. Of equal texts the row with the largest id stays; a null id is smaller than any
    other. Of rows repeated with that very id, each counts as kept. An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    wide = docs.select(F.col(id_col).cast("long").alias("doc_id"), key(text).cast("long").alias("key"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"), text.cast("binary").alias("text"))
    rows = ws.save(wide.select("doc_id", "key", "sha", F.octet_length("text").cast("long").alias("n")), "rows")
    index, _ = build_index(wide.select("key", "sha", "doc_id", "text"), rows, ws, capacity)
    found = rows.join(index.select("key", "n", "sha", "keep_id", "group_size"), ["key", "n", "sha"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
