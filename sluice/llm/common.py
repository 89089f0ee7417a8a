"""What the operators share: scratch tables in the shared folder, and bytes out of Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: the ASCII white space that ``bytes.split()`` splits on.
WORD = r"[^\x20\x09-\x0D]+"
#: Lower-cases A-Z and leaves every other byte alone.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; set to a temporary one only where a local session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sluice-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Workspace:
    """Scratch tables of one run, written as Parquet under the shared folder so that a lost executor loses nothing.

    Tables that the returned DataFrame still reads stay until the folder is cleaned; ``drop`` removes the others.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.path = spark, f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        df.write.option("compression", codec).parquet(f"{self.path}/{name}")
        return self.load(name, df.schema)

    def load(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            at.getFileSystem(conf).delete(at, True)

    def tidy(self) -> None:
        """Lets the driver forget shuffles that no plan needs any more, so that their files go."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str = "text") -> Column:
    """The text's UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def bucket_of(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % mod


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a binary Arrow column without nulls; no copy is made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets.astype(np.int64)


def bytes_of(column: pa.Array) -> list[bytes]:
    """``to_pylist`` of a binary Arrow column without nulls, for many short values."""
    data, offsets = buffer_of(column)
    raw, cuts = data[offsets[0] : offsets[-1]].tobytes() if len(offsets) else b"", (offsets - offsets[:1]).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str, per_yield: int = 1 << 18) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``key`` from batches sorted by it; holds one run and a few batches at most."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < per_yield:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        keys = whole.column(key).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield whole.slice(0, cut)
        held = whole.slice(cut).to_batches()
        rows = len(keys) - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start, and the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def local_components(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the edges (a, b): hooking and pointer jumping."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            break
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up
    return root
