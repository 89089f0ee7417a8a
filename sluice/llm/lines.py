"""Line deduplication by winnowing over line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, text_of

#: Consecutive lines that make a repeated run.
RUN = 3
#: Words that make a run of fewer lines: a passage of over 50 words may be one or two lines.
RUN_WORDS = 50
#: Parts that the places of a fingerprint, or of an extent, are dealt to.
SALTS = 8
MARK = "named boolean, id long, row long, fp long, at int, windows array<struct<at:int,size:int,digest:binary>>"


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each window of ``window`` hashes, the place of its least hash, the last of equals."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.arange(len(views)) + window - 1 - views.argmin(axis=1)


def mark_batches(run: int, words: int | None = None):
    """A mapInArrow function: (named, id, row, text) to a row per selected fingerprint of a text.

    A fingerprint is a line whose hash is the least of a window of ``run`` lines, or of fewer that have ``words`` words together. Each line is
    selected once, however many windows it is the least of; with it go those windows, which are how far a match reaches from it to the
    left and to the right: their first lines, sizes, and 128-bit digests of their lines' 128-bit hashes.
    """
    import xxhash

    digest = xxhash.xxh3_128_digest
    window = pa.struct([("at", pa.int32()), ("size", pa.int32()), ("digest", pa.binary())])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, fps, places, counts, ats, sizes, digests = [], [], [], [], [], [], []
            for k, text in enumerate(batch.column(3)):
                text = text.as_py()
                if not text:
                    continue
                own = text.split(b"\n")
                joined = b"".join(map(digest, own))
                hashes = np.frombuffer(joined, np.int64)[::2]
                upto = np.cumsum([0, *(len(x.split()) for x in own)]) if words is not None else None
                chosen: dict[int, list[tuple[int, int]]] = {}
                for size in range(run if words is None else 1, run + 1):
                    for at, mark in enumerate(winnow(hashes, size).tolist()):
                        if size == run or upto[at + size] - upto[at] >= words:
                            chosen.setdefault(mark, []).append((at, size))
                for mark, windows in chosen.items():
                    who.append(k)
                    fps.append(hashes[mark])
                    places.append(mark)
                    counts.append(len(windows))
                    for at, size in windows:
                        ats.append(at)
                        sizes.append(size)
                        digests.append(digest(joined[16 * at : 16 * (at + size)]))
            reach = pa.StructArray.from_arrays([pa.array(ats, pa.int32()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary())], fields=list(window))
            cuts = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            take = pa.array(who, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in range(3)), pa.array(fps, pa.int64()), pa.array(places, pa.int32()), pa.ListArray.from_arrays(cuts, reach)], ["named", "id", "row", "fp", "at", "windows"])

    return go


def cut_batches():
    """(named, id, text, places and sizes of repeated windows) to the text that is left; windows that touch or overlap are one maximal run."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, n_lines, n_cut, n_runs = [], [], [], []
            for text, at in zip(batch.column(2), batch.column(3), strict=True):
                text = text.as_py()
                lines = text.split(b"\n") if text else []
                gone = np.zeros(len(lines) + 1, np.int64)
                for s in at.as_py() or ():
                    gone[s["at"]] += 1
                    gone[s["at"] + s["size"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                out.append(b"\n".join([x for x, g in zip(lines, gone.tolist(), strict=True) if not g]))
                n_lines.append(len(lines))
                n_cut.append(int(gone.sum()))
                n_runs.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(gone) else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.decode("utf-8", "replace") for x in out], pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_cut, pa.int64()), pa.array(n_runs, pa.int64())], ["named", "id", "text", "n_lines", "n_removed", "n_runs"])

    return go


def line_dedup(docs: DataFrame, ws: Workspace, run: int = RUN, words: int | None = RUN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_lines, n_removed, n_runs: each text without the lines of later repeated runs.

    A run is ``run`` consecutive lines or more, or fewer that have ``words`` words together (None: only whole runs). A line goes if it is part of a
    run that also stands earlier: in a row before (by id, null ids first, then by a hash of the text for equal ids) or further up in the same text.
    The first copy stays whole.

    Winnowing selects the least line hash of every window as its fingerprint, so that equal windows have the same one at the same place.
    Fingerprints that stand in one place only go, which is most. From the others, matches are extended left and right as far
    as the windows reach that chose them: places are joined by the whole extent (a 128-bit digest), each with the
    earliest, which is worked out with map-side combining; so a common line is parted by its neighbours, a common passage is one row per task, and no
    pairs within a group are listed. Longer matches are the unions of such extents.

    Lines end with \\n; an empty text has none. Null texts are empty. Rows equal in id and text are one document's, and cut alike. Extra columns are
    ignored; no rows give no rows. The row's key is made of its content, so every step that reads ``docs`` anew finds the same keys.
    """
    doc, text = F.col(id_col).cast("long"), text_of(text_col)
    rows = docs.select(doc.isNotNull().alias("named"), F.coalesce(doc, F.lit(0)).alias("id"), F.xxhash64(doc, text).alias("row"), text.alias("text"))
    marks = ws.save(rows.mapInArrow(mark_batches(run, words), MARK), "marks")
    shared = marks.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = marks.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))  # so the places of one common line are several tasks' work
    extents = salted.join(shared, ["fp", "salt"], "left_semi").select("named", "id", "row", F.explode("windows").alias("w")).select("named", "id", "row", "w.*")
    extents = ws.save(extents, "extents")
    place = F.struct("named", "id", "row", "at")
    first = extents.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    later = extents.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(first, ["digest", "salt"]).where(place != F.col("first"))
    starts = later.groupBy("named", "id", "row").agg(F.collect_set(F.struct("at", "size")).alias("starts"))
    cut = rows.join(starts, ["named", "id", "row"], "left").select("named", "id", "text", "starts").mapInArrow(cut_batches(), "named boolean, id long, text string, n_lines long, n_removed long, n_runs long")
    return cut.select(F.when(F.col("named"), F.col("id")).alias("doc_id"), "text", "n_lines", "n_removed", "n_runs")
