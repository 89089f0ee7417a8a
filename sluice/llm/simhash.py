"""SimHash fingerprints, and near-duplicates over a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Workspace, run_starts, sorted_runs, text_of
from .components import connected_components

POSITIONS = 8
#: Fingerprints that one posting list may hold before its pairs are found by probing instead.
LONGEST_LIST = 8192
#: For every byte value, its eight bits.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)


def fingerprint_batches(width: int, seed: int):
    """A mapInArrow function: (doc_id, text as bytes) to (doc_id, fp)."""
    import xxhash

    def hashes(text: bytes) -> list[int]:
        words = text.translate(LOWER).split()
        if len(words) < width:
            shingles = [b" ".join(words)] if words else []
        else:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        return [digest(s, seed) for s in shingles]

    digest = xxhash.xxh64_intdigest

    def fold(all_hashes: list[np.ndarray]) -> np.ndarray:
        """Fingerprints by counting, for every document and byte position, each byte value, and adding up the values' bits."""
        n = len(all_hashes)
        sizes = np.array([len(h) for h in all_hashes])
        of = np.repeat(np.arange(n) * 256, sizes)
        octets = np.concatenate([*all_hashes, np.zeros(0, np.uint64)]).astype(">u8").view(np.uint8).reshape(-1, 8)
        out = np.zeros(n, np.uint64)
        for at in range(POSITIONS):
            tally = np.bincount(of + octets[:, at], minlength=n * 256).reshape(n, 256)
            ones = tally.astype(np.float64) @ BITS
            byte = np.packbits(ones * 2 > sizes[:, None], axis=1)[:, 0]
            out |= byte.astype(np.uint64) << np.uint64(8 * (7 - at))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, 256):
                part = texts.slice(lo, 256)
                fps = fold([np.array(hashes(t.as_py()), np.uint64) for t in part])
                yield pa.RecordBatch.from_arrays([ids.slice(lo, 256), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of every whole text, as a signed long.

    A-Z are lower-cased; words are separated by ASCII white space; shingles are ``width`` words, repeats included, or the whole
    sequence if it is shorter. A bit is 1 if it is set in over half of the shingles' XXH64. Null and empty texts have 0.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(fingerprint_batches(width, seed), "doc_id long, fp long")


def cover(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which every pair within ``distance`` bits shares one whole set.

    Such a pair agrees in at least 8 - distance bytes. Up to 3 bits that is 5, of which 3 lie in one half: the 4 triples of each half.
    Otherwise: all sets of that many positions.
    """
    if distance <= 3:
        return [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
    return list(combinations(range(POSITIONS), max(1, POSITIONS - distance)))


def near(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Where x and y differ in at most ``distance`` bits: first the count filter over shared bytes, then the bits."""
    apart = x ^ y
    octets = apart[..., None].view(np.uint8) if apart.ndim else apart
    shared = (octets.reshape(*apart.shape, 8) == 0).sum(-1, dtype=np.int8)
    hits = shared >= POSITIONS - distance
    hits[hits] = np.bitwise_count(apart[hits]) <= distance
    return hits


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the links within one posting list join; fewer than fingerprints, whatever the number of links."""
    left, a, b = fps, [], []
    todo: list[np.uint64] = []
    while len(left) or todo:
        if not todo:
            todo.append(left[0])
            left = left[1:]
            continue
        x = todo.pop()
        if len(left):
            hits = near(np.full(len(left), x, np.uint64), left, distance)
            new = left[hits]
            left = left[~hits]
            a += [x] * len(new)
            b += list(new)
            todo += list(new)
    return np.array(a, np.uint64), np.array(b, np.uint64)


def list_links(distance: int):
    """A mapInArrow function over posting lists (key, fp), sorted by key: links of pairs, and forests of longer lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_runs(batches, "key"):
            keys, fps = part.column("key").to_numpy(), part.column("fp").to_numpy().view(np.uint64)
            starts = run_starts(keys)
            sizes = np.diff(starts)
            at = starts[:-1][sizes == 2]
            x, y = fps[at], fps[at + 1]
            hits = near(x, y, distance) if len(x) else np.zeros(0, bool)
            a, b = [x[hits]], [y[hits]]
            for k in np.flatnonzero(sizes > 2):
                p, q = forest(np.unique(fps[starts[k] : starts[k + 1]]), distance)
                a.append(p)
                b.append(q)
            a, b = np.concatenate(a).astype(np.uint64), np.concatenate(b).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def probes(distance: int):
    """A mapInArrow function: each fp with all values within floor(distance/2) bits (near) and within the rest (far).

    Two fingerprints are within ``distance`` exactly if a near value of one is a far value of the other. A value has a bounded
    number of such fingerprints (2,081 for 3 bits), so no group can be large however crowded the fingerprints are.
    """
    few = distance // 2

    def masks(bits: int) -> np.ndarray:
        return np.array([sum(1 << i for i in c) for k in range(bits + 1) for c in combinations(range(64), k)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        close, wide = masks(few), masks(distance - few)
        for batch in batches:
            for fp in batch.column(0).to_numpy().view(np.uint64):
                value = np.concatenate((fp ^ close, fp ^ wide))
                flag = np.arange(len(value)) < len(close)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(np.full(len(value), fp, np.uint64).view(np.int64)), pa.array(flag)], ["v", "fp", "close"])

    return run


def links(fps: DataFrame, ws: Workspace, distance: int = 3, longest: int = LONGEST_LIST) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect exactly what links of at most ``distance`` bits connect.

    The inverted index maps values at a set of byte positions to fingerprints. Lists over ``longest`` are not cut:
    their fingerprints go through ``probes``, whose work is in proportion to their number.
    """
    octet = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long")) for p in range(POSITIONS)]
    sets = cover(distance)
    key = F.explode(F.array(*[sum((F.shiftleft(octet[p], 8 * i) for i, p in enumerate(s)), F.lit(k << 8 * max(map(len, sets))).cast("long")) for k, s in enumerate(sets)]))
    postings = fps.select(key.alias("key"), "fp")
    counts = postings.groupBy("key").agg(F.count("*").alias("n"))
    over = ws.save(counts.where(F.col("n") > longest).select("key"), "over")
    found = None
    if over.head(1):
        crowded = ws.save(postings.join(over, "key", "left_semi").select("fp").distinct(), "crowded")
        near_far = crowded.mapInArrow(probes(distance), "v long, fp long, close boolean")
        hub = near_far.groupBy("v").agg(F.min(F.expr("if(close, fp, null)")).alias("hub"), F.count("*").alias("n")).where("hub is not null and n > 1").select("v", "hub")
        found = near_far.join(hub, "v").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()
        postings = postings.join(over, "key", "left_anti")
    pairs = postings.repartition("key").sortWithinPartitions("key").mapInArrow(list_links(distance), "a long, b long")
    return pairs if found is None else pairs.unionByName(found)


def simhash_dedup(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Rows with equal fingerprints are one node of the graph, so copies are never expanded. component_id is the smallest doc_id of
    all rows reachable by links, the row itself included. Null and empty texts have fingerprint zero and link like any
    other; a null id keeps its row but is never a component's name unless all its ids are null; no rows give no rows.
    """
    marked = ws.save(fingerprints(docs, id_col, text_col, width, seed), "fps")
    nodes = ws.save(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    parts = connected_components(ws.save(links(nodes.select("fp"), ws, distance), "links"), ws)
    named = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
