"""Long repeats across documents, by a run-length index of the passages that can repeat.

Winnowing picks an anchor in every window of ``span`` bytes: the least hash of its ``gram``-byte strings. Equal windows have equal
anchors, so only windows whose anchor stands in two documents can repeat. Their passages go to the shard that owns the anchor. There, copies of a
passage are one entry, and passages that share an anchor but differ are indexed: a run-length compressed Burrows-Wheeler
transform with samples at the runs' ends, over which every passage's matching statistics are streamed. An anchor of very many rows would make a
shard that no task can hold; windows with such an anchor are grouped by a 128-bit digest instead, each with its least document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, buffer_of, run_starts, text_of

SPAN, GRAM = 50, 24
#: Bytes that are hashed at once, so that all steps stay in cache; longer texts go piece by piece, overlapping.
PIECE = 1 << 17
#: Anchors, or passages' bytes, that a task gathers before it passes them on.
UNIT_ANCHORS, UNIT_BYTES = 2_000_000, 24 << 20
#: Windows of one passage at most; a run of equal anchors (periodic text) is cut into so many.
WINDOWS = 64
#: Bytes of text per bucket of anchors, and per task's shards of passages; shards that a task settles one after another.
BUCKET_BYTES, SHARDS = 64 << 20, 4
#: Rows with an anchor from which on its windows are grouped one by one: more would be too many unlike passages for one shard.
CROWDED = 100_000
#: Marks that a task gathers before it passes them on.
UNIT_MARKS = 200_000
#: Rows whose anchors are looked up together.
PART_ROWS = 500
NO_ID = -(1 << 63)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each ``gram`` bytes, by doubling: a hash of 2n bytes from two of n."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    size = 1
    while size < gram:
        step = min(size, gram - size)
        left = h[:-step] * np.uint64(0x9E3779B97F4A7C15)
        left += h[step:]
        left ^= left >> np.uint64(32)
        left *= np.uint64(0x94D049BB133111EB)
        h, size = left, size + step
    h ^= h >> np.uint64(29)
    return h


def sliding_min(h: np.ndarray, window: int) -> np.ndarray:
    size = 1
    while size < window:
        step = min(size, window - size)
        h, size = np.minimum(h[:-step], h[step:]), size + step
    return h


def passages(data: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, text number, first window's place in ``data``, windows) of all runs of windows with one anchor; each window is in one run."""
    pieces: list[tuple[int, int, int]] = []
    for k in range(len(offsets) - 1):
        lo, end = int(offsets[k]), int(offsets[k + 1])
        while end - lo >= span:
            hi = min(end, lo + PIECE)
            if end - hi < span:
                hi = end
            pieces.append((k, lo, hi))
            lo = hi - span + 1 if hi < end else end
    at = 0
    while at < len(pieces):
        upto, size = at, 0
        while upto < len(pieces) and (upto == at or size + pieces[upto][2] - pieces[upto][1] <= PIECE):
            size += pieces[upto][2] - pieces[upto][1]
            upto += 1
        some = pieces[at:upto]
        sizes = np.array([hi - lo for _, lo, hi in some])
        joined = np.concatenate([data[lo:hi] for _, lo, hi in some])
        least = sliding_min(gram_hashes(joined, gram), span - gram + 1)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        valid = np.zeros(len(least), bool)
        begin = np.zeros(len(least), bool)
        for s, e in zip(starts.tolist(), (ends - span + 1).tolist(), strict=True):
            valid[s:e] = True
            begin[s] = True
        begin[1:] |= least[1:] != least[:-1]
        begin &= valid
        first = np.flatnonzero(begin)
        own = np.searchsorted(ends, first, side="right")
        stop = np.minimum(np.append(first[1:], len(least)), (ends - span + 1)[own])
        many = -(-(stop - first) // WINDOWS)
        if (many > 1).any():
            again = np.repeat(np.arange(len(first)), many)
            nth = np.arange(len(again)) - np.repeat(np.cumsum(many) - many, many)
            begun = first[again] + nth * WINDOWS
            stop, first, own = np.minimum(stop[again], begun + WINDOWS), begun, own[again]
        number, base = np.array([p[0] for p in some]), np.array([p[1] for p in some]) - starts
        yield least[first], number[own], first + base[own], stop - first
        at = upto


#: Bits of an anchor that tell whether it is shared; that two unlike ones agree in them only makes more passages to look at.
ANCHOR_BITS = 48
#: Bits beside them, for an anchor's row among those of a unit.
ROW_BITS = 64 - ANCHOR_BITS


def squeeze(column: np.ndarray) -> bytes:
    """A column's bytes by significance, then compressed: what is alike in neighbours takes next to no room."""
    planes = np.ascontiguousarray(column.view(np.uint8).reshape(len(column), -1).T)
    return len(column).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unsqueeze(data: bytes, kind) -> np.ndarray:
    n, kind = int.from_bytes(data[:4], "little"), np.dtype(kind)
    planes = np.frombuffer(pa.decompress(data[4:], n * kind.itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).view(kind.base).reshape(n, *kind.shape)


def anchor_batches(span: int, gram: int, buckets: int):
    """(row, text) to packed rows for the buckets of anchors.

    kind 0: for each anchor of a unit of texts, one of its rows, and whether it is the only one. kind 1: anchors that two rows of
    the unit share, with every such row: known to be shared, and only passed through. So an anchor of many documents is one entry a unit.
    A unit is held as one number an anchor.
    """
    bits, low = np.uint64(ROW_BITS), np.uint64((1 << ROW_BITS) - 1)
    lowest = np.array([-(-(k << ANCHOR_BITS) // buckets) << ROW_BITS for k in range(buckets)], np.uint64)  # a bucket is a range of anchors

    def flush(keys: np.ndarray, owners: list[np.ndarray], turn: int) -> pa.RecordBatch:
        """``keys``: anchor << ROW_BITS | place of its row among ``owners``, which may repeat; sorted in place, and then taken bucket by bucket."""
        names, place = np.unique(np.concatenate(owners), return_inverse=True)
        place = place.astype(np.uint64)
        for lo in range(0, len(keys), PIECE):
            some = keys[lo : lo + PIECE]
            some[:] = some & ~low | place[some & low]
        keys.sort()
        turn += int(names[int(keys[0] & low)].view(np.uint64) % np.uint64(buckets))  # tasks start at different buckets
        edges = np.searchsorted(keys, lowest).tolist() + [len(keys)]
        rows, again = [], []
        for k in range(buckets):
            own = keys[edges[k] : edges[k + 1]]
            if not len(own):
                continue
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            h = own >> bits
            cuts = run_starts(h)
            n, first = np.diff(cuts), cuts[:-1]
            used, index = np.unique(own[first] & low, return_inverse=True)
            rows.append((k, 0, squeeze(h[first]), squeeze(names[used]), squeeze(index.astype(np.uint32)), squeeze((n == 1).view(np.uint8))))
            again.append(own[np.repeat(n > 1, n)])
        shared = np.concatenate(again)
        for k, lo in enumerate(range(0, len(shared), 50_000)):
            some = shared[lo : lo + 50_000]
            rows.append(((turn + k) % buckets, 1, squeeze(some >> bits), squeeze(names[some & low]), b"", b""))
        return pack(rows)

    def pack(rows) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[2:])], ["bucket", "kind", "h", "d", "i", "single"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held, n_owners, turn = np.empty(UNIT_ANCHORS, np.uint64), [], 0, 0, 0
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for h, number, _, _ in passages(*buffer_of(batch.column(1)), span, gram):
                cuts = run_starts(number)[:-1]  # a text has one run here at most
                if held and (held + len(h) > len(keys) or n_owners + len(cuts) > 1 << ROW_BITS):
                    yield flush(keys[:held], owners, turn)
                    owners, held, n_owners, turn = [], 0, 0, turn + 1
                if len(h) > len(keys):
                    keys = np.empty(len(h), np.uint64)
                place = np.repeat(np.arange(n_owners, n_owners + len(cuts), dtype=np.uint64), np.diff(np.append(cuts, len(number))))
                keys[held : held + len(h)] = (h << bits) | place  # the anchor's upper bits go
                owners.append(docs[number[cuts]])
                held += len(h)
                n_owners += len(cuts)
        if held:
            yield flush(keys[:held], owners, turn)

    return run


def shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows of buckets, sorted by bucket, to (row, h) for anchors that stand in two rows."""

    def settle(hs, ds, singles) -> pa.RecordBatch:
        h, d, single = np.concatenate(hs), np.concatenate(ds), np.concatenate(singles)
        order = np.argsort(h, kind="stable")
        h, d, single = h[order], d[order], single[order]
        again = np.diff(run_starts(h))
        asks = np.repeat(again > 1, again) & single
        return out(d[asks], h[asks])

    def out(d, h) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(h.view(np.int64))], ["row", "h"])

    now, hs, ds, singles = None, [], [], []
    for batch in batches:
        for k, kind, h, d, i, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            h, d = unsqueeze(h, np.uint64), unsqueeze(d, np.int64)
            if kind:
                yield out(d, h)
                continue
            if k != now and hs:
                yield settle(hs, ds, singles)
                hs, ds, singles = [], [], []
            now = k
            hs.append(h)
            ds.append(d[unsqueeze(i, np.uint32)])
            singles.append(unsqueeze(s, np.uint8).astype(bool))
    if hs:
        yield settle(hs, ds, singles)


class Copies:
    """Passages by their bytes; of equal ones the smallest document's stay, and the others' windows are all repeats.

    Of each passage: its anchor, its document, and where it stands as (row, start)."""

    def __init__(self):
        self.by_bytes: dict[bytes, tuple[int, int, list[tuple[int, int]]]] = {}
        self.repeats: list[tuple[int, int, int, int]] = []
        self.size = 0

    def add(self, passage: bytes, h: int, doc: int, at: tuple[int, int], windows: int) -> None:
        found = self.by_bytes.get(passage)
        self.size += 100
        if found is None:
            self.by_bytes[passage] = (h, doc, [at])
            self.size += len(passage) + 100
        elif found[1] == doc:
            found[2].append(at)
        elif found[1] < doc:
            self.repeats.append((doc, *at, windows))
        else:
            self.repeats += [(found[1], *own, windows) for own in found[2]]
            self.by_bytes[passage] = (h, doc, [at])


def marks(repeats: list[tuple[int, int, int, int]]) -> list[pa.Array]:
    """doc, row, and first window << 16 | windows."""
    a = np.array(repeats, np.int64).reshape(-1, 4)
    return [pa.array(a[:, 0]), pa.array(a[:, 1]), pa.array((a[:, 2] << 16) | a[:, 3])]


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what is made of a batch's anchors is small beside it; no copy is made."""
    for batch in batches:
        for lo in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(lo, PART_ROWS)


def asked_passages(data: np.ndarray, offsets: np.ndarray, asked: pa.ListArray, span: int, gram: int):
    """Passages as by ``passages``, and which of them have an anchor that is among those asked for of their text."""
    counts = np.diff(np.asarray(asked.offsets))
    salt = lambda h, k: h ^ (k.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    known = np.unique(salt(asked.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(counts)), counts)))
    for h, number, first, windows in passages(data, offsets, span, gram):
        key = salt(h & np.uint64((1 << ANCHOR_BITS) - 1), number)
        at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
        yield h, number, first, windows, np.flatnonzero(known[at] == key) if len(known) else np.zeros(0, np.int64)


def window_batches(span: int, gram: int):
    """(row, text, doc, crowded anchors) to a row per window with such an anchor: (digest of its bytes, doc, row, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in parts(batches):
            rows, (data, offsets), docs = batch.column(0).to_numpy(), buffer_of(batch.column(1)), batch.column(2).to_numpy()
            for _, number, first, windows, hit in asked_passages(data, offsets, batch.column(3), span, gram):
                own = np.repeat(hit, windows[hit])
                at = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(windows[hit]) - windows[hit], windows[hit])
                digests = [digest(data[lo : lo + span].tobytes()) for lo in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(docs[number[own]]), pa.array(rows[number[own]]), pa.array(at - offsets[number[own]])], ["w", "doc", "row", "at"])

    return run


def passage_batches(span: int, gram: int, shards: int):
    """(row, text, doc, anchors that are shared) to rows for the shards: (shard, blob of passages), and settled marks (doc, row, mark)."""

    def flush(copies: Copies) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for passage, (h, doc, places) in copies.by_bytes.items():
            by.setdefault(((h * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32) % shards, []).append((passage, h, doc, places))
        keys, blobs = list(by), []
        for k in keys:
            flat = np.array([(len(p), h & 0xFFFFFFFF, doc, *at) for p, h, doc, places in by[k] for at in places], np.int64)
            body = b"".join([p for p, _, _, places in by[k] for _ in places])
            blobs.append((squeeze(flat), len(body).to_bytes(4, "little") + pa.compress(body, "zstd", asbytes=True)))
        doc, row, mark = marks(copies.repeats)
        n, m = len(keys), len(doc)
        turn = (row.to_numpy().view(np.uint64) % np.uint64(shards)).astype(np.int32)  # settled marks only pass through; rows are hashes
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(keys, pa.int32()), pa.array(turn, pa.int32())]),
                pa.array([b[0] for b in blobs] + [None] * m, pa.binary()),
                pa.array([b[1] for b in blobs] + [None] * m, pa.binary()),
                pa.concat_arrays([pa.nulls(n, pa.int64()), doc]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), row]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), mark]),
            ],
            ["shard", "heads", "body", "doc", "row", "mark"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies = Copies()
        for batch in parts(batches):
            rows, (data, offsets), docs = batch.column(0).to_numpy(), buffer_of(batch.column(1)), batch.column(2).to_numpy()
            for h, number, first, windows, hit in asked_passages(data, offsets, batch.column(3), span, gram):
                inner = first[hit] - offsets[number[hit]]
                for hh, d, row, lo, s, n in zip(h[hit].tolist(), docs[number[hit]].tolist(), rows[number[hit]].tolist(), first[hit].tolist(), inner.tolist(), windows[hit].tolist(), strict=True):
                    copies.add(data[lo : lo + n + span - 1].tobytes(), hh, d, (row, s), n)
            if copies.size > UNIT_BYTES:
                yield from flush(copies)
                copies = Copies()
        if copies.by_bytes or copies.repeats:
            yield from flush(copies)

    return run


@dataclass
class RunLengthIndex:
    """A run-length compressed Burrows-Wheeler transform of texts, with samples at the ends of its runs.

    Kept per run: its symbol, its start, and the text positions of its first and last row; kept per symbol: its runs and how many of the symbol
    precede each. Rows whose suffixes agree in ``span`` bytes form a class, kept as ranges with the least owner of their texts. All of it is in proportion
    to runs and classes, which copies hardly add to.
    """

    text: np.ndarray
    run_start: np.ndarray
    run_symbol: np.ndarray
    first_sample: np.ndarray
    last_sample: np.ndarray
    run_map: np.ndarray  # the row that a run's first row maps to
    class_start: np.ndarray
    class_owner: np.ndarray
    ends: np.ndarray
    by_symbol: dict[int, np.ndarray]

    @classmethod
    def build(cls, texts: list[bytes], owners: np.ndarray, span: int) -> RunLengthIndex:
        n_texts = len(texts)
        sizes = np.array([len(t) + 1 for t in texts])
        ends = np.cumsum(sizes) - 1
        text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + n_texts
        text[ends] = np.arange(n_texts)  # each text ends in a symbol of its own, smaller than any byte
        order, same = suffixes(text, n_texts + 256, span)
        owner = np.asarray(owners)[np.searchsorted(ends, order)]
        class_start = np.flatnonzero(~same)
        before = text[order - 1]
        symbol = np.where(before < n_texts, -1, before - n_texts)
        run_start = np.concatenate(([0], np.flatnonzero(symbol[1:] != symbol[:-1]) + 1))
        run_symbol = symbol[run_start]
        run_size = np.diff(np.append(run_start, len(order)))
        counts = np.bincount(symbol[symbol >= 0], minlength=256)
        below = n_texts + np.concatenate(([0], np.cumsum(counts)[:-1]))
        run_map, by_symbol = np.full(len(run_start), -1), {}
        for c in np.unique(run_symbol[run_symbol >= 0]).tolist():
            own = by_symbol[c] = np.flatnonzero(run_symbol == c)
            run_map[own] = below[c] + np.cumsum(run_size[own]) - run_size[own]
        return cls(text - n_texts, run_start, run_symbol, order[run_start], order[run_start + run_size - 1], run_map, class_start, np.minimum.reduceat(owner, class_start), ends, by_symbol)

    def matching_statistics(self, patterns: list[bytes], texts: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Streams all patterns from their last byte to their first, a byte of each at a time.

        Yields (bytes from the end, patterns that still go, length of the longest match that starts there, its row). A row maps to the next
        one within its run's symbol; where the symbol differs, the match goes on from the nearer end of the nearest runs with it, at the
        sampled position, and is cut to what agrees there. Patterns that end as the indexed texts ``texts`` do start at those texts' ends.
        """
        sizes = np.array([len(p) for p in patterns])
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(patterns), np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        row = np.zeros(len(patterns), np.int64) if texts is None else texts.copy()  # the end of text k is the least suffix but k
        place, length = self.ends[row], np.zeros(len(patterns), np.int64)
        going = np.searchsorted(-sizes[order], -np.arange(1, int(sizes.max(initial=0)) + 1), side="right")
        for back, m in enumerate(going.tolist(), 1):
            who = order[:m]
            at = starts[who] + sizes[who] - back
            c = flat[at]
            run = np.searchsorted(self.run_start, row[who], side="right") - 1
            fits = self.run_symbol[run] == c
            ok = who[fits]
            row[ok] = self.run_map[run[fits]] + row[ok] - self.run_start[run[fits]]
            place[ok] -= 1
            length[ok] += 1
            odd = np.flatnonzero(~fits)
            for k in np.unique(c[odd]).tolist() if len(odd) else ():
                own = odd[c[odd] == k]
                self.jump(k, who[own], run[own], at[own], row, place, length, flat, starts, sizes)
            yield back, who, length[who], row[who]

    def jump(self, symbol, who, run, at, row, place, length, flat, starts, sizes) -> None:
        runs = self.by_symbol.get(symbol)
        if runs is None:
            row[who], place[who], length[who] = 0, int(self.ends[0]), 0
            return
        nth = np.searchsorted(runs, run)
        best = np.full(len(who), -1)
        for side in (nth - 1, nth):
            real = (side >= 0) & (side < len(runs))
            r = runs[np.clip(side, 0, len(runs) - 1)]
            after = side < nth
            sample = np.where(after, self.last_sample[r], self.first_sample[r])
            agree = np.where(real, self.agreement(sample, at + 1, length[who], flat), -1)
            better = agree > best
            best = np.where(better, agree, best)
            pick = who[better]
            offset = np.where(after, np.append(self.run_start, 1 << 62)[r + 1] - 1 - self.run_start[r], 0)
            row[pick] = (self.run_map[r] + np.minimum(offset, self.run_length(r) - 1))[better]
            place[pick] = sample[better] - 1
        length[who] = best + 1

    def run_length(self, r: np.ndarray) -> np.ndarray:
        return np.append(self.run_start[1:], len(self.text))[r] - self.run_start[r]

    def agreement(self, place, at, most, flat) -> np.ndarray:
        """How many bytes of the indexed text from ``place`` agree with the pattern's from ``at``, ``most`` at most."""
        n, on = np.zeros(len(place), np.int64), np.arange(len(place))
        while len(on):
            on = on[n[on] < most[on]]
            a, b = place[on] + n[on], at[on] + n[on]
            inside = (a < len(self.text)) & (b < len(flat))
            on, a, b = on[inside], a[inside], b[inside]
            on = on[self.text[a] == flat[b]]
            n[on] += 1
        return n

    def owner_of(self, rows: np.ndarray) -> np.ndarray:
        """The least owner of the texts whose suffixes agree with these rows' in ``span`` bytes."""
        return self.class_owner[np.searchsorted(self.class_start, rows, side="right") - 1]


def suffixes(text: np.ndarray, symbols: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, whether each agrees with the one before in ``span`` symbols); by doubling, until no two agree."""
    n = len(text)
    shift = int(symbols - 1).bit_length()
    start = max(1, min(3, 62 // shift))
    padded = np.concatenate((text, np.zeros(start, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(start):
        key = (key << shift) | padded[k : k + n]
    size, at_span = start, None
    while True:
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if size <= span:
            at_span = (size, rank)
        if fresh.all() and size * 2 > span or size >= n:
            break
        key = rank * (n + 1)
        key[: max(0, n - size)] += rank[size:] + 1
        size *= 2
    have, ranks = at_span
    far = np.append(ranks, np.full(span, -1))
    prev, now = order[:-1], order[1:]
    same = np.zeros(n, bool)
    same[1:] = True
    for step in {*range(0, span - have, have), span - have}:  # span symbols are covered by stretches of ``have``
        same[1:] &= far[prev + step] == far[now + step]
    return order, same


def alike(texts: list[bytes], span: int) -> np.ndarray:
    """Which texts have a window whose hash another window has: all that share ``span`` bytes with another, and hardly any else."""
    out = np.zeros(len(texts), bool)
    if not texts:
        return out
    sizes = np.array([len(t) for t in texts])
    data, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes
    h = np.concatenate([gram_hashes(data[lo : lo + PIECE + span - 1], span) for lo in range(0, max(len(data) - span + 1, 1), PIECE)])
    owner = np.repeat(np.arange(len(texts)), sizes - span + 1)
    at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(sizes - span + 1) - (sizes - span + 1), sizes - span + 1)
    order = np.argsort(h[at])
    n = np.diff(run_starts(h[at][order]))
    out[owner[order[np.repeat(n > 1, n)]]] = True
    return out


def shard_batches(span: int):
    """Rows of a shard, sorted by shard, to marks (doc, row, mark) of windows that an earlier document has."""

    def settle(copies: Copies) -> Iterator[pa.RecordBatch]:
        by_anchor: dict[int, int] = {}
        for h, _, _ in copies.by_bytes.values():
            by_anchor[h] = by_anchor.get(h, 0) + 1
        unlike = [(p, doc, places) for p, (h, doc, places) in copies.by_bytes.items() if by_anchor[h] > 1]
        unlike = [unlike[k] for k in np.flatnonzero(alike([p for p, _, _ in unlike], span)).tolist()]
        repeats = copies.repeats
        if unlike:
            owners = np.array([doc for _, doc, _ in unlike])
            index = RunLengthIndex.build([p for p, _, _ in unlike], owners, span)
            windows = np.array([len(p) - span + 1 for p, _, _ in unlike])
            hit_who, hit_at = [], []
            for back, who, length, row in index.matching_statistics([p for p, _, _ in unlike], np.arange(len(unlike))):
                at = windows[who] + span - 1 - back
                long = np.flatnonzero((length >= span) & (at < windows[who]))
                earlier = long[index.owner_of(row[long]) < owners[who[long]]]
                hit_who.append(who[earlier])
                hit_at.append(at[earlier])
            who, at = np.concatenate(hit_who), np.concatenate(hit_at)
            order = np.lexsort((at, who))
            who, at = who[order], at[order]
            cut = np.flatnonzero(np.concatenate(([True], (who[1:] != who[:-1]) | (at[1:] != at[:-1] + 1)))) if len(who) else np.zeros(0, int)
            for k, lo, hi in zip(who[cut].tolist(), cut.tolist(), np.append(cut[1:], len(who)).tolist(), strict=True):
                _, doc, places = unlike[k]
                repeats += [(doc, row, s + int(at[lo]), hi - lo) for row, s in places]
        yield pa.RecordBatch.from_arrays(marks(repeats), ["doc", "row", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, copies = None, Copies()
        for batch in batches:
            settled = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            if settled.any():
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(settled)) for c in (3, 4, 5)], ["doc", "row", "mark"])
            for k in np.flatnonzero(~settled).tolist():
                shard = batch.column(0)[k].as_py()
                if shard != now and (copies.by_bytes or copies.repeats):
                    yield from settle(copies)
                    copies = Copies()
                now = shard
                if len(copies.repeats) > UNIT_MARKS:
                    yield pa.RecordBatch.from_arrays(marks(copies.repeats), ["doc", "row", "mark"])
                    copies.repeats = []
                heads, body, at = unsqueeze(batch.column(1)[k].as_py(), np.dtype((np.int64, 5))), batch.column(2)[k].as_py(), 0
                body = pa.decompress(body[4:], int.from_bytes(body[:4], "little"), "zstd", asbytes=True)
                for size, h, doc, row, s in heads.tolist():
                    copies.add(body[at : at + size], h, doc, (row, s), size - span + 1)
                    at += size
        if copies.by_bytes or copies.repeats:
            yield from settle(copies)

    return run


def cut_batches(span: int, keep_text: bool):
    """(doc, text, marks) to what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, own in zip(*batch.columns, strict=True):
                text = text.as_buffer()
                n, gone, spans, kept = text.size, 0, 0, text
                if own.is_valid and len(own):
                    m = own.values.to_numpy()
                    edge = np.zeros(n + 1, np.int32)
                    np.add.at(edge, m >> 16, 1)
                    np.add.at(edge, (m >> 16) + (m & 0xFFFF) + span - 1, -1)
                    cover = np.cumsum(edge[:-1]) > 0
                    gone = int(cover.sum())
                    spans = int((cover[1:] & ~cover[:-1]).sum() + cover[0])
                    kept = np.frombuffer(text, np.uint8)[~cover].tobytes()
                out.append((doc.as_py(), n, gone, spans, hashlib.sha256(kept).hexdigest(), bytes(kept) if keep_text else None))
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def repeat_dedup(docs: DataFrame, ws: Workspace, span: int = SPAN, gram: int = GRAM, crowded: int = CROWDED, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes) for every row of ``docs``.

    Removed is each byte covered by ``span`` bytes that also start in a document with a smaller id, as judged on the input;
    overlaps count, matches never cross texts. Null texts are empty. A null id is smaller than any other. Rows that repeat an id are one document's
    texts: neither is smaller than the other. Extra columns are ignored; no rows give no rows.
    """
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = text_of(text_col)
    rows = docs.select(F.xxhash64(doc, text).alias("row"), text.alias("text"), doc.alias("doc"))  # rows with equal (doc, row) are equal
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = int(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES, 1))
    def anchors() -> DataFrame:
        packed = rows.select("row", "text").mapInArrow(anchor_batches(span, gram, buckets), "bucket int, kind int, h binary, d binary, i binary, single binary")
        shared = packed.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(shared_batches, "row long, h long")
        return ws.save(shared, "shared")

    def repeats(shared: DataFrame) -> DataFrame:
        asked = shared.groupBy("row").agg(F.collect_set("h").alias("hs"))
        found = rows.join(asked, "row").mapInArrow(passage_batches(span, gram, buckets * SHARDS), "shard int, heads binary, body binary, doc long, row long, mark long")
        found = found.repartitionById(buckets, F.floor(F.col("shard") / SHARDS).cast("int")).sortWithinPartitions("shard").mapInArrow(shard_batches(span), "doc long, row long, mark long")
        return ws.save(found, "marks")

    def crowded_repeats(asked: DataFrame) -> DataFrame:
        windows = ws.save(rows.join(asked, "row").mapInArrow(window_batches(span, gram), "w binary, doc long, row long, at long"), "windows")
        least = windows.groupBy("w").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("most > least").select("w", "least")
        later = windows.join(least, "w").where("doc > least").select("doc", "row", F.shiftleft("at", 16).bitwiseOR(F.lit(1).cast("long")).alias("mark"))
        return ws.save(later, "crowded_marks")

    # Each step's frames are gone when it returns, and with them its shuffles.
    shared = anchors()
    ws.tidy()
    heavy = ws.save(shared.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("h"), "heavy")
    if heavy.head(1):
        light = ws.save(shared.join(heavy, "h", "left_anti"), "light")
        more = crowded_repeats(shared.join(heavy, "h", "left_semi").groupBy("row").agg(F.collect_set("h").alias("hs")))
        found = repeats(light).unionByName(more)
        ws.drop("light", "windows")
    else:
        found = repeats(shared)
    ws.drop("shared", "heavy")
    ws.tidy()
    own = found.groupBy("row", "doc").agg(F.collect_list("mark").alias("marks"))
    left = rows.join(own, ["row", "doc"], "left").select("doc", "text", "marks").mapInArrow(cut_batches(span, keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    left = left.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
    return left if keep_text else left.drop("kept")
