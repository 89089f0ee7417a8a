"""SentencePiece vocabularies as an Aho-Corasick automaton: encoding, decoding, and lattice likelihoods in one pass.

The automaton is a set of arrays, and many strings are walked at once, position by position. That is the single pass
of the algorithm, with numpy doing each step for a whole batch. A string too long to share a batch is walked alone: there a compiled
automaton over the same pieces follows the output links, and each match relaxes a score.
"""

from __future__ import annotations

import math
import re
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buffer_of, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Strings that a worker remembers; more and it starts anew.
REMEMBERED = 300_000
#: Longer strings are walked alone, so that a batch is never padded to the length of one giant.
LONGEST_TOGETHER = 128
SPACE = "▁"
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """Surfaces in UTF-8 (the space mark as a space), scores, and the ids of the byte pieces; what is sent to executors."""

    pieces: tuple[bytes, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    normal: tuple[bool, ...]


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    names = [sp.id_to_piece(i) for i in ids]
    special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in ids]
    byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    pieces = [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
    return Vocabulary(tuple(pieces), tuple(sp.get_score(i) for i in ids), tuple(byte_ids), tuple(not s for s in special))


def _logaddexp(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


class Automaton:
    """Aho-Corasick over a vocabulary's pieces, complete transitions as a table, with output links.

    ``step[node, byte]`` is the next node. ``piece[node]`` is the piece that ends there (-1: none); ``link[node]`` is the nearest node
    on the chain of failures that has one (0: none), ``first[node]`` the node itself if it has one, else that.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.score, self.scores, self.compiled = np.array(vocabulary.scores), list(vocabulary.scores), None
        self.byte_id = np.array(vocabulary.byte_ids, np.int64)
        ids = [i for i, n in enumerate(vocabulary.normal) if n and vocabulary.pieces[i]]
        sizes = np.array([len(vocabulary.pieces[i]) for i in ids])
        self.length = np.zeros(len(vocabulary.pieces), np.int64)
        self.length[ids] = sizes
        self.lengths = self.length.tolist()
        self.unknown = (self.score[ids].min() if ids else 0.0) - UNKNOWN_PENALTY
        data, starts = np.frombuffer(b"".join(vocabulary.pieces[i] for i in ids), np.uint8), np.concatenate(([0], np.cumsum(sizes)))
        self.step = np.full((int(sizes.sum()) + 1, 256), -1, np.int32)
        at, piece, levels, nodes = np.zeros(len(ids), np.int64), {}, [], 1
        for depth in range(int(sizes.max(initial=0))):
            on = np.flatnonzero(sizes > depth)
            keys, own = np.unique(at[on] * 256 + data[starts[on] + depth], return_inverse=True)
            fresh = np.arange(nodes, nodes + len(keys))
            self.step[keys // 256, keys % 256] = fresh
            levels.append((keys // 256, keys % 256, fresh))
            at[on] = fresh[own]
            nodes += len(keys)
        self.step = self.step[:nodes].copy()
        self.piece, self.link, fail = np.full(nodes, -1, np.int32), np.zeros(nodes, np.int32), np.zeros(nodes, np.int64)
        self.piece[at] = ids
        del piece
        root = self.step[0]
        root[root < 0] = 0
        for depth, (parents, octets, fresh) in enumerate(levels):
            fail[fresh] = self.step[fail[parents], octets] if depth else 0
            rows = self.step[fresh]
            self.step[fresh] = np.where(rows < 0, self.step[fail[fresh]], rows)
            self.link[fresh] = np.where(self.piece[fail[fresh]] >= 0, fail[fresh], self.link[fail[fresh]])
        self.first = np.where(self.piece >= 0, np.arange(nodes), self.link)

    @property
    def machine(self):
        """The compiled automaton over the same pieces, a byte as the character of its number; made when it is first needed."""
        if self.compiled is None:
            import ahocorasick

            self.compiled = ahocorasick.Automaton()
            for i, (piece, normal) in enumerate(zip(self.vocabulary.pieces, self.vocabulary.normal, strict=True)):
                if normal and piece and piece.decode("latin-1") not in self.compiled:
                    self.compiled.add_word(piece.decode("latin-1"), (len(piece), i))
            self.compiled.make_automaton()
        return self.compiled

    def encode_alone(self, string: bytes) -> np.ndarray:
        """``encode`` of one string of any length, by matches instead of positions x strings."""
        n, score, unknown = len(string), self.scores, self.unknown
        best, last = [-math.inf] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        done, begun, single = 0, 0, False  # positions settled; where the present character begins; whether a piece is that character

        def settle(upto: int) -> None:
            """Passes the ends of characters from ``done`` + 1 to ``upto``; one without a piece of its own may be unknown."""
            nonlocal done, begun, single
            while done < upto:
                done += 1
                if done == n or string[done] & 0xC0 != 0x80:
                    if not single and (other := best[begun] + unknown) > best[done]:
                        best[done], last[done] = other, begun - done
                    begun = done
                single = False

        for end, (size, i) in self.machine.iter(string.decode("latin-1")):
            end += 1
            if end > done + 1:
                settle(end - 1)
            start = end - size
            if start == begun:
                single = True
            now = best[start] + score[i]
            if now > best[end]:
                best[end], last[end] = now, i
        settle(n)
        out, at = [], n
        while at > 0:
            i = last[at]
            if i < 0:
                size = max(-i, 1)
                out += [int(self.byte_id[string[j]]) for j in range(at - 1, at - 1 - size, -1)]
                at -= size
            else:
                out.append(i)
                at -= self.lengths[i]
        return np.array(out[::-1], np.int32)

    def total_alone(self, string: bytes, log_p: np.ndarray) -> float:
        """``likelihood`` of one string of any length."""
        p, octet, total, end = log_p.tolist(), log_p[self.byte_id].tolist(), [0.0] * (len(string) + 1), 0
        add = _logaddexp
        for at, (size, i) in self.machine.iter(string.decode("latin-1")):
            while end <= at:
                total[end + 1] = total[end] + octet[string[end]]
                end += 1
            total[at + 1] = add(total[at + 1], total[at + 1 - size] + p[i])
        while end < len(string):
            total[end + 1] = total[end] + octet[string[end]]
            end += 1
        return total[-1]

    def expected_alone(self, string: bytes, log_p: np.ndarray) -> np.ndarray:
        """``expected`` of one string of any length: forward over the matches, then backward over them."""
        p, ids = log_p.tolist(), self.byte_id[np.frombuffer(string, np.uint8)].tolist()
        n, add, tally = len(string), _logaddexp, np.zeros(len(log_p))
        arcs: list[list[tuple[int, int]]] = [[(1, i)] for i in ids]
        for at, arc in self.machine.iter(string.decode("latin-1")):
            arcs[at].append(arc)
        total, after = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        total[0] = after[n] = 0.0
        for at, own in enumerate(arcs, 1):
            for size, i in own:
                total[at] = add(total[at], total[at - size] + p[i])
        for at in range(n, 0, -1):
            for size, i in arcs[at - 1]:
                rest = after[at] + p[i]
                after[at - size] = add(after[at - size], rest)
                tally[i] += math.exp(total[at - size] + rest - total[n])
        return tally

    def batches(self, strings: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(which, sizes, bytes as a matrix of positions x strings), longest first, so that those still going are a prefix."""
        sizes = np.array([len(s) for s in strings])
        order = np.argsort(-sizes, kind="stable")
        lo = 0
        while lo < len(order):
            longest = int(sizes[order[lo]])
            n = max(1, min(len(order) - lo, 400_000 // (longest + 1)))
            which = order[lo : lo + n]
            own = sizes[which]
            flat = np.frombuffer(b"".join([strings[i] for i in which]), np.uint8)
            grid = np.zeros((longest, n), np.uint8)
            column = np.repeat(np.arange(n), own)
            grid[np.arange(len(flat)) - np.repeat(np.cumsum(own) - own, own), column] = flat
            yield which, own, grid
            lo += n

    def walk(self, own: np.ndarray, grid: np.ndarray):
        """For each position: how many strings reach it, and (strings, pieces) by following output links."""
        longest, n = grid.shape
        state, step = np.zeros(n, np.int64), self.step.reshape(-1)
        going = np.searchsorted(-own, -np.arange(longest), side="left")

        def outputs(m: int):
            node = self.first[state[:m]]
            who = np.flatnonzero(node)
            node = node[who]
            while len(who):
                yield who, self.piece[node]
                node = self.link[node]
                on = np.flatnonzero(node)
                who, node = who[on], node[on]

        for pos in range(longest):
            m = int(going[pos])
            state[:m] = step[state[:m] * 256 + grid[pos, :m]]
            yield pos, m, outputs(m)

    def encode(self, strings: list[bytes]) -> list[np.ndarray]:
        """The best segmentation's ids, by Viterbi: at each position the outputs of the automaton relax the best score.

        Of equal scores the longer last piece stays. A character without a piece of its own may be unknown, at the lowest score less
        UNKNOWN_PENALTY; it is spelled in byte pieces.
        """
        out: list[np.ndarray] = [self.encode_alone(s) if len(s) > LONGEST_TOGETHER else np.zeros(0, np.int32) for s in strings]
        together = [k for k, s in enumerate(strings) if len(s) <= LONGEST_TOGETHER]
        for which, ids in zip(together, self.encode_together([strings[k] for k in together]), strict=True):
            out[which] = ids
        return out

    def encode_together(self, strings: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(strings)
        for which, own, grid in self.batches(strings):
            longest, n = grid.shape
            best = np.full((longest + 1, n), -np.inf)
            best[0] = 0
            last = np.full((longest + 1, n), -1, np.int32)  # a piece, or -size of an unknown character
            begins = (grid & 0xC0) != 0x80
            begun = np.where(begins, np.arange(longest)[:, None], -1)
            np.maximum.accumulate(begun, axis=0, out=begun)
            for pos, m, outputs in self.walk(own, grid):
                end = np.ones(m, bool)
                if pos + 1 < longest:
                    end = begins[pos + 1, :m] | (own[:m] == pos + 1)
                size = pos + 1 - begun[pos, :m]
                single = np.zeros(m, bool)
                top, mark = best[pos + 1], last[pos + 1]
                for who, ids in outputs:
                    length = self.length[ids]
                    score = best[pos + 1 - length, who] + self.score[ids]
                    better = score > top[who]
                    top[who[better]] = score[better]
                    mark[who[better]] = ids[better]
                    single[who[length == size[who]]] = True
                odd = np.flatnonzero(end & ~single)
                if len(odd):
                    score = best[pos + 1 - size[odd], odd] + self.unknown
                    better = score > top[odd]
                    top[odd[better]] = score[better]
                    mark[odd[better]] = -size[odd[better]]
            self.trace(which, own, grid, last, out)
        return out

    def trace(self, which, own, grid, last, out) -> None:
        n = len(which)
        at, who, found = own.copy(), np.flatnonzero(own > 0), []
        while len(who):
            ids = last[at[who], who]
            odd = ids < 0
            if odd.any():
                for k in np.flatnonzero(odd):
                    size, w = -int(ids[k]), who[k]
                    size = max(size, 1)
                    for j in range(int(at[w]) - 1, int(at[w]) - 1 - size, -1):
                        found.append((np.array([w]), self.byte_id[grid[j, w]][None].astype(np.int32)))
                    at[w] -= size
            sure = ~odd
            found.append((who[sure], ids[sure]))
            at[who[sure]] -= self.length[ids[sure]]
            who = who[at[who] > 0]
        if not found:
            return
        owner = np.concatenate([w for w, _ in found])
        ids = np.concatenate([i for _, i in found])
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(n + 1))
        ids = ids[order].astype(np.int32)
        for k in range(n):
            out[which[k]] = ids[cuts[k] : cuts[k + 1]][::-1]

    def likelihood(self, strings: list[bytes], log_p: np.ndarray) -> np.ndarray:
        """Natural logarithm of the summed probability of all segmentations, by the forward recursion, in log space where a double could not hold the sums.

        Every byte may also be its byte piece, so no string is impossible.
        """
        near = self.representable(log_p)
        out = np.array([self.total_alone(s, log_p) if len(s) > LONGEST_TOGETHER else 0.0 for s in strings])
        for short, which, own, grid in self.by_range(strings, near):
            total, _ = (self.forward if short else self.forward_log)(own, grid, log_p)
            end = total[own, np.arange(len(own))]
            out[which] = np.log(end) if short else end
        return out

    def representable(self, log_p: np.ndarray) -> int:
        """Up to how many bytes a string's sums lie between exp(-600) and exp(600), so that they need no logarithms: at least its bytes' own pieces, at most every piece at every place."""
        with np.errstate(over="ignore"):
            widest = max(-log_p[self.byte_id].min(), float(np.log1p(np.exp(log_p).sum())))
        return int(600 / widest) if widest > 0 else LONGEST_TOGETHER

    def by_range(self, strings: list[bytes], near: int):
        """(whether of at most ``near`` bytes, which, sizes, matrix) for all strings that share batches."""
        sizes = np.array([len(s) for s in strings], np.int64)
        for short in (True, False):
            of = np.flatnonzero((sizes <= LONGEST_TOGETHER) & ((sizes <= near) == short))
            for which, own, grid in self.batches(strings if len(of) == len(strings) else [strings[k] for k in of.tolist()]):
                yield short, of[which], own, grid

    def forward(self, own: np.ndarray, grid: np.ndarray, log_p: np.ndarray):
        """Summed probabilities of all segmentations up to each position, and the arcs (string, place it starts, piece) into each."""
        longest, n = grid.shape
        p = np.exp(log_p)
        octet, total = p[self.byte_id], np.zeros((longest + 1, n))
        total[0] = 1
        flat, arcs = total.reshape(-1), []
        for pos, m, outputs in self.walk(own, grid):
            now = total[pos + 1]
            now[:m] = total[pos, :m] * octet[grid[pos, :m]]
            arcs.append([])
            for who, ids in outputs:
                start = (pos + 1 - self.length[ids]) * n + who
                now[who] += flat[start] * p[ids]
                arcs[-1].append((who, start, ids))
        return total, arcs

    def forward_log(self, own: np.ndarray, grid: np.ndarray, log_p: np.ndarray):
        """``forward`` in log space."""
        longest, n = grid.shape
        octet, total = log_p[self.byte_id], np.full((longest + 1, n), -np.inf)
        total[0] = 0
        flat, arcs = total.reshape(-1), []
        for pos, m, outputs in self.walk(own, grid):
            now = total[pos + 1]
            now[:m] = total[pos, :m] + octet[grid[pos, :m]]
            arcs.append([])
            for who, ids in outputs:
                start = (pos + 1 - self.length[ids]) * n + who
                now[who] = np.logaddexp(now[who], flat[start] + log_p[ids])
                arcs[-1].append((who, start, ids))
        return total, arcs

    def expected(self, strings: list[bytes], log_p: np.ndarray) -> np.ndarray:
        """How often each piece is used, expected over all segmentations of each string: the forward recursion, then the backward one over its arcs."""
        tally, p, near = np.zeros(len(log_p)), np.exp(log_p), self.representable(log_p)
        for string in strings:
            if len(string) > LONGEST_TOGETHER:
                tally += self.expected_alone(string, log_p)
        for short, _, own, grid in self.by_range(strings, near):
            longest, n = grid.shape
            total, arcs = (self.forward if short else self.forward_log)(own, grid, log_p)
            ends = own * n + np.arange(n)
            after = np.zeros_like(total) if short else np.full_like(total, -np.inf)
            before, whole, behind = total.reshape(-1), total.reshape(-1)[ends], after.reshape(-1)
            # What is passed back is a share of the whole string's sum.
            behind[ends] = 1 / whole if short else -whole
            pieces, shares = [], []
            for pos in range(longest - 1, -1, -1):
                m = int(np.searchsorted(-own, -pos, side="left"))
                octets = (np.arange(m), pos * n + np.arange(m), self.byte_id[grid[pos, :m]])
                for who, start, ids in [octets, *arcs[pos]]:
                    if short:
                        rest = after[pos + 1, who] * p[ids]
                        behind[start] += rest
                        shares.append(before[start] * rest)
                    else:
                        rest = after[pos + 1, who] + log_p[ids]
                        behind[start] = np.logaddexp(behind[start], rest)
                        shares.append(np.exp(before[start] + rest))
                    pieces.append(ids)
            if pieces:
                tally += np.bincount(np.concatenate(pieces), np.concatenate(shares), len(tally))
        return tally


def automaton(vocabulary: Vocabulary) -> Automaton:
    """The vocabulary's automaton, built once in each worker process."""
    store = sys.modules.setdefault("_sluice_automata", types.ModuleType("_sluice_automata"))
    key = hash(vocabulary.pieces)
    if key not in store.__dict__.setdefault("by_key", {}):
        store.by_key.clear()
        store.by_key[key] = Automaton(vocabulary)
    return store.by_key[key]


#: No piece goes on after white space begins, and none holds a line's end: between such parts a best segmentation is the parts' own.
PART = re.compile(rb" *[^ \n]+|\n| +")


class Encoder:
    """Encodes whole texts part by part, and remembers the parts."""

    def __init__(self, vocabulary: Vocabulary):
        if any(b" " in p.lstrip(b" ") or b"\n" in p for p, n in zip(vocabulary.pieces, vocabulary.normal, strict=True) if n):
            raise ValueError("pieces with inner white space: parts aren't independent")
        self.automaton, self.known = automaton(vocabulary), {}
        self.surface = list(vocabulary.pieces)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids as little-endian 32-bit integers. A text gets one space in front; an empty text has no ids."""
        parts = [PART.findall(b" " + t.replace(b"\xe2\x96\x81", b" ")) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({p for ps in parts for p in ps if p not in known})
        for p, ids in zip(new, self.automaton.encode(new), strict=True):
            known[p] = ids.tobytes()
        return [b"".join([known[p] for p in ps]) for ps in parts]

    def decode(self, ids: bytes) -> bytes:
        """The text of ids: surfaces in a row, less the space in front."""
        return b"".join(map(self.surface.__getitem__, np.frombuffer(ids, np.int32).tolist()))[1:]


def encode_batches(vocabulary: Vocabulary, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        coder = Encoder(vocabulary)
        for batch in batches:
            lo = 0
            _, offsets = buffer_of(batch.column(1))
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20), side="right")) - 1)
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                coded = coder.encode(texts)
                same = [coder.decode(c) == t for c, t in zip(coded, texts, strict=True)]
                cuts = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(cuts).astype(np.int64)), pa.array([hashlib.sha256(c).hexdigest() for c in coded]), pa.array(same)]
                names = ["doc_id", "n_ids", "ids_sha256", "round_trip"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(b"".join(coded), np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
                lo = hi

    return run


def encode(docs: DataFrame, path: str = MODEL, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """doc_id, n_ids, ids_sha256 (of the ids as little-endian 32-bit integers), round_trip, and the ids.

    Encodes each whole text with the vocabulary's own scores and decodes it again; round_trip tells whether that gave the text, byte for byte.
    The mark U+2581 in a text counts as a space, as the vocabulary can't tell them apart: such a text comes back with spaces. Null texts are empty, and
    empty texts have no ids. Extra columns are ignored, repeated rows are encoded each, and no rows give no rows.
    """
    schema = "doc_id long, n_ids long, ids_sha256 string, round_trip boolean" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(encode_batches(load(path), keep_ids), schema)


def decode(coded: DataFrame, path: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text from ids: the pieces' surfaces in a row, less the space in front.

    Null and empty ids give an empty text; null ids among others are left out. Bytes that are no UTF-8 come back as U+FFFD. An id that the vocabulary
    lacks ends the job. Extra columns are ignored, and repeated rows are decoded each.
    """
    vocabulary = load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surface = list(vocabulary.pieces)
        for batch in batches:
            texts = [b"".join([surface[i] for i in ids or () if i is not None])[1:].decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")
