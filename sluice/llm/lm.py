"""Language-model scoring: a lattice of subword pieces whose forward recursion sums over all segmentations."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Workspace, buffer_of, bytes_of, text_of
from .subword import MODEL, Vocabulary, automaton, load

#: Words whose scores every task holds; the others are joined.
HELD_WORDS = 100_000
#: Distinct words that a task counts before it passes the counts on.
FLUSH = 400_000
#: Added to every piece's count.
PRIOR = 0.01
#: Passes that re-estimate the pieces' probabilities over all segmentations.
PASSES = 4
#: Weight, in words, of the corpus against the words that a text has had before.
TEXT_WEIGHT = 300
#: Weight, in words, of a rarer word's own probability against the words seen after the word before.
CONTEXT_WEIGHT = 100
#: Words of no training text that occur more often are dealt to SALTS tasks: the HOT_WORDS most frequent of them, so any other is a small share of all rows.
HOT, HOT_WORDS, SALTS = 100_000, 1_000, 64
#: Bytes of text that a task counts or scores at a time, or one longer text.
TOGETHER = 1 << 20
#: Whether a byte parts words.
GAP = np.isin(np.arange(256), [*b" \t\n\v\f\r"])


def blocks(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices whose texts have ``most`` bytes together, or one longer text."""
    _, offsets = buffer_of(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def tokens(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of texts in a row, A-Z lower-cased, each distinct one once in the dictionary; and how many each text has."""
    data = np.frombuffer(b"".join([b"\n" + t for t in texts]).translate(LOWER) + b"\n", np.uint8)
    gap = GAP[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts = edges[::2]
    offsets = np.concatenate(([0], np.cumsum(edges[1::2] - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return words.dictionary_encode(), np.diff(np.searchsorted(starts, ends), prepend=0)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(train, text) to (word, c, other): counts in training texts and in the other texts."""
    parts: list[pa.RecordBatch] = []
    names = ["word", "c", "other"]

    def merged() -> pa.RecordBatch:
        words = pa.concat_arrays([p.column(0) for p in parts] or [pa.array([], pa.binary())]).dictionary_encode()
        each = words.indices.to_numpy(), len(words.dictionary)
        sums = [np.bincount(each[0], np.concatenate([p.column(k).to_numpy() for p in parts] or [np.zeros(0)]), each[1]).astype(np.int64) for k in (1, 2)]
        return pa.RecordBatch.from_arrays([words.dictionary, *map(pa.array, sums)], names)

    for batch in batches:
        for block in blocks(batch, 1, TOGETHER):
            words, sizes = tokens(block.column(1).to_pylist())
            codes, n = words.indices.to_numpy(), len(words.dictionary)
            c = np.bincount(codes[np.repeat(block.column(0).to_numpy(zero_copy_only=False), sizes)], minlength=n)
            parts.append(pa.RecordBatch.from_arrays([words.dictionary, pa.array(c), pa.array(np.bincount(codes, minlength=n) - c)], names))
            if sum(p.num_rows for p in parts) > 2 * FLUSH:
                parts = [merged()]
                if parts[0].num_rows > FLUSH:
                    yield parts.pop()
    yield merged()


def piece_batches(vocabulary: Vocabulary, log_p: np.ndarray | None = None):
    """Words to piece counts, each distinct word once: of its best segmentation by the vocabulary's scores, or expected over all of them under ``log_p``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        tally = np.zeros(len(vocabulary.pieces))
        for batch in batches:
            words = [b" " + w for w in bytes_of(batch.column(0))]
            for lo in range(0, len(words), 20_000):
                part = words[lo : lo + 20_000]
                if log_p is None:
                    tally += np.bincount(np.concatenate([*a.encode(part), np.zeros(0, np.int32)]), minlength=len(tally))
                else:
                    tally += a.expected(part, log_p)
        used = np.flatnonzero(tally)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(tally[used])], ["piece", "n"])

    return run


def piece_scores(words: DataFrame, vocabulary: Vocabulary, passes: int) -> np.ndarray:
    """Natural log probabilities of the pieces: counts in the best segmentations of ``words``, then ``passes`` of expectation and maximisation.

    At most one row per piece of the vocabulary and task is summed, and one per piece comes to the driver.
    """
    log_p = None
    for _ in range(passes + 1):
        pieces = np.full(len(vocabulary.pieces), PRIOR)
        pieces[[not p for p in vocabulary.pieces]] = 0
        counted = words.select("word").mapInArrow(piece_batches(vocabulary, log_p), "piece int, n double")
        for row in counted.groupBy("piece").agg(F.sum("n").alias("n")).collect():
            pieces[row["piece"]] += row["n"]
        with np.errstate(divide="ignore"):
            log_p = np.round(np.log(pieces / pieces.sum()), 9)  # sums of doubles come in any order
    return log_p


def word_batches(vocabulary: Vocabulary, log_p, totals: tuple[int, int, int], known_share: float):
    """(word, c) to (word, c, base, score): both log10 probabilities of the word as a token."""
    n, ends, v = totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        for batch in batches:
            words, c = bytes_of(batch.column(0)), batch.column(1).to_numpy().astype(float)
            lattice = np.concatenate([a.likelihood([b" " + w for w in words[lo : lo + 20_000]], log_p) for lo in range(0, len(words), 20_000)] or [np.zeros(0)])
            with np.errstate(divide="ignore"):
                whole = np.log(known_share * c / max(n, 1))
            spelled = lattice + math.log(max(1e-12, (1 - known_share) * (1 - ends / max(n, 1))))
            score = np.logaddexp(whole, spelled) / math.log(10)
            base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base), pa.array(score)], ["word", "c", "base", "score"])

    return run


def running(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word of texts in a row: its text, its place there, how often the text has had it before, and how many distinct words it has had."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(sizes) - sizes
    at = np.arange(len(codes)) - begin[doc]
    span, bits = int(codes.max(initial=0)) + 1, len(codes).bit_length()
    if (len(sizes) * span).bit_length() + bits < 64:
        own = np.sort((doc * span + codes) << bits | np.arange(len(codes)))
        order, own = own & ((1 << bits) - 1), own >> bits
        changes = np.append(True, own[1:] != own[:-1])[: len(codes)]
    else:
        order = np.lexsort((codes, doc))
        changes = np.ones(len(codes), bool)
        changes[1:] = (codes[order][1:] != codes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    starts = np.flatnonzero(changes)
    seen = np.empty(len(codes), np.int64)
    seen[order] = np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    before = np.concatenate(([0], np.cumsum(seen == 0)))
    return doc, at, seen, before[:-1] - before[begin[doc]]


def document_batches(held, end: tuple[float, float, bool]):
    """(row, doc_id, train, text) to a row per text with what held words give, and a row per occurrence of another word with what came before it.

    ``prev`` is the held word before (-1: none), ``seen``, ``had`` and ``at`` are as in ``running``; ``salt`` deals the hot words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, bases, scores, hot = held.value
        stop = 10 ** end[1]
        odds = 10.0**scores
        for batch in batches:
            for part in blocks(batch, 3, TOGETHER):
                yield block(part, number, bases, scores, odds, hot, stop)

    def block(batch: pa.RecordBatch, number: pa.Array, bases: np.ndarray, scores: np.ndarray, odds: np.ndarray, hot: pa.Array, stop: float) -> pa.RecordBatch:
        words, count = tokens(batch.column(3).to_pylist())
        which, distinct = words.indices.to_numpy(), words.dictionary
        at_held = pc.index_in(distinct, value_set=number).fill_null(-1).to_numpy().astype(np.int64)
        codes = np.where(at_held < 0, len(number) + np.arange(len(distinct)), at_held)[which]
        doc, at, seen, had = running(codes, count)
        known = codes < len(number)
        d, k, total = doc[known], codes[known], (at + had + TEXT_WEIGHT)[known]
        fresh = (had[known] + TEXT_WEIGHT) / total
        score = np.log10((1 - stop) * seen[known] / total + fresh * odds[k])
        prev = np.full(len(codes), -1, np.int64)
        prev[1:] = np.where((at[1:] > 0) & known[:-1], codes[:-1], -1)
        rest, row = np.flatnonzero(~known), batch.column(0).to_numpy()
        others, train = distinct.take(words.indices.take(pa.array(rest))), batch.column(2)
        salt = np.where(pc.is_in(distinct, value_set=hot).to_numpy(zero_copy_only=False)[which[rest]], rest % SALTS, 0).astype(np.int32) if len(hot) else np.zeros(len(rest), np.int32)

        def column(whole, each, kind: pa.DataType) -> pa.Array:
            parts = [pa.nulls(n, kind) if values is None else values if isinstance(values, pa.Array) else pa.array(values, kind) for values, n in ((whole, len(count)), (each, len(rest)))]
            return pa.concat_arrays(parts)

        tally = np.bincount(d, minlength=len(count))
        return pa.RecordBatch.from_arrays(
            [
                column(row, row[doc[rest]], pa.int64()),
                column(None, others, pa.binary()),
                *(column(None, values, pa.int32()) for values in (prev[rest], seen[rest], had[rest], at[rest], salt)),
                column(1 + tally, np.ones(len(rest), np.int64), pa.int64()),
                column(int(end[2]) + tally, None, pa.int64()),
                column(end[0] + np.bincount(d, bases[k], len(count)), None, pa.float64()),
                column(end[1] + np.bincount(d, score, len(count)), None, pa.float64()),
                pa.concat_arrays([batch.column(1), pa.nulls(len(rest), pa.int64())]),
                pa.concat_arrays([train, train.take(pa.array(doc[rest]))]),
            ],
            ["row", "word", "prev", "seen", "had", "at", "salt", "n", "known", "base", "score", "doc_id", "train"],
        )

    return run


PARTS = "row long, word binary, prev int, seen int, had int, at int, salt int, n long, known long, base double, score double, doc_id long, train boolean"


def other_words(parts: DataFrame, scored: DataFrame, hot: list[bytes], rest: float, stop: float) -> DataFrame:
    """row, n, known, base, score of every occurrence of a word that tasks don't hold: one shuffle by word brings occurrences, their pairs and the word's scores together.

    The word's probability after a held word: its share of the rarer words seen there in training, smoothed by CONTEXT_WEIGHT words of its own
    probability. ``rest`` is the probability of all words not held, ``stop`` the end's.
    """
    each = parts.where("word is not null").select("row", "word", "salt", "prev", "seen", "had", "at", "train")
    # At most one row per held word.
    contexts = each.where("train and prev >= 0").groupBy("prev").agg(F.count("*").alias("after"))
    salts = F.when(F.col("word").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
    own = scored.select("word", F.explode(salts).alias("salt"), "c", F.col("base").alias("own_base"), F.col("score").alias("own"))
    both = each.unionByName(own, allowMissingColumns=True)
    by_word, by_pair = Window.partitionBy("word", "salt"), Window.partitionBy("word", "salt", "prev")
    both = both.withColumn("pair", F.sum(F.when(F.col("train") & (F.col("prev") >= 0), 1).otherwise(0)).over(by_pair))
    for name in ("c", "own_base", "own"):
        both = both.withColumn(name, F.max(name).over(by_word))
    both = both.where("row is not null").join(F.broadcast(contexts), "prev", "left").withColumn("after", F.coalesce("after", F.lit(0)))
    total = F.col("at") + F.col("had") + TEXT_WEIGHT
    fresh = (F.col("had") + TEXT_WEIGHT) / total
    alone = F.log10(fresh) + F.log10(F.lit(float(CONTEXT_WEIGHT)) / (F.col("after") + CONTEXT_WEIGHT)) + F.col("own")  # very long words: below any double
    inner = (F.col("pair") * rest + F.pow(F.lit(10.0), "own") * CONTEXT_WEIGHT) / (F.col("after") + CONTEXT_WEIGHT)
    score = F.greatest(alone, F.log10(F.col("seen") * (1 - stop) / total + fresh * inner))
    return both.select("row", F.lit(1).cast("long").alias("n"), (F.col("c") > 0).cast("long").alias("known"), F.col("own_base").alias("base"), score.alias("score"))


def lm_scores(docs: DataFrame, train: Column, ws: Workspace, path: str = MODEL, id_col: str = "doc_id", text_col: str = "text", held_words: int = HELD_WORDS, passes: int = PASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Tokens are words (A-Z lower-cased, parted by ASCII white space) and one end per text. The model gives a word the mixture of two arcs
    sets over its bytes with a space in front: the vocabulary's pieces, summed over all segmentations, and the whole word as seen in training. The
    existing scores choose a segmentation of every training word, whose pieces' counts are the first probabilities; ``passes`` then re-estimate them
    over all segmentations. Each distinct word counts once there, as spelling serves words not seen, which resemble the rare ones. The whole-word arcs
    weigh as much as Good-Turing leaves to seen words (1 - words seen once / tokens). The end has its relative frequency. Probabilities of
    all texts sum to at most 1.

    Two more kinds of arcs make it a model of texts. The words that a text has had before weigh by their counts there, against distinct words so
    far and TEXT_WEIGHT (300) for the corpus. After one of the ``held_words`` most frequent training words, a rarer word weighs by its count after
    that word in all training texts, against CONTEXT_WEIGHT (100) for its own probability.

    Words go through the lattice once each, however often they occur. Scores of the held words are held by every task (a
    fixed number of rows); occurrences of all others meet their scores and contexts in one shuffle by word. Null texts are empty: one token. A null id counts as the text 'null' in
    the split. Without training rows every word is unknown. Extra columns are ignored; repeated rows are scored each.
    """
    vocabulary, spark = load(path), docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), train.alias("train"), text_of(text_col).alias("text"))
    words = base.select("train", "text").mapInArrow(count_batches, "word binary, c long, other long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("other").alias("other"))
    words = ws.save(words, "counts")
    ends = base.where("train").count()
    found = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("once")).first()
    n, v = int(found["n"]) + ends, int(found["v"]) + (ends > 0)
    share = max(0.0, 1 - found["once"] / n) if n else 0.0
    log_p = piece_scores(words.where("c > 0"), vocabulary, passes)
    hot = [bytes(r["word"]) for r in words.where((F.col("c") == 0) & (F.col("other") > HOT)).orderBy(F.desc("other"), "word").limit(HOT_WORDS).collect()]
    scored = ws.save(words.select("word", "c").mapInArrow(word_batches(vocabulary, log_p, (n, ends, v), share), "word binary, c long, base double, score double"), "words")
    ws.drop("counts")
    ws.tidy()
    top = scored.where("c > 0").orderBy(F.desc("c"), "word").limit(held_words).select("word", "base", "score")
    top = top.collect()
    bases, scores = np.array([r["base"] for r in top], float), np.array([r["score"] for r in top], float)
    held = spark.sparkContext.broadcast((pa.array([bytes(r["word"]) for r in top], pa.binary()), bases, scores, pa.array(hot, pa.binary())))
    end_base, end_score = math.log10((ends + 0.5) / (n + 0.5 * (v + 1))), math.log10(ends / n) if ends else math.log10(0.5 / (n + 0.5 * (v + 1)))
    stop = 10**end_score
    rest = max(0.0, 1 - stop - float((10.0**scores).sum()))
    # Rows are numbered in one job only, whose output is written: what is read of it is the same for every later step.
    rows = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", "train", "text")
    parts = ws.save(rows.mapInArrow(document_batches(held, (end_base, end_score, ends > 0)), PARTS), "parts")
    whole = parts.where("word is null").select("row", "n", "known", "base", "score", "doc_id", "train")
    whole = whole.unionByName(other_words(parts, scored, hot, rest, stop), allowMissingColumns=True)
    sums = whole.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n", "known", "base", "score")), F.max("doc_id").alias("doc_id"), F.max("train").alias("train"))
    return sums.select("doc_id", (~F.col("train")).alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
