"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text and normalised by length, with exception phrases."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Workspace, fresh, text_of

# Letters of other scripts that look like Latin ones, then signs and digits that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "ո": "n", "ս": "u", "օ": "o",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y", "ᴏ": "o", "ᴀ": "a", "ᴇ": "e", "ꜱ": "s",
}
SIGNS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"
#: i and l are one letter after folding, since 1 stands for either.
FOLD = {ord(a): b for a, b in (LOOKALIKES | SIGNS).items()} | {ord("i"): "l"} | {ord(LOOK): "l" for LOOK, b in LOOKALIKES.items() if b == "i"} | dict.fromkeys(map(ord, INVISIBLE), "")
FOLD_BYTES = bytes(ord(FOLD.get(b, chr(b))) if b < 128 else b for b in range(256))
#: Labelled rows that the lexicon and the two weights of its score are learned from, at most.
TRAINING_ROWS = 30_000
#: Letters of the word beginnings that may be terms, besides whole words.
STEMS = range(4, 9)
#: Toxic documents that hold a term: three, and four in a thousand of those learned from.
LEAST_DOCS, LEAST_SHARE, LEAST_WEIGHT = 3, 0.004, 3.0


def fold(text: str) -> str:
    """Lower case, compatibility forms, look-alikes and digits as the letters they stand for."""
    if text.isascii():
        return text.lower().encode().translate(FOLD_BYTES).decode()
    if not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(FOLD)


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights: a term that ends in a space is a whole word, others begin one. ``phrases`` take back the terms within them.

    The score is the logistic of ``bias`` + ``slopes`` times (log of 1 + weight, log of 1 + weight per hundred words).
    """

    terms: tuple[tuple[str, float], ...]
    phrases: tuple[str, ...] = ()
    bias: float = -2.0
    slopes: tuple[float, float] = (1.0, 1.0)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon, self.machine = lexicon, ahocorasick.Automaton()
        for term, weight in lexicon.terms:
            self.machine.add_word(term.rstrip(" "), (len(term.rstrip(" ")), weight, term.endswith(" "), False))
        for phrase in lexicon.phrases:
            self.machine.add_word(fold(phrase), (len(fold(phrase)), 0.0, True, True))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the terms: of those that share letters the longest, and none within an exception phrase."""
        if self.empty:
            return []
        found, excepted = [], []
        for last, (size, weight, whole, phrase) in self.machine.iter(folded):
            start, end = last + 1 - size, last + 1
            if start and folded[start - 1].isalnum() or whole and end < len(folded) and folded[end].isalnum():
                continue
            (excepted if phrase else found).append((start, end, weight))
        kept: list[tuple[int, int, float]] = []
        for m in sorted(found, key=lambda m: (m[0], -m[1])):
            if kept and m[0] < kept[-1][1]:
                continue
            kept.append(m)
        return [m for m in kept if not any(a <= m[0] and m[1] <= b for a, b, _ in excepted)] if excepted else kept

    def measure(self, text: str) -> tuple[float, int, int]:
        """Weight of all matches, their number, words."""
        found = self.matches(fold(text))
        return sum(m[2] for m in found), len(found), len(text.split())

    def features(self, weight: float, words: int) -> tuple[float, float]:
        return math.log1p(weight), math.log1p(100 * weight / (words + 20))

    def score(self, weight: float, words: int) -> float:
        a, b = self.features(weight, words)
        z = self.lexicon.bias + self.lexicon.slopes[0] * a + self.lexicon.slopes[1] * b
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


WORDS = re.compile(r"[^\W_]+")


def term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, text) to (term, documents with it by label), terms being whole words and word beginnings of the folded text."""
    tally: tuple[Counter, Counter] = (Counter(), Counter())
    shapes: dict[str, tuple[str, ...]] = {}

    def flush() -> pa.RecordBatch:
        terms = list(tally[0].keys() | tally[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([tally[k][t] for t in terms], pa.int64()) for k in (1, 0))], ["term", "toxic", "clean"])
        tally[0].clear(), tally[1].clear(), shapes.clear()
        return out

    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            terms: set[str] = set()
            for w in set(WORDS.findall(fold(text.as_py().decode()))):
                if (own := shapes.get(w)) is None:
                    own = shapes[w] = (*(w[:k] for k in STEMS if k <= len(w)), f"{w} ")
                terms.update(own)
            tally[int(toxic)].update(terms)
            if len(tally[0]) + len(tally[1]) > 500_000:
                yield flush()
    yield flush()


def sift(rows: list[tuple[str, int, int, float]]) -> tuple[tuple[str, float], ...]:
    """Of beginnings and words that say the same, one: a shorter term where it is found in clearly more toxic documents, else the longer."""
    by_term = {t: (n, w) for t, n, _, w in rows}
    shorter = lambda t: [t[:k] for k in range(1, len(t)) if t[:k] in by_term]
    kept = {t for t, (n, w) in by_term.items() if not any(by_term[s][0] > 1.15 * n and by_term[s][1] >= w - 1.5 for s in shorter(t))}
    kept -= {s for t in kept for s in shorter(t) if by_term[s][0] <= 1.15 * by_term[t][0]}
    return tuple(sorted((t, round(by_term[t][1], 4)) for t in kept))


def measure_batches(lexicon: Lexicon):
    """(toxic, text) to measures of each, and the two-word phrases around matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            out = []
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py().decode()
                folded = fold(text)
                found = matcher.matches(folded)
                phrases = set()
                for a, b, _ in found:
                    after = WORDS.match(folded, b + 1) if b < len(folded) and folded[b] == " " else None
                    k = a - 1
                    while a and folded[a - 1] == " " and k > 0 and folded[k - 1].isalnum():
                        k -= 1
                    phrases |= {folded[a : after.end()]} if after else set()
                    phrases |= {folded[k:b]} if 0 <= k < a - 1 else set()
                out.append((int(toxic), sum(m[2] for m in found), len(text.split()), sorted(phrases)))
            cols = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.string()))], ["toxic", "weight", "words", "phrases"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton's method; the bias is the first."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        keep = ridge * np.array([0.0] + [1.0] * (x.shape[1] - 1))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep) + 1e-6 * np.eye(len(w)), x.T @ (y - p) - keep * w)
        w += move
        if np.abs(move).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAINING_ROWS, phrases: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from at most ``rows`` labelled documents (drawn by a hash of the id) for which ``train`` holds; one scan of ``docs`` gathers them.

    Terms are those whose odds among toxic documents are e**LEAST_WEIGHT times those among clean ones. Phrases of two words that hold a
    term and stand in clean documents only, three at least, become exceptions. All that qualify are taken: as each term stands in LEAST_SHARE of the
    toxic sample, their number is bounded by the sample, not by the corpus. Words are whole, however long. Labels other than 0 and 1, null ids and ids
    labelled twice (one label is taken) do no harm. Documents that repeat an id are learned from each. Without labels of both kinds no term is learned.
    """
    chosen = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1)).select(F.col(id_col), "toxic").where(train).dropDuplicates([id_col])
    chosen = chosen.orderBy(F.xxhash64(F.col(id_col)), id_col).limit(rows)
    sample = docs.select(F.col(id_col), text_of(text_col).alias("text")).join(F.broadcast(chosen), id_col).select(F.col("toxic").cast("int").alias("toxic"), "text")
    sample = Workspace(docs.sparkSession, "lexicon").save(sample, "sample")
    counts = {r[0]: r[1] for r in sample.groupBy("toxic").agg(F.count("*")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    prior = math.log((toxic + 0.5) / (clean + 0.5))
    if not toxic or not clean:
        return Lexicon((), tuple(phrases), min(-0.1, prior) if not toxic else prior, (1.0, 1.0))
    terms = sample.mapInArrow(term_batches, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    weight = F.log((F.col("t") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(clean + 1.0))
    terms = terms.withColumn("w", weight).where((F.col("t") >= max(LEAST_DOCS, LEAST_SHARE * toxic)) & (F.col("w") >= LEAST_WEIGHT))
    lexicon = Lexicon(sift([tuple(r) for r in terms.orderBy((F.col("t") * F.col("w")).desc(), "term").collect()]), tuple(phrases))
    measured = sample.mapInArrow(measure_batches(lexicon), "toxic int, weight double, words long, phrases array<string>")
    around = measured.select("toxic", F.explode("phrases").alias("p")).groupBy("p").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).where("t = 0 and n >= 3").orderBy("p")
    excepted = [r[0] for r in around.collect()]
    lexicon = Lexicon(lexicon.terms, (*phrases, *excepted))
    measured = sample.mapInArrow(measure_batches(lexicon), "toxic int, weight double, words long, phrases array<string>").select("toxic", "weight", "words").toPandas()
    x = np.column_stack((np.log1p(measured["weight"]), np.log1p(100 * measured["weight"] / (measured["words"] + 20))))
    bias, *slopes = (float(v) for v in logistic(x, measured["toxic"].to_numpy(float)))
    return Lexicon(lexicon.terms, lexicon.phrases, bias, tuple(slopes))


def score_batches(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            found = [matcher.measure(t.as_py().decode("utf-8", "replace")) for t in batch.column(1)]
            scores = [matcher.score(w, n) for w, _, n in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([m for _, m, _ in found], pa.int64())], ["doc_id", "score", "n_matches"])

    return run


def toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_matches for every row: the whole text folded and matched in one pass, without any exchange.

    Null texts are empty; an empty text has no match and gets the score of one without any. Extra columns are ignored, repeated rows are scored
    each, no rows give no rows.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(score_batches(lexicon), "doc_id long, score double, n_matches long")


def tag_batches(lexicon: Lexicon, name: str):
    """Batches whose last column is the text's bytes, with the score ``name`` in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            scores = []
            for t in batch.column(batch.num_columns - 1):
                w, _, n = matcher.measure(t.as_py().decode("utf-8", "replace"))
                scores.append(matcher.score(w, n))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], name])

    return run


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``least``, with all their columns, whatever their names.

    Null texts are empty. Repeated rows stay or go together; no rows give no rows.
    """
    octets, score = fresh(docs, "octets", "score")
    wide = docs.withColumn(octets, text_of(text_col))
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])
    return wide.mapInArrow(tag_batches(lexicon, score), schema).where(F.col(score) < least).drop(score)
