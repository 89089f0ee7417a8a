"""Each operator against brute force on small tables with nulls, empty and repeated rows, ties and extra columns."""

import base64
import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sluice.llm import components, embeddings, exact, lines, lm, mixing, runindex, simhash, subword, toxicity, warc
from sluice.llm.common import LOWER, Workspace, bucket_of, local_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, hash string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["Alpha", "beta", "gämma", "delta", "zeta.", "eta", "theta", "iota", "kappa", "new"]
    base = [" ".join(rng.choices(words, k=rng.randrange(1, 90))) for _ in range(12)]
    texts = [rng.choice(base) for _ in range(30)]
    texts += ["\n".join(rng.choice(base)[:40] for _ in range(rng.randrange(1, 9))) for _ in range(20)]
    texts += [b[:60] + " edited " + b[60:] for b in base] + [None, "", "", " \n\t ", "x" * 5000, "ab" * 300, "ab" * 280, "one", "One", "a b"]
    out = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(out)
    return [*out, out[0], (3, "another text under an id that is taken, quite long enough to hold fifty bytes"), (None, "no id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", ["s1", "s2", None][k % 3], 0, 1, "h") for k, (i, t) in enumerate(rows)], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_exact(spark, docs, rows, none):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert Counter(map(tuple, exact.exact_dedup(docs, Workspace(spark, "t"), capacity=5).collect())) == want
    assert exact.exact_dedup(none, Workspace(spark, "t")).count() == 0
    # One key for all texts: a single chain, in which only bytes tell texts apart.
    from pyspark.sql import functions as F

    assert Counter(map(tuple, exact.exact_dedup(docs, Workspace(spark, "t"), capacity=5, key=lambda _: F.lit(-7)).collect())) == want
    small = spark.createDataFrame([(k, t, k) for k, t in enumerate(("aa", "aa", "bb", "bb", "cc"))], "doc_id long, text string, key long")
    got = exact.exact_dedup(small, Workspace(spark, "t"), key=lambda _: F.lit(0)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {0: (1, 2), 1: (1, 2), 2: (3, 2), 3: (3, 2), 4: (4, 1)}


def test_owners_refuse_texts_that_only_their_digest_equates():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"bucket": 0, "key": 1, "n": 1, "sha": b"x", "text": t, "keep_id": 1, "group_size": 1} for t in (b"a", b"b")])
    with pytest.raises(ValueError):
        list(exact.owner_batches([batch]))


def test_directory_splits_only_what_is_full():
    keys = [k << 24 for k in range(1000)] + [5 << 60 >> 24] * 400

    def counts(bits, below, parent):
        return Counter(k >> (40 - bits) if bits else 0 for k in keys)

    d = exact.grow(counts, 100)
    lows = d.lows
    held = Counter(sum(x <= k for x in lows[1:]) for k in keys)
    assert lows == sorted(lows) and max(held.values()) <= 1000 and d.depth <= 40


def test_simhash(spark, docs, rows, none):
    def fp(t):
        w = (t or "").encode().translate(LOWER).split()
        s = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t in rows]
    a, b = np.nonzero([[(x ^ y).bit_count() <= 3 for y in fps] for x in fps])
    root = local_components(a, b, len(fps))
    names = defaultdict(list)
    for k, r in enumerate(root):
        names[r] += [rows[k][0]] * (rows[k][0] is not None)
    want = Counter((i, f"{fps[k]:016x}", min(names[root[k]], default=None)) for k, (i, _) in enumerate(rows))
    assert Counter(map(tuple, simhash.simhash_dedup(docs, Workspace(spark, "t")).collect())) == want
    assert simhash.simhash_dedup(none, Workspace(spark, "t")).count() == 0


@pytest.mark.parametrize("longest", [8192, 1])
def test_links_join_what_all_pairs_join(spark, longest):
    rng = random.Random(9)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = list({s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))) for s in seeds for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = components.connected_components(simhash.links(df, Workspace(spark, "t"), 3, longest), Workspace(spark, "t"))
    found = {r.node: r.component for r in got.collect()}
    a, b = np.nonzero([[(x ^ y).bit_count() <= 3 for y in fps] for x in fps])
    root = local_components(a, b, len(fps))
    mine = defaultdict(set)
    for k, f in enumerate(signed):
        mine[root[k]].add(f)
    theirs = defaultdict(set)
    for f in signed:
        theirs[found.get(f, f)].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def left_of(rows):
    """What ``repeat_dedup`` should give."""
    least = lambda i: -(1 << 63) if i is None else i
    first = {}
    for i, t in rows:
        t = (t or "").encode()
        for p in range(len(t) - 49):
            first[t[p : p + 50]] = min(least(i), first.get(t[p : p + 50], 1 << 62))
    want = Counter()
    for i, t in rows:
        t = (t or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < least(i):
                gone[p : p + 50] = b"\1" * 50
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        want[i, len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()] += 1
    return want


@pytest.mark.parametrize("crowded", [100_000, 3, 0])
def test_repeats(spark, docs, rows, none, crowded):
    assert Counter(map(tuple, runindex.repeat_dedup(docs, Workspace(spark, "t"), crowded=crowded).collect())) == left_of(rows)
    assert runindex.repeat_dedup(none, Workspace(spark, "t"), crowded=crowded).count() == 0


@pytest.mark.parametrize("crowded", [100_000, 50])
def test_repeats_with_a_common_anchor_in_many_contexts(spark, crowded):
    """A string of 40 bytes in 400 texts, its neighbours unlike or alike for a few bytes, and very long texts over several pieces."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choices("abcdefghij", k=n))
    common, sides = word(40), [word(12) for _ in range(5)]
    texts = [word(rng.randrange(0, 30)) + rng.choice(sides) + common + rng.choice(sides) + word(rng.randrange(0, 30)) for _ in range(400)]
    long = word(150_000)
    texts += [long, word(70) + long[100_000:] + long[:40_000], "x" * 140_000, "x" * 200]
    own = list(enumerate(texts))
    df = spark.createDataFrame(own, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, runindex.repeat_dedup(df, Workspace(spark, "t"), crowded=crowded).collect())) == left_of(own)


@pytest.mark.parametrize("size, n", [(3000, 4000), (60, 70_000)])
def test_anchors_and_passages_take_little_memory_beside_their_batch(monkeypatch, size, n):
    """Of a batch of long texts, and of more short ones than a unit has places for; all anchors that two rows share are asked for."""
    monkeypatch.setattr(runindex, "UNIT_ANCHORS", 600_000)
    monkeypatch.setattr(runindex, "UNIT_BYTES", 1 << 20)
    rng = np.random.default_rng(7)
    data, ids = rng.integers(97, 123, n * size).astype(np.uint8), rng.permutation(n) - n // 2
    for k in range(0, n, 10):
        data[k * size : (k + 1) * size] = data[(k * 7 % n) * size :][:size]
    texts = [data[k * size : (k + 1) * size].tobytes() for k in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts, pa.binary())], ["row", "text"])

    def drained(run, batches):
        """What it gives, and the most that it held meanwhile beside that."""
        tracemalloc.start()
        out, most = [], 0
        for b in run(iter(batches)):
            out.append(b)
            most = max(most, tracemalloc.get_traced_memory()[1])
        most = max(most, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        return pa.Table.from_batches(out), most / 1e6

    packed, most = drained(runindex.anchor_batches(50, 24, 5), [batch])
    assert most < 30
    owners = defaultdict(set)
    for h, number, _, _ in runindex.passages(data, np.arange(n + 1) * size, 50, 24):
        for a, row in zip((h & np.uint64((1 << runindex.ANCHOR_BITS) - 1)).tolist(), ids[number].tolist(), strict=True):
            owners[a].add(row)
    asked = defaultdict(set)
    for b in runindex.shared_batches(iter(packed.sort_by("bucket").to_batches(max_chunksize=100))):
        for row, h in zip(*(c.to_pylist() for c in b.columns), strict=True):
            asked[row].add(h)
    assert {(row, a) for a, rows in owners.items() if len(rows) > 1 for row in rows} == {(row, a) for row, own in asked.items() for a in own}
    asking = batch.append_column("doc", batch.column(0)).append_column("hs", pa.array([sorted(asked[row]) for row in ids.tolist()], pa.list_(pa.int64())))
    assert drained(runindex.passage_batches(50, 24, 5), [asking])[1] < 15


def test_matching_statistics():
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"abc", k=rng.randrange(3, 40))) for _ in range(12)]
    index = runindex.RunLengthIndex.build(texts, np.arange(12), 5)
    patterns = [bytes(rng.choices(b"abcd", k=rng.randrange(1, 30))) for _ in range(30)]
    for back, who, length, _ in index.matching_statistics(patterns):
        for k, n in zip(who.tolist(), length.tolist(), strict=True):
            p = patterns[k][len(patterns[k]) - back :]
            assert n == max(m for m in range(len(p) + 1) if any(p[:m] in t for t in texts))


def cut_lines(rows, words):
    """What ``line_dedup`` should leave: (id, text) counted, rows equal in id and text being one."""
    key = {}
    for i, t in set(rows):
        key[i, t] = (i is not None, i or 0, t or "")
    ties = Counter(i for i, _ in set((i, t or "") for i, t in rows))
    assert max(ties.values()) == 1, "the order of unlike texts with one id is that of a hash"
    seen, left = set(), {}
    for (i, t), _ in sorted(key.items(), key=lambda x: x[1]):
        own = t.split("\n") if t else []
        gone = [False] * len(own)
        for size in (1, 2, 3):
            for p in range(len(own) - size + 1):
                gram = tuple(own[p : p + size])
                if size == 3 or words and sum(len(x.split()) for x in gram) >= words:
                    if gram in seen:
                        gone[p : p + size] = [True] * size
                    seen.add(gram)
        left[i, t] = ("\n".join(x for x, g in zip(own, gone, strict=True) if not g), len(own), sum(gone))
    return Counter((i, *left[i, t]) for i, t in rows)


@pytest.mark.parametrize("words", [None, 5, 50])
def test_lines(spark, docs, rows, none, words):
    from pyspark.sql import functions as F

    odd = "another text under an id that is taken"  # its id is (3, ...), whose order against the other text is a hash's
    own = [(i, t) for i, t in rows if not (t or "").startswith(odd)]
    got = lines.line_dedup(docs.where(~F.coalesce("text", F.lit("")).startswith(odd)), Workspace(spark, "t"), words=words).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got) == cut_lines(own, words)
    assert lines.line_dedup(docs, Workspace(spark, "t")).count() == len(rows)
    assert lines.line_dedup(none, Workspace(spark, "t")).count() == 0


def test_winnowing_selects_fewer_than_windows():
    hashes = np.random.default_rng(3).integers(0, 1 << 60, 10_000)
    chosen = set(lines.winnow(hashes, 3).tolist())
    assert 0.45 < len(chosen) / len(hashes) < 0.55  # 2 / (window + 1)


@pytest.mark.parametrize("work", ["lines", "lm"])
def test_rows_of_a_shuffled_input_stay_whole(spark, work):
    """An input that is no scan, not cached, and evaluated more than once in different ways."""
    from pyspark.sql import functions as F

    rng = random.Random(1)
    texts = ["\n".join(rng.choice(["one two", "three", "four", "five six seven", "eight"]) for _ in range(rng.randrange(1, 12))) for _ in range(1500)]
    scan = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        shuffled = scan.repartition("doc_id")
        run = (lambda d: lines.line_dedup(d, Workspace(spark, "t"))) if work == "lines" else (lambda d: lm.lm_scores(d, bucket_of("doc_id", 5) != 1, Workspace(spark, "t"), held_words=2).select("doc_id", "n_tokens", "n_known", F.round("base_score", 6), F.round("score", 6)))
        a, b = Counter(map(tuple, run(scan).collect())), Counter(map(tuple, run(shuffled).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b and sum(a.values()) == 1500


def test_lines_by_words(spark):
    long, half, short = " ".join(["word"] * 50), " ".join(["half"] * 25), "a short line"
    texts = [long, f"{long}\n{short}", short, short, f"{half}\n{half}", f"x\n{half}\n{half}\ny", half, f"{long}\n{short}\n{long}", "p\nq\nr", "p\nq\nr\ns", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    seen, want = set(), {}
    for i, t in enumerate(texts):
        own = t.split("\n") if t else []
        gone = [False] * len(own)
        for size in (1, 2, 3):
            for p in range(len(own) - size + 1):
                gram = tuple(own[p : p + size])
                if size == 3 or sum(len(x.split()) for x in gram) >= 50:
                    if gram in seen:
                        gone[p : p + size] = [True] * size
                    seen.add(gram)
        want[i] = "\n".join(x for x, g in zip(own, gone, strict=True) if not g)
    assert want[1] == short and want[3] == short and want[5] == "x\ny" and want[7] == "" and want[9] == "s"
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.line_dedup(docs, Workspace(spark, "t")).collect()}
    assert {i: t for i, (t, _) in got.items()} == want and got[7][1] == 3
    plain = {r.doc_id: r.n_removed for r in lines.line_dedup(docs, Workspace(spark, "t"), words=None).collect()}
    assert {i for i, n in plain.items() if n} == {9}


def test_warc(spark):
    html = ["<p>ä</p>" * 50, None, "", "<p>ä</p>" * 50, "z" * 100_000, "\r\n\r\nWARC/1.1\r\n"]
    pages = spark.createDataFrame([(k, f"http://x/{k} \r\n", h, "e") for k, h in enumerate(html)] + [(9, None, "z", "e")], "page_id long, url string, html string, hex string")
    ws = Workspace(spark, "t")
    root = f"{ws.path}/warc"
    archives = warc.write_archives(pages, ws, root, chunk=1000, archive_bytes=200)
    chunks = warc.read_archives(archives, root, 1000)
    got = {r.page_id: tuple(r)[1:] for r in warc.records_of(chunks).collect()}
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    keep = {t or "": k for k, t in enumerate(html)}
    for k, t in enumerate(html):
        n = keep[t or ""]
        assert got[k] == (len((t or "").encode()), digest(t), "response" if n == k else "revisit", None if n == k else n)
    parts = chunks.where("page_id = 4").orderBy("chunk_no").collect()
    assert len(parts) == 100 and b"".join(p.chunk for p in parts) == b"z" * 100_000
    assert [p.payload_digest for p in parts] == [digest("z" * (k + 1) * 1000) for k in range(100)]
    # Every revisit names a record of the archives, that of its response; rows that repeat a page have names of their own.
    rows = [*((k, "u", h, "e") for k, h in enumerate(html)), (0, "v", html[0], "e"), (4, "u", html[4], "e"), (4, "u", html[4], "e"), (None, "u", html[0], "e"), (None, None, None, "e")]
    root = f"{ws.path}/again"
    read = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, pages.schema), ws := Workspace(spark, "t"), root, chunk=1000), root, 1000).where("last").collect()
    assert len(read) == len(rows) and len({r.record_id for r in read}) == len(rows)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in read) == Counter([(0, "revisit", 3)] * 2 + [(1, "revisit", 2), (2, "response", None), (3, "response", None), (5, "response", None), (None, "revisit", 3), (None, "revisit", 2)] + [(4, "response", None)] * 3)
    names = {r.record_id: r.page_id for r in read}
    files = warc.Files(root)
    import gzip
    import os

    seen = 0
    for name in os.listdir(files.local):
        for line in gzip.open(f"{files.local}/{name}").read().split(b"\r\n"):
            if line.startswith(b"WARC-Refers-To: "):
                seen += 1
                assert names[line[16:].decode()] in (2, 3)
    assert seen == 5
    assert warc.records_of(warc.read_archives(warc.write_archives(pages.where("false"), ws := Workspace(spark, "t"), root), root)).count() == 0


def test_mixing(spark, docs, rows, none):
    got = mixing.mix(docs, Workspace(spark, "t"), shard=300).collect()
    size = lambda t: len((t or "").encode().split())
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    goals, sums = {r.source: (r.target, r.source_size) for r in got}, Counter()
    for r in got:
        sums[r.source] += r.taken
    left, todo, want = 1.5 * sum(size(t) for _, t in rows), {"s1": 5, "s2": 2, None: 1}, {}
    while todo:  # fill by weight, fix those above their cap, share the rest
        over = [s for s in todo if left * todo[s] / sum(todo.values()) >= 2 * goals[s][1]]
        if not over:
            want |= {s: left * w / sum(todo.values()) for s, w in todo.items()}
            break
        for s in over:
            want[s] = 2.0 * goals[s][1]
        for s in over:
            left -= want[s]
            del todo[s]
    for s, (target, _) in goals.items():
        assert target == pytest.approx(want[s]) and abs(sums[s] - target) <= 6 * mixing.BLOCK
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(2), Workspace(spark, "t"), shard=300).collect()))
    assert mixing.mix(none, Workspace(spark, "t")).count() == 0


def test_apportionment(spark):
    seats, weights = 50, {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.1, "e": 0.0}
    df = spark.createDataFrame([(p, w, seats) for p, w in weights.items()], "p string, w double, seats long")
    got = {r.p: r.quota for r in mixing.apportion(df, [], ["p"], "w", "seats").collect()}
    best = sorted(((-w / (2 * k + 1), p) for p, w in weights.items() if w for k in range(seats)))[:seats]
    assert got == dict.fromkeys(weights, 0) | Counter(p for _, p in best)


@pytest.mark.parametrize("small", [0.45, 0.55])
def test_apportionment_with_very_many_small_parties(spark, small):
    seats, weights = 1000, {"hot": 1000.0 - 400 * small} | {f"s{k:03}": small for k in range(400)}
    df = spark.createDataFrame([(p, w, seats) for p, w in weights.items()], "p string, w double, seats long")
    got = {r.p: r.quota for r in mixing.apportion(df, [], ["p"], "w", "seats").collect()}
    best = sorted(((-w / (2 * k + 1), p) for p, w in weights.items() for k in range(seats)))[:seats]
    assert got == dict.fromkeys(weights, 0) | Counter(p for _, p in best)


def test_apportionment_in_groups_with_ties(spark):
    """A heavy party beside 1,000 light ones, equal ones that tie for the last seat, a null group, weights that are none."""
    rows = [("a", 0, 10_000.0, 1025), *(("a", k, 6.4, 1025) for k in range(1, 1001)), *((None, k, 1.0, 5) for k in range(9)), ("c", 0, None, 4), ("c", 1, -1.0, 4), ("c", 2, 0.0, 4), *(("d", k, float(k), 0) for k in range(3))]
    df = spark.createDataFrame(rows, "g string, p long, w double, seats long")
    got = {(r.g, r.p): r.quota for r in mixing.apportion(df, ["g"], ["p"], "w", "seats").collect()}
    want = Counter()
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        bids = sorted(((-w / (2 * k + 1), p) for _, p, w, _ in own if w and w > 0 for k in range(own[0][3])))[: own[0][3]]
        want.update((g, p) for _, p in bids)
    assert got == {(g, p): want[g, p] for g, p, _, _ in rows}


def test_sentencepiece(spark, docs, rows, none):
    got = subword.encode(docs).collect()
    assert all(r.round_trip for r in got) and len(got) == len(rows)
    texts = Counter((i, t or "") for i, t in rows)
    assert Counter((r.doc_id, r.text) for r in subword.decode(subword.encode(docs)).collect()) == texts
    assert subword.encode(none).count() == 0
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = proto.ModelProto()
    model.ParseFromString(open(subword.MODEL, "rb").read())
    model.trainer_spec.model_type = 1  # the library's lattice over the same pieces and scores
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    coder = subword.Encoder(subword.load())
    octets = {i: b for b, i in enumerate(coder.automaton.vocabulary.byte_ids)}  # an unknown character is its bytes, and costs once
    score = lambda ids: sum(coder.automaton.score[i] if i not in octets else coder.automaton.unknown * (octets[i] & 0xC0 != 0x80) for i in ids)
    rng = random.Random(8)
    odd = ["word " * 400, "漢字仮名交じり文" * 90, "".join(rng.choices("abcdeäöü漢字🙂\u0378", k=700)), "x" * 3000, "𝔘𝔫𝔦" * 100, "a\u200b" * 200, " ".join("".join(rng.choices("etaoin", k=rng.randrange(1, 300))) for _ in range(20))]
    for t in [*(t for _, t in rows), *odd]:
        if t and "\n" not in t and "\t" not in t and "  " not in t and t == t.strip():
            mine = np.frombuffer(coder.encode([t.encode()])[0], np.int32).tolist()
            theirs = score(library.nbest_encode_as_ids(t, 2)[0])
            assert score(mine) == pytest.approx(theirs) if len(t) < 600 else score(mine) >= theirs  # its search for long texts drops hypotheses


def test_long_strings_alone_are_walked_as_together():
    a = subword.automaton(subword.load())
    rng = random.Random(3)
    strings = ["".join(rng.choices(alphabet, k=rng.randrange(1, 120))).encode()[:cut] for alphabet in ("abcdefgh ", "aab", "漢字abc", "äß🙂 \u0378x", "thequickbrownfox") for cut in (None, 7, 50) for _ in range(12)]
    strings = [s.decode("utf-8", "ignore").encode() for s in strings if s]
    for mine, s in zip(a.encode_together(strings), strings, strict=True):
        assert mine.tolist() == a.encode_alone(s).tolist()
    log_p = np.log(np.random.default_rng(1).dirichlet(np.ones(len(a.vocabulary.pieces))))
    short = [s for s in strings if len(s) <= subword.LONGEST_TOGETHER]
    assert a.likelihood(short, log_p) == pytest.approx([a.total_alone(s, log_p) for s in short])
    assert a.expected(short, log_p) == pytest.approx(sum(a.expected_alone(s, log_p) for s in short), abs=1e-9)


def test_sentencepiece_tells_what_it_can_not_keep(spark):
    texts = ["plain", "a\u2581b", "\u2581", "line\n\nline  two\r\n", "tab\t", " lead", "\u0000", None]
    got = {r.doc_id: r for r in subword.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[k].round_trip for k in range(8)] == [True, False, False, True, True, True, True, True]
    back = {r.doc_id: r.text for r in subword.decode(spark.createDataFrame([(k, r.ids) for k, r in got.items()] + [(99, None)], "doc_id long, ids array<int>")).collect()}
    assert back == {k: (t or "").replace("\u2581", " ") for k, t in enumerate(texts)} | {99: ""}


def test_lm(spark, docs, rows, none):
    got = lm.lm_scores(docs, bucket_of("doc_id", 5) != 1, Workspace(spark, "t"), held_words=3).collect()
    held = lambda i: zlib.crc32(str("null" if i is None else i).encode()) % 5 == 1
    tokens = lambda t: [*(t or "").encode().translate(LOWER).split(), None]
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got) and lm.lm_scores(none, bucket_of("doc_id", 5) != 1, Workspace(spark, "t")).count() == 0


@pytest.mark.parametrize("hot", [100_000, 0])
def test_lm_scores_by_plain_counting(spark, docs, rows, monkeypatch, hot):
    """Every token's probability from whole counts, one after another; also with every unknown word dealt as a hot one."""
    monkeypatch.setattr(lm, "HOT", hot)
    got = Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in lm.lm_scores(docs, bucket_of("doc_id", 5) != 1, Workspace(spark, "t"), held_words=3).collect())
    plain = [(i, zlib.crc32(str("null" if i is None else i).encode()) % 5 != 1, (t or "").encode().translate(LOWER).split()) for i, t in rows]
    c = Counter(w for _, train, ws in plain if train for w in ws)
    ends = sum(train for _, train, _ in plain)
    n = sum(c.values()) + ends
    share, stop = 1 - sum(k == 1 for k in c.values()) / n, ends / n
    vocabulary = subword.load()
    log_p = lm.piece_scores(spark.createDataFrame([(bytearray(w),) for w in c], "word binary"), vocabulary, lm.PASSES)
    every = sorted({w for _, _, ws in plain for w in ws})
    spelled = dict(zip(every, subword.Automaton(vocabulary).likelihood([b" " + w for w in every], log_p), strict=True))
    p = {w: share * c[w] / n + (1 - share) * (1 - stop) * math.exp(spelled[w]) for w in every}
    held = set(sorted(c, key=lambda w: (-c[w], w))[:3])
    rest = 1 - stop - sum(p[w] for w in held)
    pairs = Counter((a, b) for _, train, ws in plain if train for a, b in zip(ws, ws[1:], strict=False) if a in held and b not in held)
    after = Counter()
    for (a, _), k in pairs.items():
        after[a] += k
    want = Counter()
    for i, _, ws in plain:
        score, had = math.log10(stop), Counter()
        for at, w in enumerate(ws):
            own, log_own, a = p[w], math.log10(p[w]) if p[w] else spelled[w] / math.log(10) + math.log10((1 - share) * (1 - stop)), ws[at - 1] if at else None
            if w not in held and a in held:
                scale = lm.CONTEXT_WEIGHT / (after[a] + lm.CONTEXT_WEIGHT)
                own, log_own = rest * pairs[a, w] / (after[a] + lm.CONTEXT_WEIGHT) + own * scale, log_own + math.log10(scale)
            total = at + len(had) + lm.TEXT_WEIGHT
            fresh = (len(had) + lm.TEXT_WEIGHT) / total
            now = (1 - stop) * had[w] / total + fresh * own
            score += math.log10(now) if now > 0 else math.log10(fresh) + log_own
            had[w] += 1
        want[i, len(ws) + 1, round(score, 6)] += 1
    assert got == want


def test_short_words_are_summed_without_logarithms(monkeypatch):
    """Words whose sums a double holds; the others, in log space, give the same."""
    a = subword.Automaton(subword.load())
    log_p = np.log(np.random.default_rng(2).dirichlet(np.ones(len(a.vocabulary.pieces))))
    words = [b" the", b" xyz", b"", " gämma".encode(), b"\xff\xfe", b" internationally", b" the"]
    plain = [a.total_alone(w, log_p) for w in words], sum(a.expected_alone(w, log_p) for w in words)

    def refuse(*_):
        raise AssertionError("a logarithm")

    with monkeypatch.context() as m:
        m.setattr(np, "logaddexp", refuse)
        got = a.likelihood(words, log_p), a.expected(words, log_p)
    assert np.allclose(got[0], plain[0], rtol=1e-12) and np.allclose(got[1], plain[1], atol=1e-12)
    faint = log_p - 400  # no double holds the probability of two pieces
    words.append(b" ab" * 30)
    assert np.allclose(a.likelihood(words, faint), [a.total_alone(w, faint) for w in words], rtol=1e-12)
    assert np.allclose(a.expected(words, faint), sum(a.expected_alone(w, faint) for w in words), atol=1e-9)
    wide = log_p.copy()
    wide[a.byte_id] -= 100  # words of up to five bytes without logarithms, the others with them
    assert 3 < a.representable(wide) < 8
    assert np.allclose(a.likelihood(words, wide), [a.total_alone(w, wide) for w in words], rtol=1e-12)
    assert np.allclose(a.expected(words, wide), sum(a.expected_alone(w, wide) for w in words), atol=1e-9)


@pytest.mark.parametrize("flush", [400_000, 3])
def test_words_are_counted_by_arrays(monkeypatch, flush):
    """Odd bytes, white space at either end, texts without words, blocks of one text, and counts passed on early."""
    monkeypatch.setattr(lm, "FLUSH", flush)
    monkeypatch.setattr(lm, "TOGETHER", 40)
    rng = random.Random(7)
    texts = [b"", b" ", b"A", b"\x1c\x1f\x85\xa0 \x0b\x0cb\r\n", b"\x00 \xff", *(bytes(rng.choices(b"aAbBzZ[@ \t\n\x0b\x0c\r\xc3\xa4\x00", k=rng.randrange(90))) for _ in range(300))]
    train = [rng.random() < 0.7 for _ in texts]
    want = Counter(), Counter()
    for t, w in zip(texts, train, strict=True):
        want[not w].update(t.translate(LOWER).split())
    for sliced in (0, 5):
        batch = pa.RecordBatch.from_arrays([pa.array([True] * sliced + train), pa.array([b"cut off"] * sliced + texts, pa.binary())], ["train", "text"]).slice(sliced)
        got = Counter(), Counter()
        for out in lm.count_batches(iter([batch, batch.slice(0, 0)])):
            for w, *n in zip(*(c.to_pylist() for c in out.columns), strict=True):
                for k in (0, 1):
                    got[k][w] += n[k]
        assert (+got[0], +got[1]) == want
    words, sizes = lm.tokens(texts)
    assert words.to_pylist() == [w for t in texts for w in t.translate(LOWER).split()] and sizes.tolist() == [len(t.split()) for t in texts]
    assert sum(b.num_rows for b in lm.blocks(batch, 1, 40)) == len(texts) and lm.tokens([])[0].to_pylist() == []


def test_lattice_sums_over_all_segmentations():
    a = subword.automaton(subword.load())
    pieces = {p: i for i, (p, n) in enumerate(zip(a.vocabulary.pieces, a.vocabulary.normal, strict=True)) if n}
    log_p = np.log(np.random.default_rng(1).dirichlet(np.ones(len(a.vocabulary.pieces))))
    strings = [b" the", b" xyz", " gämma".encode(), b"\xff\xfe", b" " + b"ab" * 90]
    for s, got in zip(strings, a.likelihood(strings, log_p), strict=True):
        total = [0.0]
        for j in range(1, len(s) + 1):
            ways = [total[j - 1] + log_p[a.vocabulary.byte_ids[s[j - 1]]]] + [total[i] + log_p[pieces[s[i:j]]] for i in range(max(0, j - 48), j) if s[i:j] in pieces]
            total.append(np.logaddexp.reduce(ways))
        assert got == pytest.approx(total[-1])
    # The expected count of a piece is the derivative of the log likelihood by its log probability.
    tally, step = a.expected(strings, log_p), 1e-4
    for i in (*map(pieces.get, (b" the", b"he", b"ab", b"ma", b"e")), a.vocabulary.byte_ids[0xFF], a.vocabulary.byte_ids[ord("x")]):
        up, down = log_p.copy(), log_p.copy()
        up[i] += step
        down[i] -= step
        assert tally[i] == pytest.approx((a.likelihood(strings, up).sum() - a.likelihood(strings, down).sum()) / (2 * step), abs=1e-5)


def test_toxicity(spark, none):
    rng = random.Random(4)
    clean = "the quick brown fox jumps over a lazy dog while nice people walk home".split()
    rows, labels = [], []
    for k in range(400):
        words = rng.choices(clean, k=rng.randrange(5, 60))
        toxic = k % 4 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["idiot", "1d10t", "scum", "іdiot"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, "")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, marks, bucket_of("doc_id", 5) != 0)
    assert {t for t, _ in lexicon.terms} >= {"ldlot ", "scum "}
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, lexicon).collect()}
    assert len(got) == 402 and all(0 <= s <= 1 for s in got.values()) and got[1000] == got[1001] < 0.5
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all((got[k] >= 0.5) == (k % 4 == 0) for k in held)
    assert toxicity.drop_toxic(docs, lexicon).columns == docs.columns and toxicity.drop_toxic(docs, lexicon).count() == 302
    assert toxicity.toxicity(none, lexicon).count() == 0
    clash = docs.selectExpr("doc_id", "text", "1 as _score", "2 as score", "3 as octets", "4 as OCTETS_", "5 as _bytes")
    left = toxicity.drop_toxic(clash, lexicon)
    assert left.columns == clash.columns and left.count() == 302 and left.select("_score", "score", "octets", "OCTETS_", "_bytes").distinct().collect() == [(1, 2, 3, 4, 5)]
    assert toxicity.toxicity(clash.unionByName(clash), lexicon).count() == 804
    assert toxicity.learn(docs, marks.where("false"), bucket_of("doc_id", 5) != 0).terms == ()


def test_long_words_are_terms_too(spark):
    bad = "q" * 60
    rows = [(k, f"some {bad} here" if k % 4 == 0 else "some word here") for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(80)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, marks, bucket_of("doc_id", 5) != 0)
    assert all((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in toxicity.toxicity(docs, lexicon).collect())


def test_toxicity_score_against_a_plain_search():
    """Every term at every place, without automaton: the same weight, hence the same score."""
    rng = random.Random(6)
    terms = (("bad ", 2.0), ("badly ", 1.5), ("worse", 3.0), ("wo", 0.5), ("ugly thlng ", 4.0))
    lexicon = toxicity.Lexicon(terms, ("not bad",), -3.0, (1.2, 0.7))
    m = toxicity.Matcher(lexicon)

    def plain(text):
        t = toxicity.fold(text)
        edge = lambda k: not (0 <= k < len(t) and t[k].isalnum())
        hits = lambda w, whole: {(k, k + len(w)) for k in range(len(t)) if t.startswith(w, k) and edge(k - 1) and (not whole or edge(k + len(w)))}
        found = sorted(((a, -b, w) for term, w in terms for a, b in hits(term.rstrip(), term.endswith(" "))))
        kept, upto = [], 0
        for a, b, w in found:
            if a >= upto:
                kept.append((a, -b, w))
                upto = -b
        safe = hits("not bad", True)
        weight = sum(w for a, b, w in kept if not any(x <= a and b <= y for x, y in safe))
        z = -3.0 + 1.2 * np.log1p(weight) + 0.7 * np.log1p(100 * weight / (len(text.split()) + 20))
        return 1 / (1 + np.exp(-z))

    for _ in range(300):
        text = "".join(rng.choice(["bad", "B4D", "badly", "not ", "worse", "worsen", "wo", " ", " ", ", ", "ugly thing", "x", "bаd"]) for _ in range(rng.randrange(0, 14)))
        weight, _, words = m.measure(text)
        assert m.score(weight, words) == pytest.approx(plain(text)), text


def test_phrases_take_terms_back():
    m = toxicity.Matcher(toxicity.Lexicon((("trash ", 2.0), ("vequ", 3.0)), ("trash can",)))
    assert m.measure("a trash can")[0] == 0 and m.measure("TR4SH! cans vequille")[0] == 5.0 and m.measure("trashy invequ")[0] == 0


def test_embeddings(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((40, 16))
    x = [list(map(float, base[k % 40] + rng.standard_normal(16) * (0.08 if k % 3 else 0.0))) for k in range(240)]
    odd = [None, [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [None], [1.0] * 5, [float("inf")] * 16]
    rows = [(k, v, 1) for k, v in enumerate(x + odd)] + [(None, x[0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int"), Workspace(spark, "t"), recall=1.0).collect()}
    unit = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    root = local_components(*np.nonzero(near), len(x))
    found = sum(got[k][0] for k in range(240))
    assert found >= 0.9 * near.sum() and all(got[k][0] <= near[k].sum() for k in range(240))
    assert sum(got[k][1] == root[k] for k in range(240)) >= 216
    assert all(got[k] == (0, k, True) for k in range(240, 246)) and got[None][0] == 0
    assert embeddings.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<double>"), Workspace(spark, "t")).count() == 0


@pytest.mark.parametrize("blocks", [False, True])
def test_embeddings_at_the_default_recall(spark, monkeypatch, blocks):
    """Single precision, lengths that differ, repeated ids, and crowded cells dealt in blocks: links as by brute force."""
    if blocks:
        monkeypatch.setattr(embeddings, "MEMBERS", 20)
        monkeypatch.setattr(embeddings, "QUERIES", 50)
    rng = np.random.default_rng(2)
    tables = {}
    for width, n in ((16, 900), (7, 300), (1, 5)):
        base = rng.standard_normal((n // 5, width))
        tables[width] = (base[np.arange(n) % len(base)] + rng.standard_normal((n, width)) * 0.05).astype(np.float32)
    rows, want, links, vec = [], {}, 0, 0
    for width, x in tables.items():
        unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
        near = unit @ unit.T >= 0.95
        np.fill_diagonal(near, False)
        links += near.sum()
        for k in range(len(x)):
            want[vec] = int(near[k].sum())
            rows.append((vec, x[k].tolist(), 7))
            vec += 1
    rows += [rows[3], (4, [9.0] * 16, 7)]  # the second is not the least of its id, as the first components are small
    want_rows = len(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    found = embeddings.embedding_dedup(df, Workspace(spark, "t")).collect()
    got = {r.vec_id: r.n_links for r in found}
    assert len(found) == want_rows and all(got[k] <= n for k, n in want.items()) and sum(got.values()) >= 0.9 * links
    again = embeddings.embedding_dedup(df.repartition(5), Workspace(spark, "t")).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_cells_are_ranked_as_they_are_visited():
    rng = np.random.default_rng(4)
    x = embeddings.units_of(rng.standard_normal((200, 8)))
    books = (embeddings.codebook(x[:, :4], 6), embeddings.codebook(x[:, 4:], 5))
    order = embeddings.traverse(x, books, 30)
    assert order.shape == (200, 30) and all(len(set(o)) == 30 for o in order.tolist())
    for place in (0, 3, 29):
        assert np.abs(embeddings.ranks(x, order[:, place], books) - place).max() <= 1
    assert (embeddings.traverse(x, books, 7) == order[:, :7]).all()


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 99), (99, 98), (5, 5), (None, 3)] + [(200, 300 + k) for k in range(50)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(edges, Workspace(spark, "t")).collect()}
    assert got == dict.fromkeys(range(61), 0) | dict.fromkeys((98, 99, 100), 98) | dict.fromkeys([200, *range(300, 350)], 200)
