"""The corpus pipeline's stages against plain versions, on a table with nulls, empty and repeated rows, ties and clashing columns."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from sluice.llm import mixing, subword, toxicity
from sluice.llm.common import LOWER, Workspace, bucket_of, local_components

CLASH = ["_id", "_sha", "_key", "_n", "_row", "_times", "_time", "_score", "_bytes", "row_key", "times", "time", "KEY", "kept_id", "kept_sha", "nth", "octets", "score", "id", "first", "size", "taken", "component_id", "fingerprint"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASH)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri") for b in ("ra", "so", "ti", "vu", "xe", "zo", "n", "st")]
    texts = [" ".join(rng.choices(words, k=rng.randrange(30, 120))) for _ in range(60)]
    texts += [t.replace("kara", "kära") for t in texts[:10]] + [t + " tail" for t in texts[10:30]] + [t.upper() for t in texts[30:34]]
    texts += rng.choices(texts, k=25) + [None, "", "", " \n ", "one", "x" * 30_000, "漢字" * 9_000]
    texts += [" ".join([*rng.choices(words, k=20), rng.choice(("scumbag", "1diot", "іdiot"))]) for _ in range(24)]
    out = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(out)
    return [*out, out[0], out[1], out[1], (out[2][0], "another text under an id that is taken " * 3), (None, "a text without id " * 5), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", ["s1", "s2", None][k % 3], 5, *[k % 7] * len(CLASH)) for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def sf_dir(spark, docs, rows, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('sf')}"
    docs.repartition(3).write.parquet(f"{at}/documents.parquet")
    bad = lambda t: int(any(w in (t or "") for w in ("scumbag", "diot")))
    marks = [(i, 0, bad(t)) for i, t in rows if i is not None]
    spark.createDataFrame([*marks, (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_toxicity_stage(spark, docs, rows, sf_dir):
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), bucket_of("doc_id", 5) != 0)
    m = toxicity.Matcher(lexicon)

    def score(t):
        weight, _, n = m.measure(t or "")
        return m.score(weight, n)

    left = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert left.columns == docs.columns and pairs(left) == Counter((i, t) for i, t in rows if score(t) < 0.5)
    assert Counter(map(str, left.collect())) <= Counter(map(str, docs.collect())) and not any("diot" in (r.text or "") or "scumbag" in (r.text or "") for r in left.collect())
    assert sum(pairs(left).values()) == sum("diot" not in (t or "") and "scumbag" not in (t or "") for _, t in rows)


def test_exact_stage(spark, docs, rows, sf_dir):
    keep = {}
    for i, t in rows:
        keep[t or ""] = max(keep.get(t or "", -1), -1 if i is None else i)
    left = corpus_pipeline.exact_dedup(spark, docs, sf_dir)
    assert left.columns == docs.columns
    got = left.collect()
    assert Counter((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in got) == Counter((i, t) for t, i in keep.items())
    assert sorted(map(str, got)) == sorted(map(str, corpus_pipeline.exact_dedup(spark, docs.repartition(5), sf_dir).collect()))


def fingerprint(t):
    w = (t or "").encode().translate(LOWER).split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_stage(spark, docs, rows, sf_dir):
    own = list(set((i, t or "") for i, t in rows))
    fps = [fingerprint(t) for _, t in own]
    root = local_components(*np.nonzero([[(x ^ y).bit_count() <= 3 for y in fps] for x in fps]), len(fps))
    groups = defaultdict(list)
    for k, r in enumerate(root.tolist()):
        groups[r].append(own[k])
    got = defaultdict(set)
    left = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert left.columns == docs.columns
    of = {row: root[k] for k, row in enumerate(own)}
    for r in left.collect():
        got[of[r.doc_id, r.text or ""]].add((r.doc_id, r.text or ""))
    assert got.keys() == groups.keys() and all(len(v) == 1 for v in got.values())  # one document of each group, and no group lost
    order = lambda i: (i is None, i or 0)
    assert all(order(next(iter(got[g]))[0]) == min(order(i) for i, _ in members) for g, members in groups.items())


def test_mixing_stage(spark, docs, rows, sf_dir):
    left = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    assert left.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in left.collect())
    # The mix of rows told apart by number says how often each is taken.
    size = lambda t: len((t or "").encode().split())
    had = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    assert set(got) <= set(had) and all(n <= 2 * had[k] for k, n in got.items()) and all(size(k[1]) for k in got)
    whole = mixing.mix(docs, Workspace(spark, "t")).collect()
    goals, sums = {r.source: r.target for r in whole}, Counter()
    for (_, t, s), n in got.items():
        sums[s] += n * size(t)
    largest = max(size(t) for _, t in rows)
    assert all(abs(sums[s] - goal) <= 2 * largest + 6 * mixing.BLOCK for s, goal in goals.items())
    assert got == Counter((r.doc_id, r.text, r.source) for r in corpus_pipeline.mix_sources(spark, docs.repartition(2), sf_dir).collect())


def test_run_is_its_stages_one_after_another(spark, docs, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
    coder = subword.Encoder(subword.load())
    want = Counter()
    for r in now.select("doc_id", "text").collect():
        ids = coder.encode([(r.text or "").encode()])[0]
        want[r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), True] += 1
    assert Counter((r.doc_id, r.n_ids, r.ids_sha256, r.round_trip) for r in got) == want and len(got)
    assert all(len(r.ids) == r.n_ids for r in got)


def test_empty_tables(spark, docs, sf_dir):
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0
