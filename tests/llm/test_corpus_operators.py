"""Importance resampling, language model and centroid clustering against plain Python; whole rows in
the pipeline; long pseudonyms."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spendmart.llm import hmm, importance, neardup, pseudonyms, vptree
from spendmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(shipped):
    return shipped.read.parquet(f"{SF}/documents.parquet")


# --- 1: values of any length


def test_long_values_are_permuted_whole():
    there, back = pseudonyms.Permuter(b"k"), pseudonyms.Permuter(b"k", inverse=True)
    for n in (1, 47, 48, 49, 200, 7_000):
        value = ("Ab0.cdE9-" * n)[:n]
        made = there.characters("email", value)
        assert back.characters("email", made) == value
        assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", made))) == re.sub(
            "[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", value))
        )
    one, other = (there.characters("email", "a" * 4_000 + end) for end in "bc")
    # a difference anywhere moves all: about one in 26 letters agrees by chance
    assert sum(x == y for x, y in zip(one, other)) < 300
    assert sum(x == "a" for x in one) < 300


def test_a_megabyte_that_looks_like_an_email(shipped):
    text = "write to " + "ab1." * 250_000 + "x@" + "host-" * 2_000 + "s.example.com please"
    rows = shipped.createDataFrame([(1, text, "kept"), (2, None, "kept")], "doc_id bigint, text string, found string")
    made = {r["doc_id"]: r for r in pseudonyms.with_pseudonyms(rows, b"k").collect()}
    assert made[1]["found"] == "kept" and made[2]["text"] is None
    new = made[1]["text"]
    assert len(new) == len(text) and new.endswith(".com please") and new[:9] == "write to "
    assert sum(x == y and x.isalnum() for x, y in zip(new[9:], text[9:])) < 0.12 * len(text)
    assert pseudonyms.pseudonymize(new, pseudonyms.Permuter(b"k", inverse=True))[0] == text


# --- 10 in the pipeline


def test_only_confirmed_rows_go(shipped):
    words = lambda name, n=30: " ".join(f"{name}{i}" for i in range(n))
    rows = [
        (1, words("alpha"), "a"), (2, words("alpha"), "b"),  # copies
        (3, words("beta"), "c"), (3, words("gamma"), "d"), (3, words("beta"), "e"), (3, words("beta"), "c"),  # one id
        (4, words("gamma") + " more", "f"), (5, words("beta") + " more", "g"),
        (None, words("delta"), "h"), (None, words("delta"), "i"), (None, words("alpha"), "j"), (None, None, "k"), (None, "", "l"),
        (6, words("epsilon"), "m"), (2**63 - 1, None, "n"), (2**63 - 1, "", "o"),
    ]
    docs = shipped.createDataFrame(rows, "doc_id bigint, text string, _node string")
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], (r["text"] or "")[:5], r["text"] is None) for r in kept.collect())
    # by smallest id, 3 for beta and for gamma; unlike texts of one id, or of none, are all there
    assert got == Counter(
        [
            (1, "alpha", False), (3, "gamma", False), (3, "beta0", False), (6, "epsil", False), (None, "delta", False),
            (None, "", True), (None, "", False), (2**63 - 1, "", True), (2**63 - 1, "", False),
        ]
    )
    smaller = docs.where(f"doc_id is null or doc_id < {2**63 - 1}")
    assert Counter((r["doc_id"], r["text"]) for r in neardup.without_near_duplicates(smaller).collect()) == Counter(
        (r["doc_id"], r["text"]) for r in kept.where(f"doc_id is null or doc_id < {2**63 - 1}").collect()
    )
    assert neardup.without_near_duplicates(docs.where("false")).count() == 0


def test_unlike_texts_of_one_id_reach_packing(spark, docs):
    good = [r["text"] for r in corpus_pipeline.keep_good(spark, docs, SF).orderBy("doc_id").limit(2).collect()]
    rows = [(7_000_001, text, "en", "web", len(text)) for text in good]
    twin = spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source", "n_chars").schema)
    # words of their own, so that they repeat nothing of the corpus
    twin = twin.withColumn("text", F.regexp_replace("text", "([A-Za-z]{4,})", "$1q")).select(*docs.columns)
    kept = corpus_pipeline.keep_one_of_each(spark, docs.unionByName(twin), SF).where("doc_id = 7000001")
    assert {r["text"] for r in kept.collect()} == {r["text"] for r in twin.collect()}
    left = corpus_pipeline.hide_personal_data(spark, kept, SF)
    packed = corpus_pipeline.pack_sequences(spark, left, SF)
    assert packed.where("doc_id = 7000001 and start = 0").count() == 2


def test_the_key_can_be_set(spark, docs):
    some = spark.createDataFrame([(1, "mail ab.cd@example.com", "en", "web", 1)], docs.schema)
    plain = corpus_pipeline.hide_personal_data(spark, some, SF).first()["text"]
    spark.conf.set(corpus_pipeline.KEY_SETTING, "my own")
    try:
        assert corpus_pipeline.hide_personal_data(spark, some, SF).first()["text"] != plain
    finally:
        spark.conf.unset(corpus_pipeline.KEY_SETTING)


# --- 11: importance resampling


def plain_resample(docs, target, lengths, buckets, percent, least, seed):
    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", small(text))
        return len(w), [crc32(" ".join(w[i : i + n]).encode()) % buckets for n in lengths for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    found = [(i, *features(text)) for i, text in docs]
    for _, _, f in found:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for i, n_words, f in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n_words >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(able) // 100
    ranked = [(*r[:4], n if n <= drawn else None) for n, r in enumerate(able, 1)]
    return Counter(ranked + [(*r[:4], None) for r in out if not r[4]])


@pytest.mark.parametrize(("lengths", "buckets"), [(range(1, 2), 10_000), (range(1, 4), 500), (range(2, 3), 70_000)])
def test_resampling_equals_plain_python(docs, odd_docs, shipped, monkeypatch, lengths, buckets):
    bench = shipped.read.parquet(f"{SF}/benchmark.parquet")
    both = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    got = importance.resampled(both, bench, lengths=lengths, buckets=buckets, percent=30)
    want = plain_resample(
        [tuple(r) for r in both.collect()], [r["text"] for r in bench.select("text").collect()], lengths, buckets, 30, 20, 2024
    )
    assert Counter(tuple(r) for r in got.collect()) == want


def test_long_texts_in_pieces_have_the_same_features(monkeypatch):
    text = ("Some words, ünïcode and 12 numbers; " * 500).encode()
    features = importance.Features(range(1, 4), 1000)
    n_words, whole = features.of([text])[0]
    monkeypatch.setattr(importance, "PIECE", 100)
    assert features.of_long(text)[0] == n_words
    assert sorted(np.frombuffer(features.of_long(text)[1], np.uint16)) == sorted(np.frombuffer(whole, np.uint16))


def test_shifted_crcs_cancel():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 255, 256, 70_000):
        a, b = rng.bytes(9), rng.bytes(n)
        moved = importance.shifted(np.array([crc32(a)], np.uint32), np.array([n]))[0]
        assert int(moved) ^ crc32(b) == crc32(a + b)


def test_resampling_of_empty_tables(docs, no_docs, shipped):
    nothing = shipped.createDataFrame([], "text string")
    assert importance.resampled(no_docs, nothing).count() == 0
    out = importance.resampled(docs, nothing)
    assert out.count() == docs.count() and out.where("rank is not null").count() > 0


# --- 12: hidden Markov model


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", small(text)), None]


def test_base_scores_equal_plain_python(docs, odd_docs):
    both = docs.select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text", "judged").drop("judged"))
    held = lambda i: crc32(b"" if i is None else str(i).encode()) % 7 == 2
    rows = [tuple(r) for r in both.collect()]
    seen = Counter(w for i, text in rows if not held(i) for w in tokens(text))
    n, v = sum(seen.values()), len(seen)
    want = Counter()
    for i, text in rows:
        w = tokens(text)
        base = sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in w)
        want[(i, held(i), len(w), sum(x in seen for x in w), n, round(base, 5))] += 1
    got = hmm.scored(both, rounds=2).collect()
    assert Counter((*r[:5], round(r["base_score"], 5)) for r in got) == want
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_held_out_texts_are_likelier_than_by_single_words(docs):
    got = hmm.scored(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (got[0] - got[1]) / got[2] > 0.03  # log10 a token, of 200 texts


def plain_forward(model, text):
    """log10 probability and posterior sums of one text, unscaled, over all paths."""
    start, step, emit = model.start, model.step, model.emit
    alpha = [start * emit[text[0]]]
    for s in text[1:]:
        alpha.append((alpha[-1] @ step) * emit[s])
    beta = [np.ones(len(start))]
    for s in reversed(text[1:]):
        beta.insert(0, step @ (emit[s] * beta[0]))
    total = alpha[-1].sum()
    gamma = [a * b / total for a, b in zip(alpha, beta)]
    pairs = sum((np.outer(a, emit[s] * b) * step / total for a, s, b in zip(alpha, text[1:], beta[1:])), np.zeros_like(step))
    return math.log10(total), gamma, pairs


@pytest.mark.parametrize("cells", [1, 40, 1 << 18])
def test_recursions_equal_plain_ones(monkeypatch, cells):
    monkeypatch.setattr(hmm, "CELLS", cells)
    rng = np.random.default_rng(4)
    model = hmm.Model.begin(rng.random(12) + 0.1, 3, 5)
    texts = [rng.integers(0, 12, n).astype(np.uint16) for n in (1, 5, 60, 2, 60, 33, 1)]
    sweep = hmm.Sweep(texts)
    plain = [plain_forward(model, t) for t in texts]
    assert np.allclose(sweep.likelihoods(model), [p[0] for p in plain])
    emitted = np.zeros_like(model.emit)
    start, step = sweep.expected(model, emitted)
    assert np.allclose(start, sum(p[1][0] for p in plain)) and np.allclose(step, sum(p[2] for p in plain))
    wanted = np.zeros_like(emitted)
    for text, (_, gamma, _) in zip(texts, plain):
        for s, g in zip(text, gamma):
            wanted[s] += g
    assert np.allclose(emitted, wanted)


def test_likelihoods_add_up_to_one():
    model = hmm.Model.begin(np.array([3.0, 2.0, 1.0]), 2, 1)
    every = [np.array(s, np.uint16) for s in np.ndindex(3, 3, 3, 3)]
    assert abs((10 ** hmm.Sweep(every).likelihoods(model)).sum() - 1) < 1e-9


def test_rounds_raise_the_likelihood(shipped):
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * j) % 17}" for j in range(40))) for i in range(60)]
    docs = shipped.createDataFrame(rows, "doc_id bigint, text string")
    total = lambda r: hmm.scored(docs, states=2, rounds=r, smooth=1.0).where("not held_out").agg(F.sum("score")).first()[0]
    few, more = total(1), total(8)
    assert more > few


def test_uncommon_words_are_counted_by_the_join(shipped, docs, monkeypatch):
    want = sorted(map(tuple, hmm.scored(docs, rounds=1).select("doc_id", "n_known", F.round("base_score", 6)).collect()))
    monkeypatch.setattr(hmm, "COMMON", 100)
    assert sorted(map(tuple, hmm.scored(docs, rounds=1).select("doc_id", "n_known", F.round("base_score", 6)).collect())) == want


def test_language_model_of_nothing(no_docs, shipped):
    assert hmm.scored(no_docs).count() == 0
    # a single text that is held out: nothing to learn from
    i = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    row = hmm.scored(shipped.createDataFrame([(i, "a b")], "doc_id bigint, text string")).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (True, 3, 0, 0, 0.0)
    assert np.isfinite(row["score"])


# --- 13: centroids


def plain_clusters(rows, size, scale, k, rounds, seed):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: name(r[0]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(x) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, d, n in found)


ODD_VECTORS = [(900, None), (901, []), (902, [1.0] * 3), (903, [None, 1.0, 1.0, 1.0]), (904, [float("nan")] * 4), (905, [float("inf")] * 4)]


def test_clusters_equal_plain_python(shipped):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, [0.5] * 4), (300, [0.0] * 4), (301, [-0.0] * 4), *ODD_VECTORS]
    rows += [(400 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]  # ties and empty clusters
    vectors = shipped.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("cluster", F.lit("x"))
    for k, rounds in ((25, 3), (1, 2), (3, 0)):
        got = vptree.clustered(vectors, size=4, scale=16, k=k, rounds=rounds)
        assert Counter(map(tuple, got.collect())) == plain_clusters(rows, 4, 16, k, rounds, 2)


def test_tree_finds_the_nearest_with_ties():
    rng = np.random.default_rng(3)
    for k in (1, 2, 5, 40, 300):
        centroids = rng.integers(-3, 3, (k, 3))
        vectors = rng.integers(-4, 4, (500, 3))
        number, best, taken = vptree.Tree.over(centroids).nearest(vectors)
        every = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
        assert (number == every.argmin(1)).all() and (best == every.min(1)).all()
    # in few dimensions most centroids are never looked at
    assert taken < 0.5 * 500 * 300


def test_extreme_components_and_few_vectors(shipped):
    rows = [(1, [1e300, -1e300, 0.0, 1.0]), (2, [0.0] * 4)]
    got = vptree.clustered(shipped.createDataFrame(rows, "vec_id bigint, embedding array<double>"), size=4, k=5, rounds=2).collect()
    assert sorted(r["distance"] for r in got) == [0, 0] and len({r["cluster"] for r in got}) == 2
    one = vptree.clustered(shipped.createDataFrame(rows, "vec_id bigint, embedding array<double>"), size=4, k=1, rounds=0).collect()
    assert sorted(r["distance"] for r in one)[1] == 2 * vptree.LARGEST**2 + 256**2


def test_no_vectors(shipped):
    for rows in ([], ODD_VECTORS):
        vectors = shipped.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        assert vptree.clustered(vectors).count() == 0


def test_queries_return_the_contract(spark):
    assert QUERIES["op12_hidden_markov"](spark, SF).columns == [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    ]
