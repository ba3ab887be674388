"""Clustering and the audit of sources against brute force, the quality classifier on held-out documents."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.llm import clustering, divergence, quality_classifier, shared

DATA = "/root/testdata/sf0.01"


# --- clustering -----------------------------------------------------------------------


def lloyd(rows, clusters, rounds, scale, seed):
    """[(id, cluster, distance)], centroids; rows are (id, components)."""
    q = [(i, tuple(int(np.floor(float(x) * scale)) for x in v)) for i, v in rows]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centre = [v for _, v in sorted(q, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centre))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in q]
        centre = [
            tuple(sum(x) // len(mine) for x in zip(*mine, strict=True)) if (mine := [v for (_, v), o in zip(q, of, strict=True) if o == k]) else c for k, c in enumerate(centre)
        ]
    return [(i, near(v)[1], near(v)[0]) for i, v in q], centre


@pytest.mark.parametrize(("seed", "size"), [(1, 0.05), (2, 1.0), (3, 3e5)])
def test_clusters_equal_brute_force(spark, seed, size):
    rnd = random.Random(seed)
    good = [(i, [rnd.gauss(0, size) for _ in range(3)]) for i in range(60)]
    good += [(1000 + i, [size / 2, -size, 0.0]) for i in range(40)]  # a hot vector
    good += [(5, good[5][1]), (5, good[6][1]), (None, good[7][1]), (None, good[8][1])]
    bad = [(70, None), (71, []), (72, [1.0, 2.0]), (73, [1.0, None, 2.0]), (74, [1.0, float("nan"), 2.0]), (75, [float("inf"), 0.0, 0.0]), (76, [0.0] * 4)]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in good + bad], "vec_id long, embedding array<double>, cluster string, q int, weight int")
    s = clustering.Settings(clusters=7, rounds=3, dims=3)
    out = clustering.cluster_vectors(df, s).collect()
    expected, centre = lloyd(good, 7, 3, 256, 2)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in out) == Counter(expected)
    for r in out:
        assert r.inertia == sum(d for _, _, d in expected)
        assert r.cluster_inertia == sum(d for _, k, d in expected if k == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centre[r.cluster])).encode()).hexdigest()


def test_jobs_dont_grow_with_partitions(spark):
    """A round's sums come back in one go, not by a job for each partition of the shuffle."""
    rnd = random.Random(4)
    df = spark.createDataFrame([(i, [rnd.gauss(0, 1) for _ in range(3)]) for i in range(200)], "vec_id long, embedding array<double>")
    held = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("rounds", "rounds")
        clustering.cluster_vectors(df, clustering.Settings(clusters=20, rounds=3, dims=3))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < len(jobs) < 30


def test_few_or_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    s = clustering.Settings(clusters=5, dims=2)
    assert clustering.cluster_vectors(spark.createDataFrame([], kind), s).count() == 0
    assert clustering.cluster_vectors(spark.createDataFrame([(1, None)], kind), s).columns == [c.split()[0] for c in clustering.SCHEMA.split(", ")]
    got = clustering.cluster_vectors(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], kind), s).collect()
    assert {(r.vec_id, r.cluster, r.distance, r.inertia) for r in got} == {(1, 0, 0, 0), (2, 0, 0, 0)}


def test_sums_beyond_64_bits():
    rows = np.array([[2**31 - 1, -(2**31)], [2**31 - 1, 5]], np.int32)
    total = clustering.weighted_sums(rows, np.array([2**40, 2**40]), np.array([1, 1]), 2)
    assert total.tolist() == [[0, 0, 0], [(2**31 - 1) * 2**41, (5 - 2**31) * 2**40, 2**41]]
    with pytest.raises(OverflowError):
        clustering.assign(np.full((1, 64), 2**31 - 1, np.int32), np.full((1, 64), -(2**31), np.int64))


# --- divergence of sources ---------------------------------------------------------------


def audited(rows, least, top):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t in df if df[t] >= least]

        def shares(of, kept=kept):
            n = Counter(t for d in of for t in d[2])
            total = sum(n[t] for t in kept)
            return {t: (1 + 1_000_000_000 * (n[t] + 5) // (total + 5 * len(kept)), n[t]) for t in kept}

        whole = shares(mine)
        sources = {s: shares([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        for s, p in sources.items():
            pairs = sorted((-sum(abs(p[t][0] - q[t][0]) for t in kept), o.encode()) for o, q in sources.items() if o != s)
            terms = sorted((whole[t][0] - p[t][0], t.encode()) for t in kept if p[t][1] and p[t][0] > whole[t][0])[:top]
            for part, ranked in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(ranked)]
    return Counter(out)


@pytest.mark.parametrize(("seed", "seats", "block"), [(1, 3, 4), (2, 8, 1000), (3, 1, 7), (4, 2, 3)])
def test_divergence_equals_brute_force(spark, seed, seats, block):
    rnd = random.Random(seed)
    words = ["the", "The", "é", "Éa", "naïve", "x1y", "日本", "don't", "Zu", "z", "ÀB", "\U0001f600a", "ab_c", "K"]
    text = lambda: " ".join(rnd.choice(words[: rnd.choice([5, 14])]) for _ in range(rnd.randrange(12)))
    rows = [(text(), rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "c", "d", "é", "ab", None])) for _ in range(120)]
    rows += [rows[0]] * 40 + [(None, "en", "only"), ("", "fr", "x"), ("q", "fr", "y"), (" 12 ", "it", "z")]
    df = spark.createDataFrame([(1, *r, "p", 7) for r in rows], "doc_id long, text string, lang string, source string, term string, n long")
    out = divergence.audit(df, least_docs=3, top=4, seats=seats, block_terms=block, block_entries=20)
    assert dict(out.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert Counter(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in out.collect()) == audited(rows, 3, 4)


def test_no_documents_to_audit(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_terms_of_long_texts_in_slices(monkeypatch):
    rnd = random.Random(4)
    text = "".join(rnd.choice("aB é日.\n") for _ in range(4000))
    whole = divergence.terms(text)
    monkeypatch.setattr(divergence, "SLICE", 7)
    assert divergence.terms(text) == whole
    assert divergence.terms("a" * 100) == {b"a" * 100: 1}
    assert divergence.terms(None) == {}


def test_every_two_seats_meet_once():
    for n in range(1, 12):
        met = sorted(tuple(sorted(x)) for away in divergence.rounds(n) for x in away.items())
        assert met == list(combinations(range(n), 2))
        for away in divergence.rounds(n):
            assert len({*away, *away.values()}) == 2 * len(away)  # a seat meets one other in a round


def test_shares_are_exact():
    n = np.array([0, 1, 10**12, 3 * 10**12])
    for total, v in ((7 * 10**12, 10**7), (2**60, 5)):
        assert divergence._shares(n, total, v).tolist() == [1 + 10**9 * (x + 5) // (total + 5 * v) for x in n.tolist()]


# --- quality classifier -------------------------------------------------------------------


def _features(texts):
    return np.concatenate([quality_classifier.features(raw, offs) for _, _, raw, offs in shared.text_chunks(pa.array(texts))])


def test_features_depend_on_their_text_alone(monkeypatch):
    rnd = random.Random(2)
    texts = ["", " ", "\n", "a", None] + ["".join(rnd.choice("aB é1.#\n") for _ in range(rnd.randrange(200))) for _ in range(60)] + ["one two " * 30, "日本 " * 9]
    together = _features(texts)
    assert together.shape == (len(texts), quality_classifier.WIDTH) and np.isfinite(together).all()
    alone = np.concatenate([_features([t]) for t in texts])
    assert np.allclose(together, alone)
    monkeypatch.setattr(shared, "CHUNK", 16)
    assert np.allclose(np.concatenate([quality_classifier.features(raw, offs) for _, _, raw, offs in shared.text_chunks(pa.array(texts), 1 << 19)]), together)


def test_the_prior_of_a_mixture():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000)
    mixed = np.append(rng.normal(2, 1, 2800), bad[:1200])
    assert abs(quality_classifier.estimated_prior(good, mixed) - 0.7) < 0.06
    assert quality_classifier.estimated_prior(good, good) > 0.95


def test_scores_do_not_depend_on_the_rows_beside():
    rng = np.random.default_rng(3)
    layers = (rng.standard_normal((158, 32)), rng.standard_normal(32), rng.standard_normal(32) / 9, rng.standard_normal(1))
    model, x = quality_classifier.Model(np.zeros(158), np.ones(158), layers, 0.5), np.repeat(rng.standard_normal((7, 158)), 31, axis=0)
    want = model.scores(x[:1])[0]
    for n in (*range(1, 40), len(x)):
        got = model.scores(x[:n])
        assert (got[: min(n, 31)] == want).all()


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    texts = dict(docs.select("doc_id", "text").collect())
    odd = docs.select("doc_id", "text", F.lit("x").alias("good"), F.lit(1).alias("h"), F.lit(2).alias("quality"), F.lit(0).alias("score"))
    more = spark.createDataFrame([(None, "Some text."), (None, None), (5_000_001, ""), (5_000_002, None), (3, texts[3]), (5_000_003, "### $$$ " * 200_000)], "doc_id long, text string")
    odd = odd.unionByName(more.select("*", *[F.lit(None).cast(t).alias(c) for c, t in odd.dtypes[2:]]))
    # labels that are held out, unknown or null change nothing; an id stated twice is bad if one says so
    noise = spark.createDataFrame([(k, 0, 1) for k in texts if held(k)] + [(None, 1, 0), (9_999_999, 1, 0), (1, None, None)], labels.schema)
    model = quality_classifier.fit(odd.unionByName(odd.where("doc_id = 3")), labels.where(~quality_classifier.held_out()).unionByName(noise))
    out = quality_classifier.score(odd, model)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.collect()
    assert len(rows) == len(texts) + 6
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id)) for r in rows)
    got = {r.doc_id: r for r in rows}
    assert got[5_000_003].predicted == 0 and got[5_000_001].score == got[5_000_002].score
    truth = {r.doc_id: r.quality for r in labels.collect() if held(r.doc_id)}
    assert sum(got[k].predicted == y for k, y in truth.items()) >= 0.95 * len(truth)
    low, high = ([got[k].score for k, y in truth.items() if y == x] for x in (0, 1))
    assert sum(a < b for a in low for b in high) >= 0.97 * len(low) * len(high)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_classifier.fit(docs, none) is None
    assert quality_classifier.fit(docs.limit(0), spark.createDataFrame([(1, 1, 0)], none.schema)) is None
    assert [r.score for r in quality_classifier.score(docs, None).collect()] == [0.5, 0.5]
    assert quality_classifier.score(docs.limit(0), None).count() == 0
    one = quality_classifier.fit(docs, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], none.schema))
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(docs, one).collect())
