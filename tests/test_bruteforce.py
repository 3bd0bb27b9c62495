"""The scale-minded operators against brute force on small random fixtures."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flickmill.operators import online, search, similarity

VOCAB = ["a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k", "l"]


def _docs(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    for mid in range(n):
        k = rnd.randint(1, 5)
        words = [rnd.choice(VOCAB[: rnd.randint(3, len(VOCAB))]) for _ in range(k)]
        rows.append((mid, f"m{mid}", "|".join(words)))
    return rows


def _brute_cosine(rows, theta):
    n = len(rows)
    toks = {m: g.lower().replace("|", " ").split(" ") for m, _, g in rows}
    df = {}
    for m, ts in toks.items():
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    vec = {}
    for m, ts in toks.items():
        v = {}
        for t in ts:
            v[t] = v.get(t, 0) + 1
        vec[m] = {t: c * math.log((n + 1) / (df[t] + 1)) for t, c in v.items()}
        vec[m] = {t: w for t, w in vec[m].items() if w != 0}
    out = {}
    for a, b in itertools.permutations(vec, 2):
        va, vb = vec[a], vec[b]
        na = math.sqrt(sum(w * w for w in va.values()))
        nb = math.sqrt(sum(w * w for w in vb.values()))
        if na == 0 or nb == 0:
            continue
        s = round(sum(w * vb.get(t, 0.0) for t, w in va.items()) / (na * nb), 9)
        if s > theta:
            out[(a, b)] = s
    return out


@pytest.mark.parametrize("seed,theta", [(1, 0.6), (2, 0.3), (3, 0.8), (4, 0.1)])
def test_prefix_filtered_cosine_is_exact(spark, seed, theta):
    rows = _docs(seed)
    items = spark.createDataFrame(rows, "mid int, name string, genres string")
    got = {(r.m1, r.m2): r.sim for r in similarity.item_similarity_content(items, theta).collect()}
    want = _brute_cosine(rows, theta)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=2e-9)


def test_similarity_properties(spark):
    items = spark.createDataFrame(_docs(9), "mid int, name string, genres string")
    e = similarity.item_similarity_content(items, 0.2).collect()
    d = {(r.m1, r.m2): r.sim for r in e}
    assert all(a != b for a, b in d)
    assert all(-1 <= s <= 1.0000001 for s in d.values())
    assert all(d[(b, a)] == s for (a, b), s in d.items())


def test_dense_blocks_equal_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(70, 8))
    rows = [(i, [float(v) for v in x[i]]) for i in range(70)]
    vec = spark.createDataFrame(rows, "mid int, features array<double>")
    got = {(r.m1, r.m2): r.sim for r in similarity.item_similarity_latent(vec, 0.3, block_size=16).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    want = {(i, j): s[i, j] for i in range(70) for j in range(70) if i != j and s[i, j] > 0.3}
    assert set(got) == set(want)


def test_fuzzy_join_equals_brute_force(spark):
    rnd = random.Random(3)
    letters = "abcde"
    vocab = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(150)})
    terms = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(30)})

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]

    def k(t):
        return 0 if len(t) <= 2 else 1 if len(t) <= 5 else 2

    want = {(t, v) for t in terms for v in vocab if lev(t, v) <= k(t)}
    v = spark.createDataFrame([(x,) for x in vocab], "token string")
    q = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "qid int, term string")
    got = {(r.term, r.token) for r in search.fuzzy_matches(v, q).collect()}
    assert got == want


def test_candidates_never_seen_and_lists_bounded(spark, sf_dir):
    from flickmill.sources import adapters as ad
    ratings = ad.ratings(spark, sf_dir)
    sims = similarity.content_similarity(ad.content_items(spark, sf_dir), 0.6)
    recent = online.recent_k_ratings(ratings, 20)
    anchors = recent.where("rank = 1").select("uid", F.col("mid").alias("anchor"))
    cands = online.unseen_similar(anchors, sims, ratings, 20)
    assert cands.join(ratings, ["uid", "mid"]).count() == 0
    assert cands.groupBy("uid").count().where("count > 20").count() == 0
    out = online.stream_recs_batch(ratings, sims).toPandas().sort_values(["uid", "rank"])
    for _, g in out.groupby("uid"):
        assert list(g["score"]) == sorted(g["score"], reverse=True)


def test_member_bound_is_exact(spark):
    """Large groups of identical items: the bound on places gives the same candidates as all edges."""
    rnd = random.Random(11)
    rows = [(m, f"m{m}", "x|y" if m < 60 else ("x|z" if m < 90 else "w|q|x")) for m in range(120)]
    items = spark.createDataFrame(rows, "mid int, name string, genres string")
    sims = similarity.content_similarity(items, 0.1)
    rat = [(u, m, 3.0, i) for u in range(12) for i, m in enumerate(rnd.sample(range(120), rnd.randint(1, 6)))]
    ratings = spark.createDataFrame(rat, "uid int, mid int, score double, timestamp int")
    anchors = online.latest_anchor(ratings)
    bounded = sorted(tuple(r) for r in online.unseen_similar(anchors, sims, ratings, 5)
                     .select("uid", "anchor", "rank", "mid", "sim").collect())
    rated = {}
    for u, m, _, _ in rat:
        rated.setdefault(u, set()).add(m)
    edges = {}
    for m1, m2, s in sims.edges().collect():
        edges.setdefault(m1, []).append((-s, m2))
    full = []
    for u, anchor in anchors.collect():
        best = sorted(e for e in edges.get(anchor, []) if e[1] not in rated[u])[:5]
        full += [(u, anchor, i + 1, m, -s) for i, (s, m) in enumerate(best)]
    full.sort()
    assert bounded == full and len(full) > 0
