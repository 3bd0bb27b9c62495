import numpy as np
from pyspark.sql import functions as F

from flickmill.llm import neighbours, registry


def brute(rows, asked, k=5):
    rows = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for n, i in enumerate(ids):
        if asked(i):
            s = np.round(x @ x[n], 12)
            order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
            out[int(i)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, want):
    return sum(len({a for a, _ in v} & {a for a, _ in found.get(q, [])}) for q, v in want.items()) / sum(map(len, want.values()))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, lambda i: i % 50 == 0)
    found = got(registry.QUERIES["op3_nearest_neighbours"](spark, sf_dir))
    assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
    print("recall", recall(found, want))
    assert recall(found, want) >= 0.9
    scores = {q: dict(v) for q, v in want.items()}
    assert all(abs(s - scores[q].get(i, s)) < 1e-9 for q, v in found.items() for i, s in v)


def test_copies_ties_and_bad_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rnd = np.random.default_rng(1)
    one = [1.0, 2.0, 3.0]
    rows = [(i, one) for i in range(0, 60)] + [(i, [float(v) for v in rnd.normal(size=3)]) for i in range(60, 130)]
    bad = [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 2.0]), (204, [float("nan"), 1.0, 1.0]), (None, one), (205, [float("inf"), 1.0, 1.0])]
    df = spark.createDataFrame([(*r, "z") for r in rows + bad + rows[:3]], "vec_id long, embedding array<double>, entry string")
    found = got(neighbours.nearest(df, F.expr("vec_id % 2 = 0"), leaf_rows=8, probes=400))
    want = brute(rows, lambda i: i % 2 == 0)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert got(neighbours.nearest(df, F.expr("vec_id % 50 = 0"))) == {0: [(1, 0.0)]}
    assert neighbours.nearest(df.limit(0), F.expr("true")).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0"), F.expr("true")).count() == 0


def test_leaves_visited_grow_until_the_nearest_are_found(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rnd.normal(size=(6_000, 32)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen, real = [], neighbours.enough_probes

    def enough(entries, trees, *rest):
        seen.append((real(entries, trees, *rest), sum(t.leaves for t in trees)))
        return seen[-1][0]

    monkeypatch.setattr(neighbours, "enough_probes", enough)
    found = got(neighbours.nearest(df, F.expr("vec_id % 50 = 0"), leaf_rows=16))
    want = brute(rows, lambda i: i % 50 == 0)
    (probes, leaves), = seen
    print("recall", recall(found, want), "leaves", probes, "of", leaves)
    assert recall(found, want) >= 0.99
    assert neighbours.LEAST < probes and probes * 4 < leaves


def test_order_of_leaves_is_that_of_the_search():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(500, 8))
    trees = [neighbours.Tree(x, 6, rnd) for _ in range(3)]
    margins = [t.margins_of(x[:20]) for t in trees]
    for n in range(20):
        visits = neighbours.search_leaves(trees, x[n], 10**6)
        order = [margins[t][n, leaf] for t, leaf in visits]
        assert order == sorted(order) and len(set(visits)) == sum(t.leaves for t in trees)
