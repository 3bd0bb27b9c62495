import random
import re

from flickmill.llm import jaccard, registry

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(docs, n=5):
    """doc_id -> (class_id, copy_id, n_copies, n_links), over all pairs of documents."""
    sets = {d: shingles(t, n) for d, t in docs}
    ids = sorted(sets)
    near = {d: [] for d in ids}
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 5 >= max(len(x), len(y)) * 4:
                both = len(x & y)
                if both * 5 >= (len(x) + len(y) - both) * 4:
                    near[a].append(b)
                    near[b].append(a)
    out = {}
    for d in ids:
        seen, todo = {d}, [d]
        while todo:
            new = [x for x in near[todo.pop()] if x not in seen]
            seen.update(new)
            todo += new
        same = [x for x in near[d] if sets[x] == sets[d]] + [d]
        out[d] = (min(seen), min(same), len(same), len(near[d]))
    return out


def got(df):
    return {r.doc_id: (r.class_id, r.copy_id, r.n_copies, r.n_links) for r in df.collect()}


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(registry.QUERIES["op1_ngram_jaccard_join"](spark, sf_dir)) == brute(docs)


def test_large_groups_of_copies_and_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(4000)}" for _ in range(150)]
    docs = [(k, " ".join(base)) for k in range(40)]
    for k in range(40, 120):
        words = list(base)
        for _ in range(rnd.choice([1, 1, 2, 3, 6])):
            words[rnd.randrange(150)] = f"x{rnd.randrange(999)}"
        docs.append((k, " ".join(words)))
    docs += [(k, " ".join(f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([1, 3, 30])))) for k in range(120, 200)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, rep long")
    assert got(jaccard.near_duplicates(df)) == brute(docs)


def test_a_passage_that_many_share_is_split_until_few_are_left(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FEW", 4)
    rnd = random.Random(6)
    words = lambda n: [f"w{rnd.randrange(9000)}" for _ in range(n)]
    passage, docs = words(30), []
    for k in range(60):
        own = passage + words(60)
        near = list(own)
        near[-1] = near[70] = "x"
        docs += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(near))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(jaccard.near_duplicates(df)) == brute(docs)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "a"), (6, "b c"), (7, "x " * 40_000), (8, "x " * 30_000)]
    df = spark.createDataFrame(docs + [(None, "a")], "doc_id long, text string")
    want = brute(docs)
    result = jaccard.near_duplicates(df).collect()
    assert {r.doc_id: (r.class_id, r.copy_id, r.n_copies, r.n_links) for r in result if r.doc_id is not None} == want
    assert [tuple(r) for r in result if r.doc_id is None] == [(None, None, None, 1, 0)]
    kept = jaccard.first_of_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "7", "None"]
    assert jaccard.near_duplicates(df.limit(0)).count() == 0
    assert jaccard.first_of_each(df.limit(0)).count() == 0


def test_repeated_rows_stay_once(spark):
    rows = [(1, "a b c d e f")] * 50 + [(2, "a b c d e f")] * 3 + [(3, None)] * 2 + [(4, "")] * 2 + [(5, "other words")] + [(None, "a b")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = jaccard.first_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((str(r.doc_id), r.text) for r in kept.collect()), key=str) == sorted(
        [("1", "a b c d e f"), ("3", None), ("4", ""), ("5", "other words"), ("None", "a b"), ("None", "a b")], key=str)
