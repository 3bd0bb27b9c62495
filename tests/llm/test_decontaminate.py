import hashlib
import random
import re

from flickmill.llm import decontaminate, registry


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", low)


def brute(docs, items, window=10):
    grams = {}
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    lengths = {len(g) for g in grams}
    out = {}
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in registry.QUERIES["op7_benchmark_decontamination"](spark, sf_dir).collect()}
    assert got == brute(docs, items)
    assert any(v[4] for v in got.values())


def fixture(spark):
    rnd = random.Random(3)
    vocabulary = ["a", "b", "C", "é", "7"]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    docs = [(k, text(rnd.choice([0, 1, 3, 9, 12, 300, 700]))) for k in range(40)] + [(40, None), (41, ""), (42, "!?"), (43, "x" * 50_000 + " a B c")]
    items = [(k, text(rnd.choice([0, 2, 5, 6, 10, 14]))) for k in range(12)] + [(20, None), (21, "A-b,C"), (21, "é 7 é 7 é"), (22, "A-b,C")]
    return docs, items


def test_against_brute_force_in_one_and_many_blocks(spark, monkeypatch):
    docs, items = fixture(spark)
    d = spark.createDataFrame([(*x, "z") for x in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 6)
    for most in (10**6, 60):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", most)
        got = decontaminate.contamination(d, b, window=6, keep=["doc_id"]).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
        assert all(sum(y - x for x, y in r.hit_spans) == r.n_hit and len(r.items) == r.n_items for r in got)
        clean = decontaminate.decontaminated(d, b, window=6)
        assert clean.columns == d.columns
        assert {r.doc_id for r in clean.collect()} == {k for k, v in want.items() if not v[4]}


def test_empty_tables(spark):
    docs, items = fixture(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(d.limit(0), b).count() == 0
    assert decontaminate.contamination(d, b.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(d.union(d), b).count() == 2 * len(docs)
