import hashlib
import random
import re

import pytest

from flickmill.llm import registry, substrings

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def brute(docs, n=50):
    words = {d: WORD.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        w = words[d]
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i:i + n]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < d:
                gone.update(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()}


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert any(v[1] for v in want.values())
    assert got(registry.QUERIES["op4_substring_dedup"](spark, sf_dir)) == want


@pytest.mark.parametrize("window,base", [(8, 4), (8, 2), (16, 2)])
def test_levels(spark, window, base):
    rnd = random.Random(window)
    passages = [[rnd.choice("abcdé") for _ in range(rnd.choice([7, 8, 9, 15, 16, 30]))] for _ in range(6)]
    docs = []
    for k in range(60):
        w = []
        for _ in range(rnd.choice([0, 1, 4])):
            w += rnd.choice(passages) + [f"q{rnd.randrange(3)}" for _ in range(rnd.choice([0, 1, 5]))]
        docs.append((k, " ".join(w)))
    docs += [(60, None), (61, ""), (62, "a " * 20_000), (63, "a " * 300)]
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, places string")
    assert got(substrings.deduplicated(df, window, base)) == brute(docs, window)


def test_edge_cases(spark):
    text = " ".join(str(i) for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (2, text + " end"), (None, text)], "doc_id long, text string")
    rows = sorted(((r.doc_id is None, r.doc_id), r.n_removed, r.kept_text) for r in substrings.deduplicated(df).collect())
    assert rows == [((False, 1), 0, text), ((False, 1), 0, text), ((False, 2), 60, "end"), ((True, None), 0, text)]
    assert substrings.deduplicated(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substrings.deduplicated(df, 50, 20)
