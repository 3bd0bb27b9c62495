import math
import zlib

import numpy as np
import pytest

from flickmill.llm import registry, toxicity


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        rank[score == v] = rank[score == v].mean()
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def test_query_on_the_held_out_fold(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = registry.QUERIES["op12_toxicity"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    some = [(r.score, labels[r.doc_id], r.predicted, r.flagged) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    s, y, p, f = (np.array(c) for c in zip(*some))
    print("held out", len(s), "auc", auc(s, y), "caught", p[y == 1].mean(), "clean kept", 1 - p[y == 0].mean(), "by language", f[y == 1].mean(), 1 - f[y == 0].mean())
    assert auc(s, y) > 0.97
    assert p[y == 1].mean() > 0.85 and 1 - p[y == 0].mean() > 0.97
    assert f[y == 1].mean() > 0.85 and 1 - f[y == 0].mean() > 0.95


def words_of(text):
    out, word = [], bytearray()
    for b in toxicity.lowered(text).encode() + b" ":
        if 48 <= b < 58 or 97 <= b < 123 or b >= 128:
            word.append(b)
        elif word:
            out.append(bytes(word))
            word = bytearray()
    return out


def plain_score(model, text):
    """Word by word, window by window."""
    def row(word):
        h = sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(word)) % (1 << 64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> shift)) * factor % (1 << 64)
        return 1 + (h ^ (h >> 31)) % (toxicity.BUCKETS - 1)

    def vector(word):
        return model.table[row(word)].astype(float) + sum(model.table[row(word[:k])].astype(float) for k in toxicity.BEGINNINGS if len(word) > k)

    x, z = [vector(w) for w in words_of(text)], []
    for f, b in zip(model.filters, model.offsets):
        best = np.zeros(toxicity.FILTERS)
        for i in range(len(x)):
            best = np.maximum(best, sum(x[i + k] @ f[k].astype(float) for k in range(len(f)) if i + k < len(x)))
        z.append(np.maximum(best + b, 0))
    t = float(np.concatenate(z) @ model.weights.astype(float)) + model.bias
    return 1 / (1 + math.exp(-(model.slope * t + model.shift)))


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["word", "text", "Énd", "other", "things", "12", "and", "abc", "longerword"]
    docs = []
    for i in range(240):
        words = list(rng.choice(vocabulary, rng.integers(1, 60)))
        if i % 3 == 0:
            words.insert(int(rng.integers(0, len(words))), ["idiot", "villainous", "villainy"][i % 9 // 3])
        docs.append((i, " ".join(words) + ".", ["en", "de", None][i % 2], "s", 1, i, 0.5, True))
    odd = [(1000, None, None, None, None, 1, 0.0, False), (1001, "", "en", "", 0, 1, 0.0, False), (1002, "!!! ??", "xx", "", 0, 1, 0.0, False), (1003, "other and villainest things", "en", "", 0, 1, 0.0, False),
           (None, "word idiot", "en", "", 0, 1, 0.0, False), (1004, "word text " * 60_000 + "idiot", "en", "", 0, 1, 0.0, False), (1005, "x" * 50_000, "en", "", 0, 1, 0.0, False)] + [(1006, "an IDIOT", "de", "", 0, 1, 0.0, False)] * 3
    df = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, source string, n_chars long, toxic int, score double, flagged boolean").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(240)] + [(None, 1, 1), (7, None, 1), (9, 5, 1)], "doc_id long, toxic int, quality int")
    return df, labels, toxicity.fit(df, labels)


def test_scores_word_by_word(spark, small):
    df, labels, (model, cuts) = small
    rows = toxicity.scored(df, model, cuts).collect()
    assert rows[0].__fields__ == [c for c in df.columns if c not in ("score", "flagged")] + ["score", "flagged"] and len(rows) == 250
    for r in rows:
        if r.doc_id != 1004:
            assert r.score == pytest.approx(plain_score(model, r.text or ""), abs=1e-4)
        assert r.flagged == (r.score >= cuts.get(r.lang, cuts[""]))
    by = {r.doc_id: r.score for r in rows}
    assert all((by[i] >= 0.5) == (i % 3 == 0) for i in range(240))
    assert by[1000] == by[1001] == by[1002] < 0.5 and by[1004] > 0.5 and by[None] > 0.5 and by[1003] > 0.5
    assert len({r.score for r in rows if r.doc_id == 1006}) == 1 and by[1006] > 0.5


def test_long_texts_in_slices_of_any_size(small, monkeypatch):
    model = small[2][0]
    text = "word idiot text, and other things. " * 40 + "villainous" + "x" * 400 + " abc"
    data = np.frombuffer((toxicity.lowered(text) + " ").encode(), np.uint8)
    whole = toxicity.pooled(model, data, np.array([0, 700, len(data)]))
    for size in (1, 7, 50, 333):
        monkeypatch.setattr(toxicity, "SLICE_BYTES", size)
        assert np.allclose(toxicity.pooled(model, data, np.array([0, 700, len(data)])), whole, atol=1e-5)


def test_same_model_from_other_partitions(spark, small):
    df, labels, (model, cuts) = small
    again, cuts_again = toxicity.fit(df.repartition(7), labels.repartition(5))
    assert all(np.array_equal(a, b) for a, b in zip((again.table, again.weights, *again.filters), (model.table, model.weights, *model.filters)))
    assert (again.slope, again.shift, cuts_again) == (model.slope, model.shift, cuts)


def test_without_rows_or_labels(spark, small):
    df, labels, _ = small
    assert toxicity.toxicity(df.limit(0), labels).collect() == []
    assert {r.score for r in toxicity.toxicity(df, labels.limit(0)).collect()} == {0.5}
    assert {r.predicted for r in toxicity.toxicity(df, labels.where("toxic = 0")).collect()} == {0}
    one = toxicity.toxicity(df, labels.where("doc_id in (3, 4)")).collect()
    assert len(one) == 250 and all(0 <= r.score <= 1 for r in one)


def test_thresholds():
    s, y = np.array([0.1, 0.2, 0.3, 0.8, 0.9]), np.array([0, 0, 0, 1, 1])
    assert toxicity.threshold(s, y) == pytest.approx(0.55)
    assert toxicity.threshold(np.array([0.1, 0.4, 0.35, 0.9]), np.array([0, 0, 1, 1])) in (pytest.approx(0.225), pytest.approx(0.65))


def test_rows_beyond_the_first_ones_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", (60, 30))
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 300)
    from pyspark.sql import functions as F
    ids = [r.id for r in spark.range(900).orderBy(F.xxhash64("id")).collect()]
    rng = np.random.default_rng(2)
    bad = [i for i in ids if i % 3 == 0]
    insult = {i: "idiot" if k < 120 else "moron" for k, i in enumerate(bad)}  # no row of the first ones has the second word
    words = ["word", "text", "other", "things", "and", "abc", "mortar", "idiom"]
    docs = [(i, " ".join([*rng.choice(words, 12), *([insult[i]] if i in insult else [])]), "en") for i in ids]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i in insult)) for i in ids], "doc_id long, toxic int")
    model, cuts = toxicity.fit(df, labels)
    odd = spark.createDataFrame([(0, "other moron things", "en"), (1, "an idiot and text", "en"), (2, "other mortar and things idiom", "en"), (3, "word " * 30, "en")], df.schema)
    assert [r.score >= 0.5 for r in toxicity.scored(odd, model, cuts).orderBy("doc_id").collect()] == [True, True, False, False]
    again, _ = toxicity.fit(df.repartition(5), labels.repartition(3))
    assert np.array_equal(again.table, model.table) and again.slope == model.slope


def test_training_on_a_long_text_by_slices(monkeypatch):
    state = toxicity.begun(np.random.default_rng(3))
    text = "word idiot text, and other things. " * 40 + "villainous abc"
    rows = toxicity.text_rows(text)
    want = toxicity.strongest(state.table, state.dense[:3], rows)
    for size in (50, 333):
        monkeypatch.setattr(toxicity, "SLICE_BYTES", size)
        got = toxicity.strongest(state.table, state.dense[:3], toxicity.text_rows(text))
        assert toxicity.text_rows(text).dtype == np.uint8
        for (a, _, b), (c, _, d) in zip(got, want):
            assert np.allclose(a, c, atol=1e-6) and (b == d).all()
