import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from flickmill.llm import manifest

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, part int, leaf string, tree string, _tie int"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def climb(nodes, idx):
    """Levels of a tree and, from leaf ``idx`` up, (place in its run, run)."""
    walk = []
    while len(nodes) > 1:
        a = idx - idx % 3
        walk.append((idx - a, nodes[a:a + 3]))
        nodes, idx = [h(nodes[i:i + 3]) for i in range(0, len(nodes), 3)], idx // 3
    return nodes[0], walk


def plain(rows):
    rows = [r[:5] for r in rows]
    order = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))) for s in order}
    subroots = [climb([leaf_of(*r) for r in per[s]], 0)[0] for s in order]
    out = []
    for k, s in enumerate(order):
        leaves = [leaf_of(*r) for r in per[s]]
        for i, r in enumerate(per[s]):
            sub, low = climb(leaves, i)
            root, top = climb(subroots, k)
            doc_id, text = r[:2]
            tampered = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
            value = leaf_of(doc_id, text.replace("\n", ""), *r[2:]) if tampered else leaves[i]
            siblings = []
            for place, run in low + top:
                siblings += run[:place] + run[place + 1:]
                value = h(run[:place] + [value] + run[place + 1:])
            out.append((doc_id, leaves[i], sub, root, h(siblings), value, value == root))
    return sorted(out, key=str)


def sample(n, source):
    return [(i, f"text {i}\nof two lines" if i % 3 else f"one line {i}", "en", source(i), i, 1, "x", "y", 2) for i in range(n)]


ROWS = {
    "one source holds most": sample(400, lambda i: "hot" if i % 3 else f"s{i % 7}"),
    "each its own source": sample(90, lambda i: f"s{i}"),
    "one row": sample(1, lambda i: "s"),
    "one source": sample(28, lambda i: "s"),
    "odd": [(None, None, None, None, None, None, None, None, None), (None, "a", None, None, 1, 0, "", "", 0), (5, "", "", "", 0, 0, "", "", 0), (5, "", "", "", 0, 0, "", "", 0),
            (5, "other\ntext", "é", "", 0, 0, "", "", 0), (-3, "\n" * 9, "e", "é", 5, 0, "", "", 0), (8, "long\n" * 400_000, "e", "z", 5, 0, "", "", 0)] + [(6, "copy\n", "e", "é", 1, 0, "", "", 0)] * 40,
}


@pytest.mark.parametrize("name", ROWS)
@pytest.mark.parametrize("partition,span", [(7, 1), (10, 2), (19_683, 6)])
def test_against_plain_trees(spark, monkeypatch, name, partition, span):
    if partition == 7 and name.startswith("each"):
        pytest.skip("the same as with 10")
    monkeypatch.setattr(manifest, "PARTITION", partition)
    monkeypatch.setattr(manifest, "SPAN", span)
    monkeypatch.setattr(manifest, "UPPER", 20 if partition == 10 else 100_000)
    df = spark.createDataFrame(ROWS[name], FIELDS).repartition(5)
    got = [tuple(r) for r in manifest.digests(df).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(got, key=str) == plain(ROWS[name])


def test_tampering_is_found_and_only_that(spark):
    rows = sample(60, lambda i: f"s{i % 4}")
    got = {r.doc_id: r.verified for r in manifest.digests(spark.createDataFrame(rows, FIELDS)).collect()}
    assert got == {r[0]: not ("\n" in r[1] and zlib.crc32(str(r[0]).encode()) % 2 == 0) for r in rows}


def test_some_leaves_prove_with_their_own_siblings(spark, monkeypatch):
    monkeypatch.setattr(manifest, "PARTITION", 50)
    rows = ROWS["one source holds most"]
    made = manifest.manifest(spark.createDataFrame(rows, FIELDS))
    got = manifest.proofs(made, F.col("doc_id").isin(3, 4, 200, 399)).collect()
    assert sorted(r.doc_id for r in got) == [3, 4, 200, 399] and all(r.verified for r in got)
    want = {r[0]: r[4] for r in plain(rows)}
    assert {r.doc_id: h(r.siblings) for r in got} == {i: want[i] for i in (3, 4, 200, 399)}


def test_coordinates_are_the_least_union():
    import pyarrow as pa
    whole = pa.table({"tree": [0] * 9, "idx": list(range(9)), "n": [9] * 9})
    assert manifest.missing(whole, 1) == []
    pair = pa.table({"tree": [0, 0], "idx": [0, 4], "n": [10, 10]})
    # 0 lacks 1 and 2, 4 lacks 3 and 5; their parents 0 and 1 lack 2; the run of ten's last node is alone; then 1 of 2
    assert manifest.missing(pair, 1) == [(0, 0, 1), (0, 0, 2), (0, 0, 3), (0, 0, 5), (0, 1, 2), (0, 2, 1)]
    assert manifest.missing(pair, 4) == [*manifest.missing(pair, 1), (-1, 0, 1), (-1, 0, 2), (-1, 1, 1)]


def test_empty(spark):
    assert manifest.digests(spark.createDataFrame([], FIELDS)).collect() == []


def test_text_leaves_the_scan_as_digests_only(spark, sf_dir):
    made = manifest.manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert "text" not in made.leaves.columns and manifest.proofs(made).count() == 200
