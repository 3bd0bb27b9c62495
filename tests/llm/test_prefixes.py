import hashlib
import zlib

import pytest

from flickmill.llm import prefixes

FIELDS = "conv_id long, turn long, role string, text string, depth int, h string, pos long, block long"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def in_order(rows):
    out = {}
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            h = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            out.setdefault(r[0], []).append(((r[1] is not None, r[1] or 0, role, h), (role, text)))
    return {c: [t for _, t in sorted(ts)] for c, ts in out.items()}


def exchanged(convs):
    out = {}
    for c, own in convs.items():
        k = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:k] + own[k:]
    return out


def plain(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, m in members.items():
        under = [n for n in members if n[:len(node)] == node]
        childless = [n for n in under if not any(len(x) == len(n) + 1 and x[:-1] == n for x in under)]
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), sum(len(x) == len(node) + 1 for x in under), len(childless),
                    sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in under if n), hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def turns(c, texts):
    return [(c, i, "user" if i % 2 == 0 else "assistant", t, 1, "x", 2, 3) for i, t in enumerate(texts)]


CASES = {
    "copies, branches and lengths": [r for c in range(60) for r in turns(c, [["a", "é", "", "dd", "e", "f", "g", "h", "i", "k"][(i + (c % 3 if i > c % 6 else 0)) % 10] for i in range(c % 21)])],
    "a common conversation": [r for c in range(700) for r in turns(c, ["hello", "there", "again"] if c % 3 else [f"own {c}", "x"])],
    "long": turns(1, ["x"] * 60) + turns(2, ["x"] * 75) + turns(3, ["x"] * 59 + ["y"] * 30) + turns(-4, ["z"] * 8) + turns(-5, ["z"] * 8 + ["x"]) + turns(16, ["x"] * 16),
    "nulls, ties and repeats": [(7, None, None, None, 0, "", 0, 0), (7, 3, "user", None, 0, "", 0, 0), (7, 3, "user", "b", 0, "", 0, 0), (7, 3, "user", "b", 0, "", 0, 0), (7, None, "", "q", 0, "", 0, 0),
                                (5, None, None, None, 0, "", 0, 0), (5, 1, None, "c", 0, "", 0, 0), (None, 1, "user", "lost", 0, "", 0, 0), (9, 0, "user", "t" * 300_000, 0, "", 0, 0), (8, 0, "user", "t" * 300_000, 0, "", 0, 0)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_plain_prefixes(spark, name):
    rows = CASES[name]
    df = spark.createDataFrame(rows, FIELDS).repartition(4)
    convs = in_order(rows)
    for got, want in ((prefixes.conversation_trie(df), convs), (prefixes.spliced_trie(df), exchanged(convs))):
        assert got.columns == NAMES
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain(want)


def test_narrow_blocks_and_few_broadcast_nodes(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "WIDTH", 3)
    monkeypatch.setattr(prefixes, "COLUMNS", ["t1", "t2", "t3"])
    monkeypatch.setattr(prefixes, "HEAVY", 2)
    rows = CASES["a common conversation"] + turns(5_000, ["hello", "there", "again", "and", "more", "of", "it"]) + [r for c in range(2_000, 3_500) for r in turns(c, ["hello", f"{c}"])]
    got = prefixes.conversation_trie(spark.createDataFrame(rows, FIELDS)).collect()
    by = {(r.conv_id, r.depth): r for r in got}
    assert by[0, 0].n_convs == 2_201 and by[0, 0].parent_conv_id is None and by[0, 0].n_children == 235
    assert by[1, 1].n_convs == 466 + 1 + 1_500 and by[1, 1].n_children == 1_501 and by[1, 1].n_leaves == 1_501 and by[1, 1].parent_conv_id == 0
    assert by[5_000, 7].parent_conv_id == 5_000 and by[5_000, 4].parent_conv_id == 1 and by[1, 3].n_convs == 467
    assert all(by[c, 2].parent_conv_id == 1 for c in range(2_000, 3_500))
    # each but the first of 1,967 says hello, of 467 there, and again: 5 bytes each
    assert by[0, 0].saved_tokens == 5 * (1_966 + 466 + 466)


def test_empty(spark):
    assert prefixes.spliced_trie(spark.createDataFrame([], FIELDS)).collect() == []


def test_one_rollup_aggregates_all_prefixes(spark):
    rows = prefixes.ordered(spark.createDataFrame(CASES["long"], FIELDS))
    blocks, _ = prefixes.blocks_and_ends(rows, rows.select("conv_id").distinct())
    plan = prefixes.rolled(blocks, "count(1) AS n")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "spark_grouping_id" in plan
