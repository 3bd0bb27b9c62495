import hashlib
import itertools
import random
import re

import numpy as np

from flickmill.llm import pii, registry


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def number(s):
    return len(re.sub("[^0-9]", "", s))


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= number(s) <= 19 and luhn(re.sub("[^0-9]", "", s))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= number(s) <= 15)]


def brute(text):
    found = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if ok(m[0])]
    line = ",".join(f"{PATTERNS[k][0]}:{s}:{e}" for s, k, e in sorted(found))
    return (*[sum(k == i for _, k, _ in found) for i in range(4)], hashlib.sha256(line.encode()).hexdigest()), line


def base(r):
    return r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.QUERIES["op10_pii"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)
    added = [docs[r.doc_id][int(x.split(":")[1]):int(x.split(":")[2])] for r in rows if r.n_added for x in r.spans.split(",") if x not in brute(docs[r.doc_id])[1].split(",")]
    print("added", len(added), added[:20])
    for r in rows:
        want, line = brute(docs[r.doc_id])
        assert base(r) == want
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_patterns_on_random_strings():
    rnd = random.Random(9)
    for _ in range(20_000):
        text = "".join(rnd.choice("a.@-+ 1234567890(%é") for _ in range(rnd.randrange(40)))
        want = brute(text)[1]
        assert pii.written_out(pii.base_spans(text)) == want, text


def test_decoding_against_all_segmentations():
    rnd = np.random.default_rng(0)
    text = "x +12 34.5@a"
    toks = pii.tokens(text, 0, len(text))
    found = pii.candidates(text, toks)
    for _ in range(20):
        w = {f: rnd.normal(size=4) for here in found for _, fs in here for f in fs}
        value = {(i, j): sum(w[f] for f in fs).max() for i, here in enumerate(found) for j, fs in here}
        best = max(sum(value[s] for s in some) for n in range(4) for some in itertools.combinations(value, n)
                   if all(a[1] <= b[0] for a, b in zip(some, some[1:])))
        assert abs(sum(value[i, j] for i, _, j in pii.decode(found, w)) - best) < 1e-9


def test_edge_cases(spark):
    texts = [None, "", "a@b.c@d.e", "9" * 50_000, "x" * 50_000 + "@" + "y" * 50_000, "+1" + " " * 50_000, "@" * 2000, "mail x.y@mail.example.com, 10.0.0.1 and +1 (743) 555-3824."]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a@b.c", "x")], "doc_id long, text string, spans string")
    fitted = pii.fit(df)
    for r in pii.personal_data(df, weights=fitted).collect():
        if r.doc_id not in (3, 4):
            assert base(r) == brute(texts[r.doc_id] if r.doc_id is not None else "a@b.c")[0]
    assert pii.personal_data(df.limit(0)).count() == 0


def test_regions_are_drawn_from_every_sampled_text(spark, monkeypatch):
    dense = (" " + "word " * 40).join(f"+1 555 010 {n:04d}" for n in range(60))
    texts = [dense + str(i) for i in range(3)] + [f"call +1 555 020 {n:04d} now" for n in range(30)]
    monkeypatch.setattr(pii, "REGIONS", 45)
    taken = pii.drawn(texts)
    assert len(list(pii.regions(dense))) > 45
    assert {t for t, _ in taken} == set(texts) and sum(len(r) for _, r in taken) == 45
    read, real = [], pii.tokens
    monkeypatch.setattr(pii, "tokens", lambda t, a, b: read.append(t) or real(t, a, b))
    pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert set(read) == set(texts) and len(read) == 45
