import base64
import hashlib
import random
import re

from flickmill.llm import registry, secrets

PATTERNS = [("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 32)]


def brute(text):
    found = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if ok(m)]
    n = [sum(k == i for _, k, _ in found) for i in range(3)]
    line = ",".join(f"{PATTERNS[k][0]}:{s}:{e}" for s, k, e in sorted(found))
    return (*n, hashlib.sha256(line.encode()).hexdigest()), line


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = registry.QUERIES["op9_secret_scan"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and sum(r.n_assign + r.n_access + r.n_hex for r in rows)
    for r in rows:
        want, line = brute(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == want
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_edge_cases(spark):
    texts = [None, "", "PassWord = 'abcd1234' toKen:short API_KEY==x", "AKIA" * 10 + " " + "a1" * 40, "token=" * 50, "ſecret=abcdefgh apiKey:\"a.b/c=d+e-f_g\"",
             "é token : 12345678", "f" * 100_000, "password" + " " * 50_000 + "=", "secret=secret=secretsecret"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "AKIA" * 5, "x")], "doc_id long, text string, spans string")
    for r in secrets.secrets(df).collect():
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == brute(texts[r.doc_id] if r.doc_id is not None else "AKIA" * 5)[0]
    assert secrets.secrets(df.limit(0)).count() == 0


def test_battery_tells_random_strings_from_ordinary_ones():
    rnd = random.Random(4)
    keys = [base64.b64encode(rnd.randbytes(30)).decode().rstrip("=") for _ in range(200)] + [rnd.randbytes(15).hex() for _ in range(200)]
    caught = sum(bool(secrets.random_spans(f"see {k} here", [])) for k in keys)
    plain = ["chapter_one_of_the_long_story_2024", "aaaaaaaaaaaaaaaaaaaaaaaa11111111", "abcdefghijklmnopqrstuvwxyz0123456789", "2024-01-01T00-00-00-000000Z",
             "ThisIsAVeryLongCamelCaseIdentifierName1", "internationalization", "0000000000000000000000000000000a"]
    print("random caught", caught / len(keys), "plain found", [p for p in plain if secrets.random_spans(p, [])])
    assert caught > 0.9 * len(keys)
    assert sum(bool(secrets.random_spans(p, [])) for p in plain) <= 1
