import random

from flickmill.llm import lines, registry


def close(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    """All pairs of lines; doc ids differ."""
    every, out = [], {}
    for d, text in sorted(docs, key=lambda x: x[0]):
        kept, all_lines = [], text.split("\n") if text is not None else []
        for x in all_lines:
            w = [v for v in x.replace("\t", " ").split(" ") if v]
            gone = len(w) >= 1 and any(w == e or (len(w) >= 4 and len(e) >= 4 and close(w, e)) for e in every)
            if len(w) >= 1:
                every.append(w)
            if not gone:
                kept.append(x)
        out[d] = (len(all_lines), len(all_lines) - len(kept), "\n".join(kept) if text is not None else None)
    return out


def got(df):
    return {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in df.collect()}


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    assert any(v[1] for v in want.values())
    assert got(registry.QUERIES["op8_line_dedup"](spark, sf_dir)) == want


def test_random_edits(spark):
    rnd = random.Random(2)
    base = [[rnd.choice("ab") if rnd.random() < .4 else f"w{rnd.randrange(50)}" for _ in range(n)] for n in (2, 3, 4, 5, 9, 10, 11, 12, 25) for _ in range(3)]
    docs = []
    for d in range(120):
        text = []
        for _ in range(rnd.randrange(5)):
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                i, kind = rnd.randrange(len(w)), rnd.randrange(3)
                w[i:i + 1] = [[], ["zz"], [w[i], rnd.choice("ab")]][kind]
            text.append(rnd.choice([" ", "  ", "\t"]).join(w))
        docs.append((d, "\n".join(text)))
    docs += [(500, None), (501, ""), (502, "\n\n"), (503, "long " * 8000), (504, "long " * 8001)]
    df = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, line long")
    assert got(lines.deduplicated(df)) == brute(docs)


def test_edge_cases(spark):
    one = "a b c d e f g h i j"
    df = spark.createDataFrame([(1, one, 19), (1, one, 19), (2, one + "\nhello", 25), (3, one + " k", 21), (None, one, 19), (4, None, None), (5, "", 0)],
                               "doc_id long, text string, n_chars long")
    rows = sorted((str(r.doc_id), r.n_removed, r.text) for r in lines.deduplicated(df).collect())
    assert rows == [("1", 0, one), ("1", 0, one), ("2", 1, "hello"), ("3", 1, ""), ("4", 0, None), ("5", 0, ""), ("None", 0, one)]
    clean = lines.cleaned(df)
    assert clean.schema == df.schema
    assert sorted((str(r.doc_id), r.n_chars) for r in clean.collect()) == [("1", 19), ("1", 19), ("2", 5), ("4", None), ("5", 0), ("None", 19)]
    assert lines.deduplicated(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    registry.QUERIES["op8_line_dedup"](spark, sf_dir).explain("formatted")
    assert "Python" not in (text := capsys.readouterr().out) and "Arrow" not in text
