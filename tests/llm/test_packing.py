import array
import random
import zlib

from tokenizers import Tokenizer

import corpus_pipeline
from flickmill.llm import packing, registry, tokens


def check(rows, texts, capacity):
    """Pieces cover each document once, with the ids that tokenizers gives; sequences are gapless."""
    t = Tokenizer.from_file(tokens.default_path())
    t.encode_special_tokens = True
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for k, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            part = ids[at:at + r.length]
            assert r.ids_crc32 == zlib.crc32(array.array("I", part).tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for s in by_sequence.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at if at & at - 1 else 0
    return padding, sum(r.length for r in rows)


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    padding, total = check(registry.QUERIES["op5_packing"](spark, sf_dir).collect(), texts, 1024)
    assert padding <= 0.01 * total


def test_edge_rows(spark):
    texts = {0: None, 1: "", 2: "word " * 20_000, 3: " a  b\n <|endoftext|> \x1c\x85z", 4: "日本語 テキスト ok", 5: "x" * 30_000, 6: "don't\xa0 stop  "}
    df = spark.createDataFrame([(k, v, 1) for k, v in texts.items()], "doc_id long, text string, length int").repartition(1)
    rows = packing.packed(df).collect()
    check(rows, texts, 1024)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    assert packing.packed(df.limit(0)).count() == 0
    assert packing.packed(df.union(df)).agg({"length": "sum"}).first()[0] == 2 * sum(r.length for r in rows)
    assert [r.doc_id for r in packing.packed(df.selectExpr("cast(null as long) doc_id", "text").limit(1)).collect()] == [None]


def test_differencing_is_near_equal():
    rnd = random.Random(1)
    for m in (1, 2, 7, 40):
        sizes = [rnd.randint(1, 1024) for _ in range(6 * m)]
        parts = packing.differencing(sizes, m)
        assert sorted(i for p in parts for i in p) == list(range(len(sizes))) and len(parts) == m
        sums = [sum(sizes[i] for i in p) for p in parts]
        assert max(sums) - min(sums) < 400
    assert all(sum([600, 600, 600][i] for i in p) <= 1024 for p in packing.windows([600, 600, 600], 1024))


def test_words_kept_between_texts_change_no_id():
    ids = tokens.Ids(tokens.default_path(), tokens.default_ranks())
    for text in ["a  b", "x \n b\n c   d  ", "don't  stop\x1c x \x85 y z", "\xa0 q  r", "it's 'll 12 34ab  ", "Größe ñandú ça", "ünï 漢字 🙂 ok", "a " * 50]:
        for _ in range(2):
            assert ids.of(text) == array.array("I", ids.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def test_queries_encode_special_strings_as_the_tokenizer_does(spark, tmp_path):
    plain = Tokenizer.from_file(tokens.default_path())
    texts = {1: "a <|endoftext|> b", 2: "<|endoftext|>", 3: "x<|endoftext|><|endoftext|>  y\nz", 4: "no such <|endoftext| > here", 5: "漢字<|endoftext|>"}
    df = spark.createDataFrame([(k, v) for k, v in texts.items()], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = {k: plain.encode(v, add_special_tokens=False).ids + [0] for k, v in texts.items()}
    assert 50256 in want[1] and 50256 not in want[4]
    for out in (registry.QUERIES["op5_packing"](spark, str(tmp_path)), corpus_pipeline.pack(spark, df, str(tmp_path))):
        got = {r.doc_id: (r.doc_tokens, r.length, r.ids_crc32) for r in out.collect() if r.doc_tokens == r.length}
        pieces = out.groupBy("doc_id").count().where("count > 1").count()
        assert len(got) + pieces == len(texts) and got
        assert all(got[k] == (len(want[k]), len(want[k]), zlib.crc32(array.array("I", want[k]).tobytes())) for k in got)
        assert {r.doc_id: r.doc_tokens for r in out.collect()} == {k: len(v) for k, v in want.items()}
    ids = tokens.Ids(tokens.default_path(), tokens.default_ranks())
    assert all(ids.of(v, True) == array.array("I", plain.encode(v, add_special_tokens=False).ids).tobytes() for v in texts.values())
