import corpus_pipeline
from flickmill.llm import quality
from flickmill.llm.scratch import written

from test_decontaminate import brute as contaminated
from test_jaccard import brute as near
from test_lines import brute as by_line


def rows(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_each_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.schema, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], sf_dir), f"test_{name}"))
    assert all(df.schema == columns for df in kept[1:-1])
    first, good, lines, single, clean = map(rows, kept[:-1])
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 0").collect() if first[r.doc_id]}
    assert good == {d: t for d, t in first.items() if d not in rejected}
    want = {d: x[2] for d, x in by_line(list(good.items())).items() if not x[1] or x[2].split()}
    assert lines == want
    classes = near(list(lines.items()))
    assert single == {d: t for d, t in lines.items() if classes[d][0] == d}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hit = contaminated(list(single.items()), items)
    assert clean == {d: t for d, t in single.items() if not hit[d][4]}
    packed = kept[-1].collect()
    assert {r.doc_id for r in packed} == set(clean)
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert all(total[r.doc_id] == r.doc_tokens for r in packed)


def test_run_on_odd_rows(spark, tmp_path):
    docs = [(1, None, "en", None, None), (2, "", None, "s", 0), (None, "some words", "en", "s", 10), (3, "word " * 30_000, "en", "s", 5), (3, "word " * 30_000, "en", "s", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == {1, 2, 3, None}
