"""Quality classifier by compression: zstandard dictionaries built from good and
from bad labelled texts; how much better one than the other compresses a text,
by its length, becomes a calibrated score.

Fitted on a bounded sample of labelled rows, scored over every whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled rows of each label that are learned from at most, and the longest of their texts (characters);
#: of those, every CALIBRATE-th is kept for the calibration.
SAMPLE, LONGEST, CALIBRATE = 1200, 20_000, 3
#: Bytes of a dictionary, of text compressed at once with it, and zstandard's level.
DICTIONARY, CHUNK, LEVEL = 112_640, 4_096, 3


class Model(NamedTuple):
    """Dictionaries (empty: none) and the logistic calibration of the size difference."""
    good: bytes
    bad: bytes
    slope: float
    offset: float


def held_out(doc_id: Column) -> Column:
    """One row of five, by its id; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def chunks(data: bytes) -> list[bytes]:
    return [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]


def dictionary(texts: list[bytes]) -> bytes:
    samples = [c for t in texts for c in chunks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples for its trainer: the texts themselves
        return b"\n".join(samples)[-DICTIONARY:]


def compressors(model: Model) -> tuple[zstandard.ZstdCompressor, ...]:
    out = []
    for raw in (model.good, model.bad):
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
    return tuple(out)


def difference(data: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """Compressed bytes with the bad dictionary less those with the good one, by bytes of the whole text; 0 if empty."""
    if not data:
        return 0.0
    return sum(len(bad.compress(c)) - len(good.compress(c)) for c in chunks(data)) / len(data)


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a little shrinkage."""
    scale = float(np.std(x)) or 1.0
    m, w = np.stack([x / scale, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        g = m.T @ (p - y) + 0.05 * w
        h = (m * (p * (1 - p))[:, None]).T @ m + 0.05 * np.eye(2)
        w -= np.linalg.solve(h, g)
    return max(0.0, float(w[0])) / scale, float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``labels.quality`` (1 good, 0 bad) from at most SAMPLE rows of each label outside the held-out fold.

    The sample is drawn by a hash of the id, and its ids (2 * SAMPLE at most) are the only rows broadcast. Other labels
    and nulls are not used. Without texts of both labels there is no dictionary and all scores are the share of good ones
    (one half without any).
    """
    spark = docs.sparkSession
    some = labels.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    rows = [r for q in (0, 1) for r in some.where(F.col("quality") == q).select("doc_id", F.col("quality").cast("int").alias("q")).distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect()]
    kind = labels.schema["doc_id"].dataType
    ids = spark.createDataFrame(rows, T.StructType([T.StructField("doc_id", kind), T.StructField("q", T.IntegerType())]))
    found = docs.select("doc_id", "text").where(F.length("text").between(1, LONGEST)).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "q").distinct()
    found = found.orderBy(F.xxhash64("doc_id"), "text").limit(4 * SAMPLE).collect()
    texts = {q: [r.text.encode() for r in found if r.q == q] for q in (0, 1)}
    if not texts[0] or not texts[1]:
        n = len(texts[0]) + len(texts[1])
        p = min(0.99, max(0.01, len(texts[1]) / n)) if n else 0.5
        return Model(b"", b"", 0.0, math.log(p / (1 - p)))
    learn = {q: [t for i, t in enumerate(ts) if i % CALIBRATE or len(ts) < CALIBRATE] for q, ts in texts.items()}
    size = min(sum(map(len, ts)) for ts in learn.values())  # as much text for either dictionary, so that neither knows more
    for q, ts in learn.items():
        ends = np.cumsum([len(t) for t in ts])
        learn[q] = ts[:max(1, int(np.searchsorted(ends, size * 1.05, side="right")))]
    model = Model(dictionary(learn[1]), dictionary(learn[0]), 1.0, 0.0)
    two = compressors(model)
    rest = [(q, t) for q, ts in texts.items() for i, t in enumerate(ts) if i % CALIBRATE == 0 or len(ts) < CALIBRATE]
    x, y = np.array([difference(t, *two) for _, t in rest]), np.array([q for q, _ in rest], float)
    return model._replace(**dict(zip(("slope", "offset"), calibrated(x, y))))


def scored(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The document rows with all their columns, score (0 to 1, higher: label 1 likelier) and predicted (1 from the
    threshold on). Only the text is read; null and empty texts have difference 0 and the score that goes with it.
    Repeated rows are each scored. Input columns named score or predicted are replaced."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([f for f in docs.schema.fields if f.name in keep] + [T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        two = compressors(m) if m.good else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            x = [difference(t.as_py().encode("utf-8", "surrogatepass"), *two) if two and t.is_valid else 0.0 for t in texts]
            score = 1 / (1 + np.exp(-np.clip(m.slope * np.array(x, float) + m.offset, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(score, pa.float64())], names=[*keep, "score"])

    made = docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels), threshold)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier does not reject, with their columns as they are. Null and empty texts stay."""
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    out = scored(named, fit(docs, labels), threshold)
    return out.where((F.col("predicted") == 1) | (F.coalesce(F.length("text"), F.lit(0)) == 0)).select("row.*")
