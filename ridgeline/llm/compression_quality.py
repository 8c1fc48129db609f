"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled text.
A text is cut into blocks, each block is compressed with either dictionary, and
the sizes are summed: text like the good sample is smaller under the good
dictionary.  The normalised difference of the two sums, with the better of the
two rates (text that repeats itself compresses far below prose), is turned into a
probability by a logistic calibration on labelled texts the dictionaries have not
seen.

The fit uses a bounded sample: at most about ``sample_rows`` labelled documents of
each class (the lowest hashes of their ids), and ``sample_bytes`` of text of each
class in a dictionary.  Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.operators.draws import unused

from . import kernel as K
from .shared import materialise

BLOCK = 2048
LEVEL = 3
DICT_BYTES = 112_640
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 6 << 20
THRESHOLD = 0.3
FEATURES = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]        # of the features; the last is the intercept
    centre: list[float]
    scale: list[float]
    constant: float | None = None   # the score of every text, when a class has no labelled text


class Compressor:
    def __init__(self, model: Model):
        self.pair = []
        for raw in (model.good, model.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            c = zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False,
                                         write_dict_id=False)
            self.pair.append((c, len(c.compress(b""))))

    def sizes(self, text: str) -> tuple[int, int, int]:
        """(bytes, compressed size with the good, with the bad dictionary); frames cost nothing."""
        raw = text.encode()
        out = [0, 0]
        for at in range(0, len(raw), BLOCK):
            piece = raw[at:at + BLOCK]
            for k, (c, frame) in enumerate(self.pair):
                out[k] += len(c.compress(piece)) - frame
        return len(raw), out[0], out[1]


def features(n, good, bad) -> np.ndarray:
    """Rows of features from the byte count and the two compressed sizes."""
    n, good, bad = (np.asarray(x, dtype=float) for x in (n, good, bad))
    best = np.minimum(good, bad)
    rate = np.log((best + 8) / (n + 16))
    difference = (bad - good) / (bad + good + 32)
    return np.column_stack([difference, rate, difference * np.log1p(n)])


def _train(texts: list[bytes]) -> bytes:
    pieces = [t[k:k + BLOCK] for t in texts for k in range(0, len(t), BLOCK)]
    pieces = [p for p in pieces if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICT_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:     # too little text to train on: the text itself serves as a dictionary
        return b"".join(pieces)[-DICT_BYTES:] or b"\n" * 8


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (intercept last) by Newton steps; both classes count alike in the penalty only."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def bucket(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` labelled documents of each class: (doc_id, quality, text), lowest id hashes first."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
              .where("doc_id is not null and quality in (0, 1)").distinct())
    counts = {r.quality: r["count"] for r in marked.groupBy("quality").count().collect()}
    u = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("quality") == 1, min(1.0, rows / max(counts.get(1, 0), 1))).otherwise(
        min(1.0, rows / max(counts.get(0, 0), 1)))
    few = marked.where(u < share).select("doc_id", "quality")     # at most about 2 * rows ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(few), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """A model from the labels given (callers leave held-out labels out).

    Half of the sampled texts feed the dictionaries, the other half the calibration.
    With labels of one class only (or none) every text scores that class's value
    (0.5).
    """
    sample = labelled_sample(docs, labels, sample_rows)
    sample = materialise(sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(2))), "quality-sample")
    size = F.octet_length("text")
    order = F.xxhash64("doc_id", F.lit(5))
    known = {r.quality: r["count"] for r in sample.groupBy("quality").count().collect()}
    if known.get(0, 0) < 4 or known.get(1, 0) < 4:
        one = 0.5 if not known or len(known) == 2 else float(next(iter(known)))
        return Model(b"", b"", [], [], [], one)
    run = Window.partitionBy("quality").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    feed = (sample.where("part = 0").withColumn("before", F.coalesce(F.sum(size).over(run), F.lit(0)))
            .where(F.col("before") < sample_bytes).select("quality", "text"))
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    room = {0: sample_bytes, 1: sample_bytes}
    for r in feed.toLocalIterator():
        raw = r.text.encode()[:room[r.quality]]     # the sample, not a scored text: its last document may be cut
        room[r.quality] -= len(raw)
        texts[r.quality].append(raw)
    model = Model(_train(texts[1]), _train(texts[0]), [], [], [])
    rows = sample.where("part = 1").select("quality", _sizes_udf(docs.sparkSession, model)("text").alias("s")).select(
        "quality", "s.*").collect()
    y = np.array([r.quality for r in rows], dtype=float)
    x = features([r.n for r in rows], [r.good for r in rows], [r.bad for r in rows]) if rows else np.zeros((0, FEATURES))
    if len(set(y)) < 2:
        model.constant = 0.5 if not len(y) else float(y[0])
        return model
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    model.centre, model.scale = centre.tolist(), scale.tolist()
    model.weights = _logistic((x - centre) / scale, y).tolist()
    return model


def _sizes_udf(spark, model: Model):
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("n long, good long, bad long")
    def sizes(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = Compressor(shared.value)
        for text in parts:
            yield pd.DataFrame([c.sizes(t or "") for t in text], columns=["n", "good", "bad"])
        K.release()
    return sizes


def predict(model: Model, n, good, bad) -> np.ndarray:
    x = (features(n, good, bad) - np.array(model.centre)) / np.array(model.scale)
    z = x @ np.array(model.weights[:-1]) + model.weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality of each whole text (null: empty) as ``name``."""
    if model.constant is not None:
        return docs.withColumn(name, F.lit(model.constant))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = Compressor(shared.value)
        for text in parts:
            sizes = [c.sizes(t or "") for t in text]
            yield pd.Series(predict(shared.value, *zip(*sizes, strict=True)) if sizes else [], dtype=float)
        K.release()

    return docs.withColumn(name, run(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text, ...).

    Labels of documents whose crc32(doc_id) mod ``folds`` is 0 are not learned from.
    Null or empty texts get the score of an empty text; a null id is never held out.
    Only the text enters the score.  An empty table gives an empty result.
    """
    model = fit(docs, labels.where(bucket(F.col("doc_id"), folds) != 0))
    rows = score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", F.coalesce(bucket(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """``docs`` without the rows that are predicted to be of bad quality."""
    model = fit(docs, labels.where(bucket(F.col("doc_id"), folds) != 0))
    name = unused(docs.columns, "_score")
    return score(docs, model, name).where(F.col(name) >= THRESHOLD).select(*docs.columns)
