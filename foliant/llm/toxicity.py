"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Features are whether a text holds an n-gram of 3 to 5 lower-cased characters, hashed to ``BINS`` bins. Each
is scaled by the log ratio of its smoothed counts in toxic and other texts, and a linear
margin (squared hinge, lasso penalty) is fitted to the scaled features; its logistic is the score. The model is one weight for each bin, so what is
broadcast has a fixed size.

The fit takes a bounded sample of labelled rows: at most ``PER_CLASS`` of each class, those of the smallest
hash of their id, if they have ``TRAIN_CHARS`` characters or fewer, one row of each id (that of the least text hash). Scoring reads every whole text.

Cases: a null or empty text has the score of no features; a label that is null is none; of labels that
repeat an id the larger counts; without labels of both classes every score is 0.5 times their
share of toxic rows (0.5 if there are none); a null id is never held out. Further columns are ignored,
and never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release, small

#: Large, so that long texts don't fill the bins of others by chance.
BITS = 21
BINS = 1 << BITS
GRAMS = (3, 4, 5)
#: Bounds of the sample that the classifier is fitted to.
PER_CLASS = 1000
TRAIN_CHARS = 20_000
THRESHOLD = 0.7
#: Logit of a text on the margin, where the fit aims at -1 and 1.
SLOPE = 4.0

#: Bins that a step of the fit holds weights for at a time.
BLOCK = 1 << 20


def bins_of(text: str | None) -> np.ndarray:
    """Bin of each n-gram of the text, with repeats; a line feed stands before and after it."""
    if not text:
        return np.zeros(0, np.uint32)
    c = np.frombuffer(f"\n{text.lower()}\n".encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
    out, h = [], c
    for n in range(2, max(GRAMS) + 1):
        if len(c) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) ^ c[n - 1 :] * np.uint32(0x85EBCA6B)
        if n in GRAMS:
            m = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out.append((m ^ (m >> np.uint32(13))) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class Model:
    """score = sigmoid(bias + sum of weights of the distinct bins)."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def scores(self, texts: list[str | None]) -> list[float]:
        out = []
        for t in texts:
            b = bins_of(t)
            used = np.unique(b[self.weights[b] != 0])  # few bins have a weight
            z = self.bias + float(self.weights[used].sum(dtype=np.float64))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def fit_rows(rows: list[tuple[int, np.ndarray]], lasso: float = 5e-5, steps: int = 120, least_df: int = 4) -> Model:
    """Fit to (label, distinct bins) of each text."""
    y = np.array([r[0] for r in rows], np.float64)
    none = Model(np.zeros(BINS), 0.0)
    if not len(y) or y.min() == y.max():
        share = 0.5 if not len(y) else min(max(y.mean(), 0.01), 0.49)
        none.bias = float(np.log(share / (1 - share)))
        return none
    df = np.zeros(BINS, np.int64)
    for _, b in rows:
        df[b] += 1
    used = np.flatnonzero(df >= least_df)
    place = np.full(BINS, -1, np.int32)
    place[used] = np.arange(len(used))
    sizes = np.array([np.count_nonzero(df[b] >= least_df) for _, b in rows], np.int64)
    ends = np.cumsum(sizes)
    flat = np.empty(ends[-1], np.int32)
    for (_, b), n, end in zip(rows, sizes, ends, strict=True):
        c = place[b]
        flat[end - n : end] = c[c >= 0]
    # whole texts in blocks, so that no weights are held for all bins of all texts at once; sums run in the same order as without blocks
    cuts = np.unique(np.concatenate([[0, len(y)], np.searchsorted(ends, np.arange(BLOCK, ends[-1], BLOCK))])).tolist()

    def blocks():
        for i, j in zip(cuts, cuts[1:]):
            first = int(ends[i] - sizes[i])
            yield i, j, flat[first : int(ends[j - 1])].astype(np.intp), np.repeat(np.arange(j - i), sizes[i:j])

    def by_text(v):
        out = np.empty(len(y))
        for i, j, bins, row in blocks():
            out[i:j] = np.bincount(row, weights=v[bins], minlength=j - i)
        return out

    def by_bin(m):
        out = np.zeros(len(used))
        for i, j, bins, row in blocks():
            np.add.at(out, bins, m[i:j][row])
        return out

    count = lambda m: by_bin(m) + 1.0
    p, q = count(y), count(1 - y)
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    norm = np.sqrt(np.sum(ratio**2 * df[used]) / len(y))  # one scale for all texts keeps the steps stable
    scale = ratio / norm
    # squared hinge loss, so that texts inside the margin decide; classes weigh the same; proximal
    # steps with momentum, the lasso leaves chance n-grams out
    side = 2 * y - 1
    mass = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, b, rate = np.zeros(len(used)), 0.0, 1.5
    vw, vb = w.copy(), 0.0
    for k in range(steps):
        z = by_text(scale * vw) + vb
        g = -2 * mass * side * np.maximum(0, 1 - side * z)
        nw = vw - rate * scale * by_bin(g)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * lasso, 0)
        nb = vb - rate * g.sum()
        push = k / (k + 3)
        vw, vb, w, b = nw + push * (nw - w), nb + push * (nb - b), nw, nb
    weights = np.zeros(BINS)
    weights[used] = w * scale * SLOPE
    return Model(weights, b * SLOPE)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, train_chars: int = TRAIN_CHARS) -> Model:
    """Fit to a bounded sample of the labelled documents that are not held out."""
    marks = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    drawn = [r for y in (0, 1) for r in marks.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(per_class).collect()]
    if not drawn:
        return fit_rows([])
    spark = documents.sparkSession
    few = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in drawn], "doc_id long, toxic int")  # 2 * per_class rows at most
    chosen = documents.where("doc_id is not null").select("doc_id", "text").join(F.broadcast(few), "doc_id").where(F.char_length(F.coalesce("text", F.lit(""))) <= train_chars)
    # of rows that repeat an id one counts, so what comes to the driver is bounded
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            bins = [np.unique(bins_of(t)).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(bins, pa.binary())], ["doc_id", "toxic", "bins"])

    got = chosen.select("doc_id", "text", "toxic").mapInArrow(featured, "doc_id long, toxic int, bins binary").toArrow().sort_by("doc_id")
    rows = [(y, np.frombuffer(b.as_buffer(), np.int32)) for y, b in zip(got["toxic"].to_pylist(), got["bins"], strict=True)]  # views, not copies
    model = fit_rows(rows)
    del rows, got
    release()
    return model


def score(documents: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """Adds ``out`` to ``documents`` (which has ``text``)."""
    shared = documents.sparkSession.sparkContext.broadcast((model.weights.tobytes(), model.bias))
    plain = [c for c in documents.columns if c != out]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        m = Model(np.frombuffer(weights, np.float32), bias)
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in plain), pa.array(m.scores(b.column("text").to_pylist()), pa.float64())], [*plain, out])

    rows = documents.select(*plain)
    return rows.mapInArrow(scored, T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())]))


def op3(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    rows = documents.select("doc_id", "text")
    scored = score(rows, fit(rows, labels.select("doc_id", "toxic")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
