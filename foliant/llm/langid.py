"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

A text is lower-cased, everything but letters becomes one space, and n-grams of 1 to 4 characters are hashed to ``BINS`` bins. A bin's
value is (1 + log of its count) times its inverse document frequency, and a text's values have length 1. One weight for each
bin and language is fitted by the follow-the-regularised-leader rule (proximal, a rate for each weight) with elastic-net penalties: the lasso part keeps weights at
zero until enough speaks for them. A temperature, fitted to texts that the weights weren't, makes the shares of the
languages honest.

What is learned from: ``learn`` marks the rows. Document frequencies are of all of them. Weights and temperature are fitted to a bounded sample, at
most ``PER_LANG`` texts of each of the ``MOST_LANGS`` most frequent languages, those of the smallest hashes, of at most ``TRAIN_CHARS`` characters; copies count once.
A fifth of the sample, by hash, is for the temperature. Prediction reads whole texts.

Cases: a null text, or one without letters, is ``und`` with score 0; without any labelled text to learn from all are; with a single language every other text is
of that language, with score 1; of equal shares the first language by name is taken; labels that are null are none; repeated rows repeat their result; no
rows give no rows. Further columns are ignored, and never enter a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small

BITS = 17
BINS = 1 << BITS
GRAMS = (1, 2, 3, 4)
#: Bounds of the sample.
PER_LANG, MOST_LANGS, TRAIN_CHARS = 600, 200, 20_000
#: Every so many texts of the sample are for the temperature.
FOLDS = 5
#: Rate, its offset, lasso and ridge penalties, and passes of the fit.
ALPHA, BETA, LASSO, RIDGE, PASSES = 0.5, 1.0, 0.02, 0.1, 3
UNKNOWN = "und"
OTHER = re.compile(r"[\W\d_]+")


def letters_of(text: str | None) -> str:
    """The lower-cased letters of a text, one space for all else; empty if it has none."""
    if not text:
        return ""
    plain = OTHER.sub(" ", text.lower())
    # numerals that aren't digits are word characters too, but no letters
    if not plain.isascii() and not plain.replace(" ", "").isalpha():
        plain = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in plain))
    return plain.strip()


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bins of a text's n-grams, ascending, and how often each occurs."""
    plain = letters_of(text)
    if not plain:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint32(1)
    h, grams = np.zeros(len(c), np.uint32), []
    for n in range(1, max(GRAMS) + 1):
        if len(c) < n:
            break
        h = (h if n == 1 else h[:-1]) * np.uint32(0x01000193) ^ c[n - 1 :] * np.uint32(0x85EBCA6B)
        if n in GRAMS:
            m = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
            grams.append((m ^ (m >> np.uint32(13))) >> np.uint32(32 - BITS))
    grams = np.concatenate(grams)
    if len(grams) < BINS // 16:
        return np.unique(grams, return_counts=True)
    counts = np.bincount(grams, minlength=BINS)
    bins = np.flatnonzero(counts)
    return bins, counts[bins]


def values_of(bins: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of length 1."""
    v = (1 + np.log(counts)) * idf[bins]
    return v / max(1e-12, float(np.sqrt(np.square(v).sum())))


def shares(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # of each bin
    used: np.ndarray  # bins that have a weight
    weights: np.ndarray  # (used, language)
    bias: np.ndarray
    temperature: float = 1.0

    def __post_init__(self):
        self.place = np.full(BINS, -1, np.int32)
        self.place[self.used] = np.arange(len(self.used))

    def margins(self, bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
        v, p = values_of(bins, counts, self.idf), self.place[bins]
        known = p >= 0
        return v[known] @ self.weights[p[known]] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        bins, counts = counts_of(text)
        if not len(bins) or not self.langs:
            return UNKNOWN, 0.0
        p = shares(self.margins(bins, counts) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def proximal(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of the follow-the-regularised-leader rule from its sums: 0 where |z| is within the lasso."""
    return np.where(np.abs(z) <= LASSO, 0.0, -(z - np.sign(z) * LASSO) / ((BETA + np.sqrt(n)) / ALPHA + RIDGE))


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], size: int, langs: int, passes: int = PASSES) -> np.ndarray:
    """Weights (size, langs) fitted to (language, places, values), row by row; the bias is a place like others."""
    z, n = np.zeros((size, langs)), np.zeros((size, langs))
    for _ in range(passes):
        for y, at, v in rows:
            zs, ns = z[at], n[at]
            w = proximal(zs, ns)
            g = shares(v @ w)
            g[y] -= 1
            g = v[:, None] * g[None, :]
            square = g * g
            z[at] = zs + g - (np.sqrt(ns + square) - np.sqrt(ns)) / ALPHA * w
            n[at] = ns + square
    return proximal(z, n)


def fit_temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, between 1/20 and 20, by golden sections of its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        m = margins / np.exp(t)
        top = m.max(axis=1)
        return float((top + np.log(np.exp(m - top[:, None]).sum(axis=1)) - m[np.arange(len(y)), y]).mean())

    low, high, cut = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_rows(rows: list[tuple[str, np.ndarray, np.ndarray]], df: np.ndarray, total: int) -> Model:
    """From (language, bins, counts) of a sample, and the document frequencies of ``total`` texts."""
    langs = sorted({r[0] for r in rows})
    idf = np.log((1 + total) / (1 + df)) + 1
    none = Model(langs, idf, np.zeros(0, np.int64), np.zeros((0, len(langs))), np.zeros(len(langs)))
    if len(langs) < 2:
        return none
    number = {x: i for i, x in enumerate(langs)}
    used = np.unique(np.concatenate([r[1] for r in rows]))
    place = np.full(BINS, -1, np.int64)
    place[used] = np.arange(len(used))
    ready = [(number[x], np.append(place[b], len(used)), np.append(values_of(b, c, idf), 0.1)) for x, b, c in rows if len(b)]
    test, train = ready[::FOLDS], [r for i, r in enumerate(ready) if i % FOLDS]
    if len({r[0] for r in train}) < len(langs):
        test, train = [], ready
    w = fit_ftrl(train, len(used) + 1, len(langs))
    some = np.flatnonzero(w[:-1].any(axis=1))
    model = Model(langs, idf, used[some], w[some], w[-1] * 0.1)
    if test:
        model.temperature = fit_temperature(np.array([v @ w[at] for _, at, v in test]), np.array([y for y, _, _ in test]))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _held_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (bin, df): how many texts of a task hold each bin; bin -1 counts the texts."""
    df, n = np.zeros(BINS, np.int64), 0
    for b in small(batches):
        for text in b.column("text").to_pylist():
            bins, _ = counts_of(text)
            df[bins] += 1
            n += len(bins) > 0
    used = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(df[used], n))], ["bin", "df"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches):
        both = [counts_of(t) for t in b.column("text").to_pylist()]
        bins, counts = (pa.array([x[i].astype(np.int32).tobytes() for x in both], pa.binary()) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("mark"), bins, counts], ["lang", "mark", "bins", "counts"])


def fit(learn: DataFrame, per_lang: int = PER_LANG, most_langs: int = MOST_LANGS, train_chars: int = TRAIN_CHARS) -> Model:
    """From ``learn`` (text, lang); rows with a null in either are left out."""
    rows = learn.select("text", "lang").where("text is not null and lang is not null")
    found = rows.select("text").mapInArrow(_held_by, "bin long, df long").groupBy("bin").agg(F.sum("df").alias("df")).toArrow()  # a row for each bin at most
    df, total = np.zeros(BINS, np.int64), 0
    for b, n in zip(found["bin"].to_pylist(), found["df"].to_pylist(), strict=True):
        if b < 0:
            total = n
        else:
            df[b] = n
    # about four times as many texts of each language as are wanted, so that what is ranked doesn't grow with the table
    fit_for = F.char_length("text") <= train_chars
    often = rows.where(fit_for).groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs)
    mark = F.xxhash64("text")
    low = (F.lit(-(2.0**63)) + F.least(F.lit(1.0), F.lit(4.0 * per_lang) / F.col("count")) * 2.0**64)
    drawn = rows.where(fit_for).withColumn("mark", mark).join(F.broadcast(often), "lang").where(F.col("mark").cast("double") <= low).select("lang", "mark", "text").dropDuplicates(["lang", "mark"])
    place = F.row_number().over(W.partitionBy("lang").orderBy("mark"))
    drawn = drawn.withColumn("place", place).where(F.col("place") <= per_lang).select("lang", "mark", "text")
    got = drawn.mapInArrow(_featured, "lang string, mark long, bins binary, counts binary").toArrow().sort_by([("mark", "ascending"), ("lang", "ascending")])
    of = lambda c: [np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in got[c]]
    return fit_rows(list(zip(got["lang"].to_pylist(), of("bins"), of("counts"), strict=True)), df, total)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score to ``documents`` (which has ``text``)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BINS frequencies, and a weight for each bin and language at most
    plain = [c for c in documents.columns if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in small(batches):
            got = [m.predict(t) for t in b.column("text").to_pylist()]
            own = [pa.array([x for x, _ in got], pa.string()), pa.array([p for _, p in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in plain), *own], [*plain, "lang_pred", "score"])

    rows = documents.select(*plain)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op13(spark: SparkSession, documents: DataFrame) -> DataFrame:
    model = fit(documents.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    return predict(documents.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
