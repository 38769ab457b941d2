"""Language identification: the fit against plain loops, held-out accuracy over the whole table, and odd texts."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from foliant.llm import langid

SF = "/root/testdata/sf0.01"


def test_weights_by_plain_loops():
    """One row and one weight at a time."""
    rnd = random.Random(2)
    size, langs = 9, 3
    rows = [(rnd.randrange(langs), np.array(sorted(rnd.sample(range(size), 4))), np.array([rnd.random() for _ in range(4)])) for _ in range(40)]
    z, n = [[0.0] * langs for _ in range(size)], [[0.0] * langs for _ in range(size)]

    def weight(i, k):
        if abs(z[i][k]) <= langid.LASSO:
            return 0.0
        return -(z[i][k] - math.copysign(langid.LASSO, z[i][k])) / ((langid.BETA + math.sqrt(n[i][k])) / langid.ALPHA + langid.RIDGE)

    for _ in range(2):
        for y, at, v in rows:
            w = {(i, k): weight(i, k) for i in at for k in range(langs)}
            e = [math.exp(sum(x * w[i, k] for i, x in zip(at, v, strict=True))) for k in range(langs)]
            for i, x in zip(at, v, strict=True):
                for k in range(langs):
                    g = (e[k] / sum(e) - (k == y)) * x
                    sigma = (math.sqrt(n[i][k] + g * g) - math.sqrt(n[i][k])) / langid.ALPHA
                    z[i][k] += g - sigma * w[i, k]
                    n[i][k] += g * g
    want = np.array([[weight(i, k) for k in range(langs)] for i in range(size)])
    assert np.allclose(langid.fit_ftrl(rows, size, langs, passes=2), want)
    assert (want == 0).any() or langid.LASSO < 0.1


def test_counts_values_and_temperature_by_plain_loops():
    text = "Ça va? 12 — ÇA va!\n²½ x"
    plain = langid.letters_of(text)
    assert plain == "ça va ça va x"
    bins, counts = langid.counts_of(text)
    grams = [f" {plain} "[i : i + n] for n in langid.GRAMS for i in range(len(plain) + 3 - n)]
    assert counts.sum() == len(grams) and len(bins) == len(set(grams))
    idf = np.linspace(1, 2, langid.BINS)
    v = [(1 + math.log(c)) * idf[b] for b, c in zip(bins, counts, strict=True)]
    assert np.allclose(langid.values_of(bins, counts, idf), np.array(v) / math.sqrt(sum(x * x for x in v)))
    rnd = np.random.RandomState(4)
    margins, y = rnd.randn(200, 3) * 3, rnd.randint(0, 3, 200)
    loss = lambda t: -np.mean(np.log(langid.shares(margins / t)[np.arange(200), y]))
    assert loss(langid.fit_temperature(margins, y)) <= min(loss(t) for t in np.exp(np.linspace(-2.9, 2.9, 200))) + 1e-6
    assert langid.fit_temperature(margins[:0], y[:0]) == 1.0


def test_long_texts_count_alike():
    """Texts on both sides of the length where counting changes."""
    text = "abcde fghij " * 40_000
    bins, counts = langid.counts_of(text)
    few, some = langid.counts_of(text[:12])
    assert set(few) <= set(bins) and counts.sum() > langid.BINS // 16 > some.sum()
    assert np.array_equal(np.unique(bins), bins)


def test_whole_table(spark):
    """Held-out texts, document frequencies of all rows that may be learned from, and no leak of what is held out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in langid.op13(spark, docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in got if got[i].held_out]
    assert len(got) == docs.count() and 200 < len(held) < 300
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    # other labels of held-out rows, other sources: the same
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert {r.doc_id: r for r in langid.op13(spark, other).collect()} == got
    learn = docs.where(~langid.held_out(F.col("doc_id")))
    model = langid.fit(learn)
    df: dict = {}
    texts = [r.text for r in learn.select("text").collect()]
    for t in texts:
        for b in langid.counts_of(t)[0]:
            df[b] = df.get(b, 0) + 1
    n = sum(len(langid.counts_of(t)[0]) > 0 for t in texts)
    want = np.array([math.log((1 + n) / (1 + df.get(b, 0))) + 1 for b in range(langid.BINS)])
    assert np.allclose(model.idf, want)
    assert 0 < len(model.used) < np.count_nonzero(want < want.max())


def test_odd_rows(spark):
    rows = [(0, "the cat and the dog", "en"), (1, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", "de"), (5, "12 ½ ²  !", "en"), (None, "the dog", None), (7, "ß" * 200_000, "de")] * 3
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, lang string, score double, bin string")
    got = langid.op13(spark, df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (3, 4, 5)} == {"und"} and all(by[i].score == 0 for i in (3, 4, 5))
    assert by[0].lang_pred == by[None].lang_pred == "en" and by[1].lang_pred == by[7].lang_pred == "de" and not by[None].held_out
    none = langid.op13(spark, df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    one = {r.doc_id: r for r in langid.op13(spark, df.where("lang = 'en' or lang is null")).collect()}
    assert one[None].lang_pred == "en" and one[None].score == 1
    assert langid.op13(spark, df.limit(0)).count() == 0


def test_sample_has_its_bounds(spark):
    rows = [(f"text {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} of words", "en" if i % 5 else "de") for i in range(600)] + [("copy of one text", "en")] * 300
    df = spark.createDataFrame(rows, "text string, lang string")
    seen = []
    fit_rows = langid.fit_rows
    try:
        langid.fit_rows = lambda r, *a: seen.extend(r) or fit_rows(r, *a)
        langid.fit(df, per_lang=40)
    finally:
        langid.fit_rows = fit_rows
    by = [sum(r[0] == x for r in seen) for x in ("de", "en")]
    assert 20 <= by[0] <= 40 and 20 <= by[1] <= 40
