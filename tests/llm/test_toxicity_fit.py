"""The toxicity fit by plain loops: which rows are learned from, the log-count ratios, and the weights, on the smallest tables."""

import math
import zlib

import numpy as np

from foliant.llm import toxicity

SF = "/root/testdata/sf0.001"
MASK = 0xFFFFFFFF


def plain_bins(text):
    """Distinct bins of a text, one n-gram at a time."""
    c = [ord(x) + 1 for x in f"\n{text.lower()}\n"]
    out = set()
    for n in toxicity.GRAMS:
        for i in range(len(c) - n + 1):
            h = c[i]
            for x in c[i + 1 : i + n]:
                h = (h * 0x01000193 & MASK) ^ (x * 0x85EBCA6B & MASK)
            h = (h ^ h >> 15) * 0x2C1B3C6D & MASK
            out.add((h ^ h >> 13) >> 32 - toxicity.BITS)
    return out


def plain_fit(rows, lasso, steps, least_df):
    """(weights by bin, bias) by the module's rule: ratios of smoothed counts, then proximal steps with momentum on the squared hinge."""
    df = {}
    for _, bins in rows:
        for b in bins:
            df[b] = df.get(b, 0) + 1
    used = sorted(b for b, n in df.items() if n >= least_df)
    p, q = dict.fromkeys(used, 1.0), dict.fromkeys(used, 1.0)
    for y, bins in rows:
        for b in bins:
            if b in p:
                (p if y else q)[b] += 1
    sp, sq = sum(p.values()), sum(q.values())
    ratio = {b: math.log(p[b] / sp) - math.log(q[b] / sq) for b in used}
    norm = math.sqrt(sum(ratio[b] ** 2 * df[b] for b in used) / len(rows))
    scale = {b: ratio[b] / norm for b in used}
    ones = sum(y for y, _ in rows)
    mass = [0.5 / ones if y else 0.5 / (len(rows) - ones) for y, _ in rows]
    own = [[b for b in bins if b in scale] for _, bins in rows]
    w, vw, bias, vb = dict.fromkeys(used, 0.0), dict.fromkeys(used, 0.0), 0.0, 0.0
    for k in range(steps):
        g = []
        for (y, _), m, bins in zip(rows, mass, own, strict=True):
            side = 2 * y - 1
            g.append(-2 * m * side * max(0.0, 1 - side * (sum(scale[b] * vw[b] for b in bins) + vb)))
        slope = dict.fromkeys(used, 0.0)
        for x, bins in zip(g, own, strict=True):
            for b in bins:
                slope[b] += x
        push = k / (k + 3)
        new = {}
        for b in used:
            x = vw[b] - 1.5 * scale[b] * slope[b]
            new[b] = math.copysign(max(abs(x) - 1.5 * lasso, 0.0), x)
        nb = vb - 1.5 * sum(g)
        vw = {b: new[b] + push * (new[b] - w[b]) for b in used}
        vb, w, bias = nb + push * (nb - bias), new, nb
    return {b: w[b] * scale[b] * toxicity.SLOPE for b in used}, bias * toxicity.SLOPE


def test_the_fit_of_a_whole_table(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = []
    monkeypatch.setattr(toxicity, "fit_rows", lambda rows, *a, **k: seen.extend(rows))
    toxicity.fit(docs, labels)
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    learn = [(int(marks[r.doc_id]), plain_bins(r.text)) for r in docs.collect() if marks.get(r.doc_id) in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.text and len(r.text) <= toxicity.TRAIN_CHARS]
    assert sorted((y, sorted(b)) for y, b in learn) == sorted((y, b.tolist()) for y, b in seen)
    monkeypatch.undo()
    few = [(y, b) for y, b in learn if len(b) < 4000]
    assert {y for y, _ in few} == {0, 1} and len(few) > 30
    model = toxicity.fit_rows([(y, np.array(sorted(b), np.int32)) for y, b in few], lasso=2e-4, steps=8, least_df=4)
    weights, bias = plain_fit(few, 2e-4, 8, 4)
    assert math.isclose(model.bias, bias, rel_tol=1e-6, abs_tol=1e-9)
    got = {int(b): float(model.weights[b]) for b in np.flatnonzero(model.weights)}
    assert all(math.isclose(got.get(b, 0.0), w, rel_tol=1e-4, abs_tol=1e-6) for b, w in weights.items()) and set(got) <= set(weights)
    assert len(got) > 100


def test_a_fit_holds_few_bytes_for_each_bin_of_a_text():
    import tracemalloc

    r = np.random.default_rng(3)
    rows = [(i % 2, np.sort(r.permutation(40_000)[:20_000]).astype(np.int32)) for i in range(300)]
    tracemalloc.start()
    try:
        toxicity.fit_rows(rows, steps=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 22 * 300 * 20_000  # 15.8 measured, 30.1 with weights for all bins at once
