"""Ranked search against a plain loop over all documents and items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from foliant.llm import lemp

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]


def plain(docs, items, most=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:most])]
    return out


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, "x", 1.5) for d in docs], "doc_id long, text string, item_id string, norm double"),
        spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, doc_id long"),
    )


def order(rows):
    return sorted(rows, key=lambda r: [(v is None, v) for v in r])


@pytest.mark.parametrize("bucket,block_words", [(2048, 500_000), (16, 30)])
def test_ties_nulls_copies_and_blocks(spark, bucket, block_words, monkeypatch):
    """Several buckets and several blocks of items give the same rows as one."""
    monkeypatch.setattr(lemp, "BUCKET", bucket)
    rnd = random.Random(bucket)
    words = [f"w{i}" for i in range(40)] + ["Été", "été", "ÉTÉ", "x1"]
    text = lambda n: " ".join(rnd.choice(words[: rnd.choice((5, 20, 44))]) for _ in range(n))
    docs = [(i, text(rnd.randrange(1, 60))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in (1000, 1001, None, None)] + [(5, docs[7][1])] * 3 + [(2000, None), (2001, ""), (2002, "?!"), (2003, "w1 " * 30_000)]
    items = [(i, text(rnd.randrange(1, 15))) for i in range(12)] + [(3, "w39 w1"), (None, "W1, w2"), (20, None), (21, "..."), (22, "nowhere"), (23, docs[7][1])]
    got = [tuple(r) for r in lemp.top_documents(*frames(spark, docs, items), most=10, block_words=block_words).collect()]
    assert order(got) == order(plain(docs, items, 10))


def test_nothing_to_search_and_weights_of_nothing(spark):
    docs, items = frames(spark, [(1, "a b"), (2, "a")], [(1, "a")])
    assert lemp.top_documents(docs.limit(0), items).count() == lemp.top_documents(docs, items.limit(0)).count() == 0
    many = spark.range(3000).selectExpr("id as doc_id", "'a' as text")
    assert lemp.weight(3000, 3000) == 0 and lemp.top_documents(many, items).count() == 0


def test_bounds_prune_and_lose_nothing():
    """Survivors hold every vector that reaches the bound, and are few where the bound is high."""
    rnd = np.random.RandomState(0)
    rows = [np.sort(rnd.choice(200, rnd.randint(1, 30), replace=False)).astype(np.int32) for _ in range(400)]
    xs = [rnd.randint(1, 10**9, len(r)) for r in rows]
    norms = np.array([math.sqrt(float((x.astype(float) ** 2).sum())) for x in xs])
    bucket = lemp.Bucket(np.arange(400), norms, [r.tobytes() for r in rows], [x.tobytes() for x in xs], 200)
    kept = 0
    for _ in range(50):
        item = rnd.choice(200, 8, replace=False)
        want = np.array([int(x[np.isin(r, item)].sum()) for r, x in zip(rows, xs, strict=True)])
        bound = max(1, int(np.sort(want)[-5]))
        found = bucket.survivors(item, bound)
        assert set(bucket.ids[found]) >= set(np.flatnonzero(want >= bound))
        kept += len(found)
        asked = np.zeros(200, bool)
        asked[item] = True
        every = np.arange(400)
        assert np.array_equal(bucket.scores(every, asked), want[bucket.ids])
    assert kept < 0.25 * 50 * 400
