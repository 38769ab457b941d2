"""Operators as Spark jobs: small fixtures with nulls, empty and repeated rows, and brute force over small tables."""

import base64
import collections
import hashlib
import html.parser
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliant.llm.common import keep
from foliant.llm.pieces import MODEL, load_pieces
from foliant.llm import chat, codec, decontaminate, htmltext, neardup, queries, syncmers, tokencount, toxicity, urlfilter, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (4, "   "), (5, "x" * 5000), (None, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (7, "one")]


def odd(spark):
    """Nulls, empties, a long run, repeated rows, and columns named like results."""
    return spark.createDataFrame([(i, t, "q", 0.5, ["z"]) for i, t in ODD], "doc_id long, text string, n_words string, score double, items array<string>")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(str([r[c] for c in cols]) for r in df.collect())
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations", "labels"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = c.execute(queries.ORACLES[name])
    names = [d[0] for d in rel.description]
    assert got == sorted(str([r[names.index(x)] for x in cols]) for r in rel.fetchall())


def test_warc(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "x\r\nWARC-Type: evil", ""), (None, "http://c", "same"), (2, "http://b", "same"), (9, "u", "é" * 9)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, sha256 int")
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.op1(spark, pages).collect()]
    want = [(1, 4, "revisit", 2), (2, 4, "response", None), (2, 4, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (None, 4, "revisit", 2), (9, 18, "response", None)]
    assert sorted(got, key=str) == sorted(want, key=str)
    digest = {r.page_id: r.payload_digest for r in warc.op1(spark, pages).collect()}
    assert digest[9] == base64.b32encode(hashlib.sha1(("é" * 9).encode()).digest()).decode()
    assert warc.op1(spark, pages.where("false")).count() == 0
    path = str(tmp_path / "a")
    warc.write_archive(pages, path, min_revisit_bytes=5)
    records = warc.read_archive(spark, path)
    assert records.where(warc.header_field("WARC-Type") == "revisit").count() == 0
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    warc.export_warc(records, str(tmp_path / "w"))
    import gzip

    data = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    assert data.count(b"WARC/1.1\r\n") == 7 and data.count(b"same\r\n\r\n") == 4
    bad = spark.read.parquet(f"{path}/payloads").withColumn("member", F.lit(gzip.compress(b"other")))
    bad.write.parquet(f"{path}/bad")
    (tmp_path / "a/payloads").rename(tmp_path / "a/old")
    (tmp_path / "a/bad").rename(tmp_path / "a/payloads")
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, path).collect()


def murmur(values):
    """Spark's ``hash`` of ints and strings."""
    def mixed(h, k):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        return h * 5 + 0xE6546B64 & 0xFFFFFFFF

    h = 42
    for v in values:
        if isinstance(v, str):
            b = v.encode()
            n, size = len(b) - len(b) % 4, len(b)
            for i in range(0, n, 4):
                h = mixed(h, int.from_bytes(b[i : i + 4], "little"))
            for x in b[n:]:  # a byte is a signed word
                h = mixed(h, (x - 256 if x > 127 else x) & 0xFFFFFFFF)
        else:
            h, size = mixed(h, v & 0xFFFFFFFF), 4
        h ^= size
        for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            h = (h ^ h >> shift) * by & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def anchors_of(text, k=syncmers.K, s=syncmers.S):
    """(word number, hash) of each closed syncmer, by its definition."""
    signs = re.compile("[\u2e80-\u2fdf\u3005\u3007\u3021-\u3029\u3038-\u303b\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fd-\u30ff\uac00-\ud7a3\u0e01-\u0e3a\u0e40-\u0e5b]")
    words = []
    for run in re.findall("[^ \t\n\x0b\f\r]+", text):
        for part in re.split(f"({signs.pattern})", run):
            words += [part] if signs.fullmatch(part) else [part[i : i + 16] for i in range(0, len(part), 16)]
    h = [murmur([w]) for w in words]
    pair = [murmur(x) for x in zip(h, h[1:], strict=False)]
    four = [murmur(x) for x in zip(pair, pair[2:], strict=False)]
    five = [murmur(x) for x in zip(four, four[1:], strict=False)]
    found = [(i, five[i]) for i in range(max(0, len(words) - k + 1)) if min(pair[i : i + k - s + 1]) in (pair[i], pair[i + k - s])]
    return found or list(enumerate(h)) or ([(0, murmur([text]))] if text else [])


def steps_of(anchors):
    return {(a, b, q - p) for (p, a), (q, b) in zip(anchors, anchors[1:], strict=False)} or {a for _, a in anchors}


def share(x, y):
    return len(x & y) / len(x | y) if x or y else 1.0


def fingerprints(docs):
    """All of op2 for (doc_id, text), in plain Python."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    out = []
    for (i, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        e = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        a, b, c = anchors_of(t), anchors_of(e), anchors_of(u)
        shown = lambda x: ",".join(str(h) for _, h in x)
        out.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), shown(a), shown(b), round(share(steps_of(a), steps_of(b)), 9), round(share(steps_of(a), steps_of(c)), 9)))
    return sorted(out)


def test_op2_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in syncmers.op2(spark, docs).collect()]
    assert sorted(got) == fingerprints([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_op2_edits_and_neighbours(spark):
    docs = [(10 * i, " ".join(random.Random(i).choice(["red", "green", "blue", "sun", "moon", "tree"]) for _ in range(i * 7))) for i in range(1, 30)]
    docs += [(5, None), (None, "n u l l"), (20, "twice"), (20, "twice"), (7, "漢字 kana 漢 x" * 3), (8, "x" * 50_000), (9, "word " * 30_000), (6, "  "), (4, "a b")]
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in docs], "doc_id long, text string, anchors string, key int")
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in syncmers.op2(spark, df).collect()]
    assert sorted(got) == fingerprints(docs)
    assert syncmers.op2(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = syncmers.op2(spark, spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def digest_rows(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect())


@pytest.mark.parametrize("hot", [500, None, 0])
def test_op2_of_an_id_that_repeats(spark, hot):
    """One id, or none, in a third of the rows, some of them alike, among, before or after the others."""
    docs = [(i, f"{i} apart {i % 7} from the {i % 5} others as it is") for i in range(1, 1001)]
    docs += [(hot, f"{i * 37 % 450:03d} of the same id {i % 3} in a third of the rows") for i in range(450)] + [(hot, "same text in many rows")] * 90
    random.Random(3).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert digest_rows(syncmers.op2(spark, df)) == fingerprints(docs)
    ids = df.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("key"))
    bounds, many, size = syncmers._ranges(ids, 4)
    assert many == [-(2**63) if hot is None else hot] and len(bounds) > 40 and size == 17


def test_op2_of_one_id_only(spark):
    docs = [(4, f"{i:03d} words of one id and no other") for i in range(300)]
    assert digest_rows(syncmers.op2(spark, spark.createDataFrame(docs, "doc_id long, text string"))) == fingerprints(docs)
    same = [(None, "one text")] * 300
    assert digest_rows(syncmers.op2(spark, spark.createDataFrame(same, "doc_id long, text string"))) == fingerprints(same)


def test_op2_gives_no_task_more_than_its_share(spark):
    """Most rows that share a range or a block, where one id has half of all rows."""
    docs = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, 77).otherwise(F.col("id")).alias("doc_id"), F.concat(F.sha1(F.col("id").cast("string")), F.lit(" a b")).alias("text"))
    seen = []
    whole = syncmers.with_anchors
    try:
        syncmers.with_anchors = lambda df, *a: seen.append(df) or whole(df, *a)
        syncmers.with_next(docs)
    finally:
        syncmers.with_anchors = whole
    sizes = seen[0].groupBy("of", "b").count().agg(F.max("count"), F.sum("count"), F.count("*")).first()
    assert sizes[0] < 40_000 / 96 * 3 and sizes[1] < 40_000 + 3 * sizes[2] and sizes[2] > 80


def test_op2_shuffles_texts_once(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    plan = syncmers.op2(spark, docs)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(b#\d+L, 4\), REPARTITION", plan)) == 1
    window = plan.index("Window [lead(")  # from here down to the sort, no other shuffle of what the window reads
    assert "Exchange" not in plan[window : plan.index("Exchange hashpartitioning(b#")]


def test_op2_plan_does_not_grow_with_partitions(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    plan = lambda: len(syncmers.with_next(docs)._jdf.queryExecution().analyzed().toString().replace("\n", " ").split("from_json"))
    few = plan()
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert plan() == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_matching_goes_by_place(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    shuffled = [" ".join(words[i : i + 5]) for i in range(0, 400, 5)]
    rnd.shuffle(shuffled)
    texts = [" ".join(words), "new start " + " ".join(words), " ".join(shuffled)]
    a, b, c = (steps_of(anchors_of(t)) for t in texts)
    assert share(a, b) > 0.95  # moved as a whole
    plain = lambda t: {h for _, h in anchors_of(t)}
    assert share(a, c) < 0.5 * share(plain(texts[0]), plain(texts[2]))


def test_toxicity_cases(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a = {r.doc_id: r for r in toxicity.op3(spark, docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in a.items())
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {i: r.score for i, r in a.items()} == {r.doc_id: r.score for r in toxicity.op3(spark, docs, flipped).collect()}
    out = toxicity.op3(spark, odd(spark), labels.where("false")).collect()
    assert len(out) == len(ODD) and {r.score for r in out} == {0.5}
    assert toxicity.op3(spark, odd(spark).where("false"), labels).count() == 0


def test_scores_of_a_whole_table_by_plain_loops(spark):
    """Every score again from the n-grams of the text, one by one, with the fitted weights."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in toxicity.op3(spark, docs, labels).collect()}
    m = 0xFFFFFFFF
    assert len(got) == docs.count() and np.count_nonzero(model.weights) > 50
    for r in docs.select("doc_id", "text").collect():
        c = [ord(x) + 1 for x in f"\n{r.text.lower()}\n"] if r.text else []
        bins = set()
        for i in range(len(c)):
            h = c[i]
            for n in range(2, 6):
                if i + n > len(c):
                    break
                h = (h * 0x01000193 & m) ^ (c[i + n - 1] * 0x85EBCA6B & m)
                if n > 2:
                    x = (h ^ h >> 15) * 0x2C1B3C6D & m
                    bins.add((x ^ x >> 13) >> (32 - toxicity.BITS))
        z = model.bias + sum(float(model.weights[b]) for b in bins)
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5)


def test_toxicity_is_caught_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op3(spark, docs, labels).join(labels, "doc_id").where("held_out").collect()
    caught = [r.predicted for r in rows if r.toxic == 1]
    assert sum(caught) >= 0.7 * len(caught) and sum(r.predicted for r in rows if r.toxic == 0) <= 1


def test_toxicity_labels_that_repeat_or_lack(spark):
    docs = spark.createDataFrame([(i, ("bad awful " if i % 2 else "good kind ") * 5) for i in range(40)] * 2 + [(None, "bad"), (3, None)], "doc_id long, text string")
    marks = [(i, i % 2) for i in range(40)] + [(0, None), (None, 1), (2, 0), (2, 0), (7, 0), (9, 5)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    out = toxicity.op3(spark, docs, labels).collect()
    assert len(out) == 82
    scores = {}
    for r in out:
        scores.setdefault((r.doc_id or 0) % 2 if r.doc_id is not None else None, []).append(r.score)
    assert min(x for x in scores[1]) > 0.5 or len([x for x in scores[1] if x < 0.5]) == 1  # the null text of id 3
    assert max(scores[0]) < 0.5


def test_decontamination_cases(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma", "k"), (2, "delta", "k"), (None, "zeta", "k"), (3, None, "k"), (4, "...", "k"), (2, "one", "k")], "item_id long, text string, ranges string")
    one = {r.doc_id: r for r in decontaminate.op4(spark, odd(spark), items).collect()}
    assert (one[1].n_words, one[1].n_hit, one[1].n_items, one[1].contaminated) == (6, 5, 2, True)
    assert one[1].items_sha256 == hashlib.sha256(b"1,2").hexdigest()
    assert (one[2].n_words, one[3].n_hit, one[4].contaminated) == (0, 0, False) and one[7].n_items == 1
    docs = odd(spark).select("doc_id", "text")
    whole = decontaminate.judge(decontaminate.find_items(docs, items))
    parts = decontaminate.judge(decontaminate.find_items(docs, items, block_words=3))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(whole, 3).collect()}
    assert cut[1] == " epsilon zeta" and cut[7] == "one"
    assert decontaminate.op4(spark, odd(spark), items.where("false")).where("n_hit > 0").count() == 0


def exact_components(docs, size, percent=80):
    sets = []
    for _, t in docs:
        w = neardup.words_of(t)
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for i, (d, _) in enumerate(docs):
        ids = [docs[k][0] for k in groups[find(i)] if docs[k][0] is not None]
        c = d if not sets[i] else min(ids, default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(map(str, out))


def test_near_duplicates_against_all_pairs(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(120)]
    docs = list(ODD)
    for i in range(160):  # a crowd round one text; many members are near it and not each other
        t = list(base)
        for _ in range(rnd.choice([0, 2, 5, 6, 7, 9])):
            t[rnd.randrange(len(t))] = f"n{rnd.random()}"
        docs.append((100 + i, " ".join(t)))
    for i in range(30):
        t = [rnd.choice(words) for _ in range(rnd.randint(2, 90))]
        docs += [(1000 + 3 * i, " ".join(t)), (1001 + 3 * i, " ".join(t[:-1] + ["Q"])), (1002 + 3 * i, " ".join(t).upper())]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, node int, row string")
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in neardup.op5(spark, df).collect())
    assert got == exact_components(docs, 2)
    assert neardup.op5(spark, df.where("false")).count() == 0


def test_crowded_region_of_many_sizes(spark):
    """One region round a shared passage; the pairs are of sizes that no node of another pair, or the hub, is linked with."""
    passage = list(range(1, 101))
    members = [passage + [1000 + i] for i in range(70)]
    for k, size in enumerate([30, 60, 140, 200, 300, 450, 700]):
        own = [10_000 * (k + 1) + i for i in range(size)]
        members += [passage[: size // 2] + own, passage[: size // 2] + own[2:]]
    rows = [(bytes([i]) * 16, sorted(m)) for i, m in enumerate(members)]
    sets = spark.createDataFrame([(b, np.array(m, np.uint64).tobytes()) for b, m in rows], "node binary, members binary")
    region = spark.createDataFrame([(7, b, len(m), len(rows)) for b, m in rows], "key long, node binary, n long, count long")
    none = spark.createDataFrame([], "node binary, root binary")
    stars = neardup._stars(region.withColumn("root", F.col("node")), region, sets, 80, keep)
    root_of = neardup.joined(none, stars.where("linked").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    links = neardup._apart(stars, root_of, 80, keep)
    root = {r.node: r.root for r in neardup.joined(root_of, links).collect()}
    near = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    want = {b: b for b, _ in rows}
    for a, x in rows:
        for b, y in rows:
            if a < b and near(set(x), set(y)) and want[a] != want[b]:
                old, new = want[b], want[a]
                want = {k: new if v == old else v for k, v in want.items()}
    classes = lambda of: {frozenset(k for k in want if of(k) == r) for r in {of(k) for k in want}}
    assert classes(lambda k: root.get(k, k)) == classes(want.get) and len(set(want.values())) == 1 + 7


def test_depth_adapts_to_the_region(spark):
    """Each node lies in the largest region of at most ``REGION`` nodes round it, or in none if there is none of two or more."""
    rnd = random.Random(11)
    rows = []
    for key, size in ((1, 66), (2, 120), (3, 65), (4, 700)):
        for i in range(size):
            values = [rnd.choice([1, 1, 1, 2]) for _ in range(4)] if key != 3 else [9, 9, 9, i % 2]
            rows.append((key, sum(v << 16 * (3 - j) for j, v in enumerate(values)), bytes([key, i // 256, i % 256]), 10, size))
    region = spark.createDataFrame(rows, "key long, tail long, node binary, n long, count long").withColumn("root", F.col("node"))
    got = {}
    for r in neardup._leaves(region, keep).collect():
        assert (r.key, r.node) not in got
        got[r.key, r.node] = (r.depth, r.prefix)
        assert r.root == r.node
    for key, tail, node, *_ in rows:
        want = None
        for depth in range(neardup.BASE + 1, neardup.DEPTH + 1):
            cut = tail >> 16 * (neardup.DEPTH - depth)
            n = sum(k == key and t >> 16 * (neardup.DEPTH - depth) == cut for k, t, *_ in rows)
            if n <= neardup.REGION:
                want = (depth, cut) if n > 1 else None
                if n > 1:
                    break
        assert got.get((key, node)) == want
    assert {d for d, _ in got.values()} >= {5, 6, 8}


def test_one_hub_against_all_pairs(spark):
    """Sets that stray from one text by edits of a small stock, so that differences are shared and few pairs are linked with the hub."""
    rnd = random.Random(4)
    rows = []
    for i in range(150):
        gone, new = rnd.sample(range(100), rnd.randint(2, 22)), rnd.sample(range(200, 230), rnd.randint(0, 18))
        rows.append((bytes([i]) * 16, sorted(set(range(100)).difference(gone).union(new))))
    sets = spark.createDataFrame([(b, np.array(m, np.uint64).tobytes()) for b, m in rows], "node binary, members binary")
    region = spark.createDataFrame([(7, b, len(m), len(rows)) for b, m in rows], "key long, node binary, n long, count long")
    none = spark.createDataFrame([], "node binary, root binary")
    stars = neardup._stars(region.withColumn("root", F.col("node")), region, sets, 80, keep)
    root_of = neardup.joined(none, stars.where("linked").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    root = {r.node: r.root for r in root_of.collect()}
    got = {(r.a, r.b) for r in neardup._apart(stars, root_of, 80, keep).collect()}
    near = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    want = {(a, b) for a, x in rows for b, y in rows if a < b and near(set(x), set(y)) and root.get(a, a) != root.get(b, b)}
    hub = stars.first().hub
    assert got == {p for p in want if hub not in p} and len(got) > 100


def test_trees_share_no_key_value():
    assert sorted(c for order in neardup.ORDERS for c in order[: neardup.BASE]) == list(range(neardup.POOL))
    assert all(len(set(order)) == neardup.DEPTH for order in neardup.ORDERS)


def test_url_filter_cases(spark):
    urls = [None, "", "no scheme", "http://X.NET", "http://x.net/", "https://a.example.net/en/x?y", "http://example.com/de/1#z", "http://b.org/fr/", "http://evilnet/", "http://q.example.org/en/1?u=http://x.net/"]
    pages = spark.createDataFrame([(i, u, "<p>the of and the</p>", "r") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in urlfilter.op6(spark, pages).collect()}
    want = [("", "", None)] * 3 + [("x.net", "", None), ("x.net", "/", "net/"), ("a.example.net", "/en/x", "example.net/en/"), ("example.com", "/de/1", "example.com/de/"), ("b.org", "/fr/", "org/fr/"), ("evilnet", "/", None), ("q.example.org", "/en/1", None)]
    assert [got[i] for i in range(len(urls))] == want
    assert {r.verdict for r in urlfilter.op6(spark, pages).collect()} <= {"allow", "block"}
    assert urlfilter.op6(spark, pages.where("false")).count() == 0


def verdicts(pages, rules=urlfilter.RULES):
    """All of op6 for (page_id, url, html), in plain Python."""
    counts = collections.Counter()
    for _, _, h in pages:
        counts.update(re.findall(r"[^\W\d_]+", re.sub(r"<[^>]*>", " ", re.sub(r"(?is)<(script|style)\b.*?</\1\s*>", " ", h or "")).lower()))
    total = sum(counts.values()) or 1
    whole = lambda x: round(x * 1e9)

    def split(name):
        best = [(0, 0)]
        for end in range(1, len(name) + 1):
            options = []
            for i in range(end):
                w = name[i:end]
                options.append((best[i][0] + (whole(math.log(counts[w] / total)) if w in counts else whole(math.log(10 / total)) - len(w) * whole(math.log(10))), -i))
            best.append(max(options))
        out, end = [], len(name)
        while end:
            out.append(name[-best[end][1] : end])
            end = -best[end][1]
        return out

    rows, seen = [], {"block": collections.Counter(), "allow": collections.Counter()}
    urls = collections.Counter()
    for i, u, _ in pages:
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
        fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        words = [(k, w) for k, t in (("h", host.lower()), ("p", path.lower())) for n in re.findall(r"[^\W\d_]+", t) for w in split(n)]
        _, v, rule = max(fits, default=(0, None, None))
        if v:
            seen[v].update(words)
            urls[v] += 1
        rows.append([i, host, path, rule, v, words])
    x, y = seen["block"], seen["allow"]
    v = len(set(x) | set(y))
    base = math.log(sum(y.values()) + v + 1) - math.log(sum(x.values()) + v + 1)
    for r in rows:
        if r[4] is None:
            ready = urls["block"] and urls["allow"]
            z = (whole(math.log(urls["block"]) - math.log(urls["allow"])) + sum(whole(math.log(x[w] + 1) - math.log(y[w] + 1) + base) if w in x or w in y else whole(base) for w in r[5])) if ready else 0
            r[4] = "block" if z > 0 else "allow"
    return sorted(map(str, (tuple(r[:5]) for r in rows)))


def test_url_filter_of_a_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = [tuple(r) for r in urlfilter.op6(spark, pages).collect()]
    assert sorted(map(str, got)) == verdicts([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


def test_url_filter_of_odd_pages(spark):
    text = "<p>news sport shop money free the of</p><script>var secretword</script>"
    urls = ["http://freemoney.net/shop", "http://money.net/free/", "http://news.org/fr/sport", "http://sportnews.org/fr/", "http://moneyshop.com/free", "http://newssport.com/sport", None, "", "x", "http://" + "freemoney" * 300 + ".com/", "http://secretword.com/é/ÉÀ", "http://newssport.com/sport", "HTTP://NEWSsport.com/Sport%20"]
    rows = [(i, u, text if i % 3 else None) for i, u in enumerate(urls)] + [(None, "http://freemoney.com/", ""), (3, "http://money.net/free/", text)]
    df = spark.createDataFrame([(*r, 1, "q", 2) for r in rows], "page_id long, url string, html string, n int, host string, id int")
    got = sorted(str(tuple(r)) for r in urlfilter.op6(spark, df).collect())
    assert got == verdicts(rows)
    assert {eval(r)[4] for r in got if eval(r)[3] is None} == {"block", "allow"}
    # a tie allows: as many of either class, and words that neither has
    even = spark.createDataFrame([(1, "http://a.net/", None), (2, "http://b.org/fr/", None), (3, None, None)], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in urlfilter.op6(spark, even).collect()}[3] == "allow"


def test_tokens_and_codec_cases(spark):
    counts = sorted((str(r.doc_id), r.n_tokens) for r in tokencount.op7(spark, odd(spark)).collect())
    coded = codec.op8(spark, odd(spark)).collect()
    assert counts == sorted((str(r.doc_id), r.n_tokens) for r in coded)
    assert all(r.round_trip and r.n_tokens == len(r.token_ids) for r in coded)
    assert codec.op8(spark, odd(spark).where("false")).count() == 0


def test_tokens_of_a_whole_table_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    coded = codec.op8(spark, docs).collect()
    assert len(coded) == len(texts)
    for r in coded:
        assert r.token_ids == sp.encode(texts[r.doc_id]) and r.n_tokens == len(r.token_ids) and r.round_trip
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert {r.doc_id: r.n_tokens for r in tokencount.op7(spark, docs).collect()} == {r.doc_id: len(r.token_ids) for r in coded}


def test_codec_columns_and_long_units(spark):
    pieces = load_pieces()
    df = spark.createDataFrame([("x" * 200_000, 1, 5), ("▁ a▁", 2, 5), (None, 3, 5)], "text string, doc_id long, token_ids int")
    rows = codec.decode(codec.encode(df, pieces), pieces).orderBy("doc_id").collect()
    assert [r.decoded for r in rows] == ["x" * 200_000, "▁ a▁", ""] and all(r.round_trip for r in codec.round_trip(df, pieces).collect())
    over = codec.encode(df.select("text", "doc_id"), pieces, out="text").orderBy("doc_id").collect()
    assert [r.text for r in over] == [r.token_ids for r in rows]
    counts = tokencount.token_counts(df, pieces).orderBy("doc_id").collect()
    assert [r.n_tokens for r in counts] == [len(r.token_ids) for r in rows]


def test_html_cases(spark):
    rows = spark.createDataFrame([(1, "u", "<article>é x</article>", 5), (2, None, None, 5), (None, "v", "", 5), (None, "v", "", 5)], "page_id long, url string, html string, n_chars int")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in htmltext.op9(spark, rows).collect()) == [("1", "é x", 3), ("2", "", 0), ("None", "", 0), ("None", "", 0)]
    assert htmltext.op9(spark, rows.where("false")).count() == 0


def test_very_long_texts_of_archive_and_benchmark(spark):
    body = "<p>é</p>" * 400_000
    pages = spark.createDataFrame([(1, "u", body), (2, "u", body), (3, "v", body + "!")], "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.op1(spark, pages).collect()}
    n = len(body.encode())
    assert got == {1: (n, "revisit", 2), 2: (n, "response", None), 3: (n + 1, "response", None)}
    item = " ".join(f"i{k}" for k in range(30))
    docs = spark.createDataFrame([(1, "w " * 300_000 + item), (2, item + " w" * 100)], "doc_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.op4(spark, docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1].contaminated) == (300_030, 30, False) and (rows[2].n_hit, rows[2].contaminated) == (30, True)


class ArticleText(html.parser.HTMLParser):
    """The text of a page's article, apart from adverts: another parser than the operator's."""

    ENDS = frozenset("h1 h2 h3 p div br ul ol li table tr td article".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.advert, self.blocks = False, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.advert += tag == "div" and (self.advert > 0 or ("class", "ad") in attrs)
        if tag in self.ENDS:
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        self.advert -= tag == "div" and self.advert > 0
        if tag in self.ENDS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.advert:
            self.blocks[-1] += data


def test_html_of_a_whole_table_by_another_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in htmltext.op9(spark, pages).collect()}
    for r in pages.collect():
        p = ArticleText()
        p.feed(r.html or "")
        p.close()
        want = "\n".join(t for b in p.blocks if (t := re.sub("[ \t\n\r\f]+", " ", b).strip(" ")))
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_chat_cases(spark):
    rows = [(1, 0, "user", "a#<\\b"), (1, 1, "assistant", None), (1, 1, "assistant", "b</turn>\n"), (None, 0, None, "n"), (2, None, "assistant", ""), (3, 0, "assistant", "z" * 3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, tree string")
    got = {r.conv_id: r for r in chat.op10(spark, df).collect()}
    said = "user\na#<\\b\nassistant\n\nassistant\nb</turn>\n\n"
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[1].n_turns == 3
    assert got[1].loss_sha256 == hashlib.sha256(b"b</turn>\n").hexdigest() and got[3].loss_chars == 3000
    assert got[None].n_turns == 1 and got[-7].loss_chars == len("\\### Assistant: </turn> ok")
    assert {r.conv_id for r in chat.op10(spark, df.where("false")).collect()} == {-7}


def test_chat_with_markers_in_roles_and_texts(spark):
    """Every role and text comes back, by brute force over conversations of marks."""
    rnd = random.Random(5)
    bits = ["### ", ": ", "</turn>", "\n", "\\", "\\c", "\\b", ":", "#", "<", "\\l", "é", "a"]
    mess = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9)))
    rows = [(c, t, rnd.choice(["assistant", "tool: search", mess()]), mess()) for c in range(40) for t in range(rnd.randint(1, 5))]
    got = {r.conv_id: r for r in chat.op10(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for c in range(40):
        turns = [(r, x) for k, _, r, x in rows if k == c]
        learned = "".join(x for r, x in turns if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest() and got[c].n_turns == len(turns)
        assert got[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and got[c].loss_chars == len(learned)


def test_reply_trees(spark):
    tree = [(1, 1, None, 0.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 9.0), (1, 5, 3, 2.0), (1, 6, 99, 1.0)] + [(2, i, i - 1 if i else None, 1.0) for i in range(40)]
    n = spark.createDataFrame([(*r, "user" if r[1] % 2 else "assistant", f"t{r[1]}") for r in tree], "tree long, node long, parent long, score double, role string, text string")
    paths = {}
    for r in chat.reply_paths(n, None).collect():
        paths.setdefault((r.tree, r.leaf), {})[r.up] = r.node
    assert paths[(1, 4)] == {0: 4, 1: 2, 2: 1} and paths[(1, 5)] == {0: 5, 1: 3, 2: 1} and paths[(1, 6)] == {0: 6}
    assert paths[(2, 39)] == {u: 39 - u for u in range(40)}
    chats = {r.tree: r.formatted for r in chat.format_chats(n).collect()}
    assert chats[1] == "### user: t1</turn>\n### assistant: t2</turn>\n### assistant: t4</turn>\n"
    with pytest.raises(ValueError, match="circle"):
        chat.reply_paths(spark.createDataFrame([(1, 1, 2, 0.0), (1, 2, 1, 0.0)], "tree long, node long, parent long, score double"))


def test_near_copies_leave_one_row_of_a_group(spark):
    a, b = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    own = [(1, a), (1, a), (1, a), (1, f"{a} z"), (2, a), (None, a), (None, b), (None, b), (None, f"{b} z"), (5, "stands alone"), (5, "stands alone"), (6, ""), (6, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in own], DOCS).repartition(3)
    got = [(r.doc_id, (r.text or "")[:2]) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, "a0"), (None, "b0"), (5, "st"), (6, ""), (6, ""), (None, "")], key=str)


def test_near_duplicates_of_a_whole_table(spark):
    """All links of sf0.01 at five words, by all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in neardup.near_duplicates(docs).collect())
    assert got == exact_components(rows, 5)


def write_tables(spark, path, docs, labels, items):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_from_end_to_end(spark, tmp_path):
    """run() against the stages in plain Python: what is toxic, a copy or of the benchmark goes; nulls, empties and long texts stay."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghijklmno") for _ in range(6))
    texts = [" ".join(word() for _ in range(rnd.randint(30, 60))) for _ in range(60)]
    docs = [(i, t + (" idiot moron stupid" * 4 if i % 4 == 0 else "")) for i, t in enumerate(texts)]
    item = " ".join(word() for _ in range(20))
    docs += [(100, texts[1]), (101, texts[1] + " more"), (102, item + " a b c"), (103, None), (104, ""), (105, "word " * 40_000), (None, texts[2]), (3, texts[3])]
    labels = [(i, int(i % 4 == 0), 1) for i in range(60)]
    path = str(tmp_path / "in")
    write_tables(spark, path, [(i, t, "en", "s", len(t or "")) for i, t in docs], labels, [(1, item), (2, None), (1, item)])
    got = sorted(str((r.doc_id, r.n_tokens)) for r in corpus_pipeline.run(spark, path).collect())

    table = spark.read.parquet(f"{path}/documents.parquet")
    model = toxicity.fit(table, spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic"))
    kept = [(i, t) for i, t in docs if model.scores([t])[0] < toxicity.THRESHOLD]
    assert {i for i, _ in docs} - {i for i, _ in kept} >= {i for i in range(0, 60, 4) if zlib.crc32(str(i).encode()) % 3 != 1}
    best = {}
    for (i, t), c in zip(kept, components_by_row(kept), strict=True):
        key = (i is None, i if i is not None else 0)
        if c not in best or key < best[c][0]:
            best[c] = (key, i, t)
    window = set(zip(*[item.split()[k:] for k in range(13)], strict=False))
    clean = []
    for _, i, t in best.values():
        w = decontaminate.words_of(t)
        hit = set()
        for k in range(len(w) - 12):
            if tuple(x.decode() for x in w[k : k + 13]) in window:
                hit.update(range(k, k + 13))
        if not (hit and 20 * len(hit) >= len(w)):
            clean.append((i, t))
    encoder = codec.Encoder(load_pieces())
    assert got == sorted(str((i, len(encoder.encode(t)) // 4)) for i, t in clean)
    assert not {"100", "101", "102"} & {g.split(",")[0][1:] for g in got} and sum("None" in g for g in got) == 0


def components_by_row(docs):
    """A class for each row: rows of equal or linked five-word sets share one; rows without words are classes of their own."""
    sets = []
    for _, t in docs:
        w = neardup.words_of(t)
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    of = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and of[i] != of[j]:
                old, new = of[i], of[j]
                of = [new if x == old else x for x in of]
    return of


def test_pipeline_of_empty_tables(spark, tmp_path):
    path = str(tmp_path / "in")
    write_tables(spark, path, [], [], [])
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "n_tokens", "token_ids"] and out.count() == 0


def test_pipeline_stages(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    copy = base.where("n_chars > 300").first().text
    own = [(90001, f"{item} more", "en", "s", 1), (90002, copy, "en", "s", 1), (90003, None, "en", "s", 0), (90004, "clean words that stand alone and say nothing at all of note", "en", "s", 1)]
    docs = base.unionByName(spark.createDataFrame(own, DOCS)).withColumn("row", F.lit("clash"))
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in docs.collect() if model.scores([r.text])[0] < toxicity.THRESHOLD}
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == corpus_pipeline.COLUMNS
    unique = corpus_pipeline.drop_near_copies(spark, docs, SF)
    ids = {r.doc_id for r in unique.collect()}
    assert 90002 not in ids and {90003, 90004} <= ids and unique.columns == corpus_pipeline.COLUMNS
    exact = exact_components([(r.doc_id, r.text) for r in docs.collect()], 5)
    assert len(ids) == sum(x.endswith("True)") for x in exact)
    clean = corpus_pipeline.drop_contaminated(spark, docs, SF)
    ids = {r.doc_id for r in clean.collect()}
    assert 90001 not in ids and 90004 in ids and clean.columns == corpus_pipeline.COLUMNS
    coded = corpus_pipeline.encode(spark, docs, SF)
    assert coded.count() == docs.count() and coded.where("doc_id = 90003").first().token_ids == []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "benchmark decontamination", "encoding"]
