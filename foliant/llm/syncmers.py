"""Document fingerprints from closed syncmers. DataFrame functions only.

The alphabet is the words of a text: a sign of a script without spaces is a word, and a run
without white space is cut into words of 16 code points, which drops nothing. A k-mer of ``k`` words is an anchor if the
smallest hash of its inner ``s``-mers is that of its first or its last one. This looks at nothing
outside the k-mer, so equal passages have equal anchors wherever they stand.

Two texts are compared by place: an anchor and the next one match where both stand in the other text too, in this order and
as many words apart. So words that only happen to occur in both, far from what stands beside them, don't count, and what is moved as a
whole does. The likeness is the share of matching steps among the distinct steps of both.

Sliding minima and k-mer hashes are made by doubling, so the cost of a word grows with log2(k).

Cases: a text of fewer than ``k`` words, or without an anchor, has the hashes of its words
for anchors; a text of white space only has the hash of the text; an empty or null text has no
anchor. A single anchor is a step by itself. Two texts without anchors have likeness 1, with one of them 0. The next document is the next row by
doc_id, nulls first, then by the first ``HEAD`` characters and the text's hash, so repeated ids are documents of their own; a single document is its own next. Further
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.batches import count_up_to, number_rows
from .common import text_of

K, S = 5, 2
#: Ranges of ids: at most so many, from so many sampled ids for each. Ids of fewer rows than the last aren't divided.
MOST_RANGES, SAMPLED, LEAST_HOT = 1 << 16, 20, 256
#: Rows of one id go by so many first characters, then by the text's hash.
HEAD = 200
SIGNS = "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsHangul}\\p{IsThai}"
WORD = f"[^\\s{SIGNS}]{{1,16}}|[{SIGNS}]"


def shift(c: Column, by: int) -> Column:
    return F.slice(c, by + 1, F.greatest(F.size(c) - by, F.lit(0)))


def with_anchors(df: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """Adds ``out``: the hashes of the anchors of ``text`` in their order, and ``out``_at: the number of the word where each begins.
    The steps are columns of their own, so that each is computed once."""
    if not 1 <= s < k:
        raise ValueError("1 <= s < k is needed")
    name = lambda x: f"__{out}_{x}"
    both = lambda a, b, f: F.zip_with(a, b, f)
    mix = lambda x, y: F.hash(x, y)
    df = df.withColumn(name("w"), F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)))
    df = df.withColumn(name("h"), F.transform(name("w"), lambda w: F.hash(w)))
    cur, length = name("h"), 1
    while length < s:  # hashes of s-mers
        add = min(length, s - length)
        df = df.withColumn(f"{name('s')}{length + add}", both(F.col(cur), shift(F.col(cur), add), mix))
        cur, length = f"{name('s')}{length + add}", length + add
    smer, width = cur, k - s + 1
    low, w = smer, 1
    while w < width:  # minima of ``width`` s-mers
        add = min(w, width - w)
        df = df.withColumn(f"{name('m')}{w + add}", both(F.col(low), shift(F.col(low), add), lambda x, y: F.least(x, y)))
        low, w = f"{name('m')}{w + add}", w + add
    kmer, length = smer, s
    while length < k:  # hashes of k-mers
        add = min(length, k - length)
        df = df.withColumn(f"{name('k')}{length + add}", both(F.col(kmer), shift(F.col(kmer), add), mix))
        kmer, length = f"{name('k')}{length + add}", length + add
    n = F.greatest(F.size(name("w")) - (k - 1), F.lit(0))
    first = lambda c: F.slice(F.col(c), 1, n)
    edge = both(first(smer), F.slice(shift(F.col(smer), width - 1), 1, n), lambda x, y: F.least(x, y))
    df = df.withColumn(name("c"), both(edge, first(low), lambda x, y: x == y))
    df = df.withColumn(name("a"), F.array_compact(both(F.col(name("c")), first(kmer), lambda f, h: F.when(f, h))))
    df = df.withColumn(name("p"), F.array_compact(F.transform(name("c"), lambda f, i: F.when(f, i))))
    found, words = F.size(name("a")) > 0, F.size(name("w")) > 0
    whole = F.array(F.hash(text))
    rest = F.when(words, F.col(name("h"))).when(F.col(text) != "", whole).otherwise(F.slice(whole, 1, 0))
    places = F.when(words, F.transform(name("h"), lambda _, i: i)).when(F.col(text) != "", F.array(F.lit(0))).otherwise(F.slice(F.array(F.lit(0)), 1, 0))
    df = df.withColumns({out: F.when(found, F.col(name("a"))).otherwise(rest), f"{out}_at": F.when(found, F.col(name("p"))).otherwise(places)})
    return df.drop(*[c for c in df.columns if c.startswith(f"__{out}_")])


def with_steps(df: DataFrame, anchors: str, out: str) -> DataFrame:
    """Adds ``out``: a hash of each anchor, the next one, and how many words apart they begin; of a single anchor, its own hash."""
    n = F.greatest(F.size(anchors) - 1, F.lit(0))
    here, after = (lambda c: F.slice(F.col(c), 1, n)), (lambda c: F.slice(F.col(c), 2, n))
    df = df.withColumn(f"__{out}", F.zip_with(here(anchors), after(anchors), lambda x, y: F.xxhash64(x, y)))
    gaps = F.zip_with(here(f"{anchors}_at"), after(f"{anchors}_at"), lambda p, q: q - p)
    steps = F.zip_with(F.col(f"__{out}"), gaps, lambda h, g: F.xxhash64(h, g))
    return df.withColumn(out, F.when(F.size(anchors) == 1, F.transform(anchors, lambda h: F.xxhash64(h))).otherwise(steps)).drop(f"__{out}")


def likeness(a: Column, b: Column) -> Column:
    """Share of common steps among the distinct steps of both."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def _ranges(ids: DataFrame, parts: int) -> tuple[list[int], list[int], int]:
    """Bounds that divide the keys of ``ids`` about evenly, the keys that fill more than a task's share, and the rows of a range.

    There are many ranges for a task, so that tasks come out alike, and at most ``MOST_RANGES``. The bounds are of a sample, since they decide only where a
    document is compared, never with what; keys are counted over all rows.
    """
    total, n = ids.count(), min(parts * 24, MOST_RANGES)
    if not total:
        return [], [], 1
    some = ids.sample(min(1.0, SAMPLED * n / total), 7)
    found = some.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    often = [k for k, times in Counter(found).items() if times >= max(2, n // parts // 2)]  # at most two a partition
    hot = []
    if often:
        counted = ids.join(F.broadcast(_keys(ids.sparkSession, often)), "key", "left_semi").groupBy("key").count()
        hot = [r["key"] for r in counted.where((F.col("count") >= LEAST_HOT) & (F.col("count") * parts > total)).collect()]
    return sorted(set(found)), hot, -(-total // n)


def _keys(spark: SparkSession, keys: list[int]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key long")


def _tie() -> tuple[Column, Column]:
    """The order of rows of one id: short values, since bounds of ranges of them come to the driver."""
    return F.left("text", F.lit(HEAD)), F.xxhash64("text")


def _placed(rows: DataFrame, first: Column, before: Column) -> DataFrame:
    """Each row in its range ``b``; those that are ``first`` in the range ``before`` it too, as ghosts."""
    at = lambda x, ghost: F.struct(x.alias("b"), F.lit(ghost).alias("ghost"))
    places = F.array_compact(F.array(at(F.col("b"), False), F.when(first, at(before, True))))
    return rows.withColumn("_p", F.explode(places)).select("doc_id", "text", "key", "nth", "shown", "of", F.col("_p.b").alias("b"), F.col("_p.ghost").alias("ghost"))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, anchors, steps, next_text, next_steps): each document beside the next by doc_id, then ``_tie``.

    Documents are shuffled once, into ranges of doc_id; the first of each range goes to the range
    before it too, so that no range needs to look into another. What begins a range is a row for each in a table of at most ``MOST_RANGES`` rows.
    The rows of an id that fills more than a task's share are numbered by text in sorted runs and go by blocks of these numbers; among the ranges their
    first one stands for them, and their last one finds what comes after them.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", text_of("text").alias("text"), F.coalesce("doc_id", F.lit(-(2**63))).alias("key"))
    ids = rows.select("key")
    bounds, hot, size = _ranges(ids, parts)
    b = count_up_to(bounds, F.col("key")).cast("long")
    firsts = ids.groupBy(b.alias("b")).agg(F.min("key").alias("first"))
    firsts = firsts.withColumn("before", F.coalesce(F.lag("b").over(W.orderBy("b")), F.max("b").over(W.partitionBy(F.lit(0)))))
    none = F.lit(None).cast("long")
    apart = rows.join(F.broadcast(_keys(spark, hot)), "key", "left_anti") if hot else rows
    apart = apart.select("doc_id", "text", "key", F.lit(0).cast("long").alias("nth"), F.lit(True).alias("shown"))
    if hot:
        same = rows.join(F.broadcast(_keys(spark, hot)), "key", "left_semi").withColumns(dict(zip(("head", "hash"), _tie(), strict=True)))
        same = same.withColumn("salt", F.rand(7))  # rows that repeat are divided too
        same = number_rows(same, ["head", "hash", "salt"], within="key", out="nth").select("doc_id", "text", "key", "nth")
        same = same.join(F.broadcast(same.groupBy("key").agg(F.max("nth").alias("last"))), "key")
        ends = same.where("nth = 1 or nth = last").select("doc_id", "text", "key", F.when(F.col("nth") == 1, 0).otherwise(1).cast("long").alias("nth"), (F.col("nth") == F.col("last")).alias("shown"))
        apart = apart.unionByName(ends)
    placed = apart.withColumns({"of": none, "b": b}).join(F.broadcast(firsts), "b")
    placed = _placed(placed, F.col("first") == F.col("key"), F.col("before"))
    if hot:
        block, begins = F.floor((F.col("nth") - 1) / size), ((F.col("nth") - 1) % size == 0) & (F.col("nth") > 1)
        inner = same.withColumns({"of": F.col("key"), "b": block, "shown": F.col("nth") < F.col("last")})
        placed = placed.unionByName(_placed(inner, begins, block - 1))
    place = ["of", "b"] if hot else ["b"]  # a column that is null everywhere would cost a second shuffle
    placed = with_steps(with_anchors(placed.repartition(parts, *place), "text", "anchors"), "anchors", "steps").drop("anchors_at")
    order = W.partitionBy(*place).orderBy("ghost", "key", *_tie(), "text", "nth")
    both = F.lead(F.struct("text", "steps")).over(order)
    return placed.withColumn("next", both).where("shown and not ghost").select("doc_id", "text", "anchors", "steps", F.col("next.text").alias("next_text"), F.col("next.steps").alias("next_steps"))


def op2(spark: SparkSession, documents: DataFrame) -> DataFrame:
    rows = with_next(documents.select("doc_id", "text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_steps(with_anchors(rows.withColumn("edited", edited), "edited", "edited_anchors"), "edited_anchors", "edited_steps")
    shown = lambda c: F.concat_ws(",", F.col(c).cast("array<string>"))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        shown("anchors").alias("fingerprint"),
        shown("edited_anchors").alias("edited_fingerprint"),
        likeness(F.col("steps"), F.col("edited_steps")).alias("near_edited"),
        likeness(F.col("steps"), F.col("next_steps")).alias("near_next"),
    )
