"""Ranked lexical search by norm buckets: the documents that score highest for each item, exactly.

A document is its impact vector: for each term of the items, weight times saturated frequency, in 64-bit integers. The score
of an item is the sum over the item's terms, a product with a vector of ones. The search goes in these steps:

1. Documents are cut into words once; what is written of each are its length and the counts of the items' terms.
2. Impact vectors are sorted by their Euclidean length, longest first, and lie in buckets of ``BUCKET`` vectors.
3. The longest vectors are searched first; the ``most``-th best score of each item bounds what the others must reach.
4. In each bucket, and for each item: Cauchy-Schwarz with the longest vector of the bucket, and the sum of each coordinate's largest
   impact, skip the bucket; else by the same bound the shorter vectors are cut off. Coordinates with the largest
   impacts are added up for all vectors that have them, until the rest can't lift a vector without them over the bound; a vector
   survives if its partial sum and the bound of the rest (coordinates, or Cauchy-Schwarz over what is left of its
   length) reach it. Survivors are scored in integers from their whole vectors. Bounds grow from bucket to bucket.

Only bounds that no vector of the best can miss prune, so the result is exact. No pair of document and item leaves a task unless it is among the
best of that task. Items go to the tasks in blocks of about ``block_words`` words, as in ``decontaminate``; further
blocks are further passes.

Words are the maximal runs of letters, digits and non-ASCII signs, A-Z lower-cased. Cases: null and empty texts have no terms and count for nothing; an item without terms, or
that nothing scores above 0 for, has no row; each row of the items is an item of its own, also where ids repeat or are null; of equal scores the
smaller doc_id ranks first, null last; repeated documents are documents of their own; no documents or no items give no rows.
Further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, keep, once, small
from .decontaminate import words_of

#: Vectors of a bucket; the share of all vectors, the longest ones, that are searched first.
BUCKET, FIRST = 2048, 16
#: Room for rounding in bounds that are computed in doubles.
SLACK = 1 + 1e-9
NO_ID = np.iinfo(np.int64).max


def weight(n: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n`` documents hold."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, w: np.ndarray, n: int, documents: int, total: int) -> np.ndarray:
    """Impacts of terms of weights ``w`` that occur ``tf`` times in a document of ``n`` words; all integers."""
    m = 100 - 50 + (50 * n * documents) // total
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _counted(shared):
    """(doc_id, text) to (doc_id, n, terms, tfs): numbers and counts of the items' terms; rows without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = once("lemp terms", shared.value, lambda: {t: i for i, t in enumerate(shared.value[0])})
        for b in small(batches):
            ids, ns, terms, tfs = [], [], [], []
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = words_of(text)
                if words:
                    found = Counter(map(number.get, words))
                    found.pop(None, None)
                    of = sorted(found)
                    ids.append(i)
                    ns.append(len(words))
                    terms.append(np.array(of, np.int32).tobytes())
                    tfs.append(np.array([found[t] for t in of], np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], ["doc_id", "n", "terms", "tfs"]
            )

    return run


def _held_by(size: int):
    """(terms) to (term, df): how many rows of a task hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), np.int32), minlength=size)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], ["term", "df"])

    return run


def _long(weights: np.ndarray, documents: int, total: int):
    """Adds the impacts, without terms of weight 0, and the vector's length; vectors of length 0 are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, xs, norms = [], [], []
            for n, t, f in zip(b.column("n").to_pylist(), b.column("terms").to_pylist(), b.column("tfs").to_pylist(), strict=True):
                t, f = np.frombuffer(t, np.int32), np.frombuffer(f, np.int32).astype(np.int64)
                used = weights[t] > 0
                x = impacts(f[used], weights[t[used]], n, documents, total)
                terms.append(t[used].tobytes())
                xs.append(x.tobytes())
                norms.append(math.sqrt(float(np.square(x.astype(np.float64)).sum())))
            out = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), pa.array(norms, pa.float64()), pa.array(terms, pa.binary()), pa.array(xs, pa.binary())], ["doc_id", "row", "norm", "terms", "xs"]
            )
            yield out.filter(pa.array(np.array(norms) > 0))

    return run


class Bucket:
    """Vectors of about one length, with their coordinates as lists of (vector, impact)."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, terms: list[bytes], xs: list[bytes], size: int):
        order = np.argsort(-norms, kind="stable")
        self.ids, self.norms = ids[order], norms[order]
        parts = [np.frombuffer(terms[i], np.int32) for i in order]
        sizes = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.terms, self.xs = np.concatenate(parts), np.concatenate([np.frombuffer(xs[i], np.int64) for i in order])
        by = np.argsort(self.terms, kind="stable")
        self.vector, self.impact = np.repeat(np.arange(len(parts)), sizes)[by], self.xs[by]
        self.at = np.searchsorted(self.terms[by], np.arange(size + 1))
        self.top = np.zeros(size, np.int64)
        np.maximum.at(self.top, self.terms, self.xs)

    def survivors(self, terms: np.ndarray, bound: int) -> np.ndarray:
        """Vectors that may score ``bound`` or more for an item of these terms."""
        none = np.zeros(0, np.int64)
        reach = math.sqrt(len(terms)) * SLACK
        long = int(np.searchsorted(-self.norms, -bound / reach, side="right"))  # Cauchy-Schwarz: these vectors are long enough
        top = self.top[terms]
        if not long or int(top.sum()) < bound:
            return none
        order = np.argsort(-top, kind="stable")
        rest = np.append(np.cumsum(top[order][::-1])[::-1], 0)  # what the coordinates from each place on can add at most
        focus = int(np.count_nonzero(rest >= bound))  # a vector without the first so many can't reach the bound
        part, square, seen = np.zeros(long, np.int64), np.zeros(long), np.zeros(long, bool)
        for t in terms[order[:focus]]:
            v, x = self.vector[self.at[t] : self.at[t + 1]], self.impact[self.at[t] : self.at[t + 1]]
            upto = int(np.searchsorted(v, long))
            v, x = v[:upto], x[:upto]
            part[v] += x
            square[v] += x.astype(np.float64) ** 2
            seen[v] = True
        left = np.sqrt(np.maximum(self.norms[:long] ** 2 * SLACK - square, 0)) * math.sqrt(len(terms) - focus) * SLACK
        return np.flatnonzero(seen & (part + np.minimum(left, float(rest[focus])) * SLACK + 1e-6 >= bound))

    def scores(self, vectors: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores of some vectors; ``asked`` marks the item's terms."""
        sizes = self.ends[vectors] - self.starts[vectors]
        place = np.repeat(self.starts[vectors] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        sums = np.cumsum(np.where(asked[self.terms[place]], self.xs[place], 0))
        ends = np.cumsum(sizes)
        return sums[ends - 1] - np.where(ends > sizes, sums[ends - sizes - 1], 0)


class Best:
    """The best of each item so far: highest score, then smallest id."""

    def __init__(self, items: int, most: int, bounds: dict[int, int]):
        self.most, self.bound = most, [bounds.get(k, 1) for k in range(items)]
        self.scores, self.ids = [np.zeros(0, np.int64)] * items, [np.zeros(0, np.int64)] * items

    def add(self, k: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.bound[k]
        scores, ids = np.concatenate((self.scores[k], scores[good])), np.concatenate((self.ids[k], ids[good]))
        order = np.lexsort((ids, -scores))[: self.most]
        self.scores[k], self.ids[k] = scores[order], ids[order]
        if len(order) == self.most:
            self.bound[k] = max(self.bound[k], int(self.scores[k][-1]))


def _searched(shared, most: int, bounds: dict[int, int]):
    """Vectors to (item, doc_id, score): the best of a task that reach the bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, items = shared.value
        size = len(vocabulary)
        terms = [np.array(i, np.int64) for i in items]
        best = Best(len(items), most, bounds)
        asked = np.zeros(size, bool)
        for b in small(batches, BUCKET):
            if not b.num_rows:
                continue
            ids = np.array([NO_ID if i is None else i for i in b.column("doc_id").to_pylist()], np.int64)
            bucket = Bucket(ids, b.column("norm").to_numpy(zero_copy_only=False), b.column("terms").to_pylist(), b.column("xs").to_pylist(), size)
            for k, t in enumerate(terms):
                found = bucket.survivors(t, best.bound[k])
                if len(found):
                    asked[t] = True
                    best.add(k, bucket.scores(found, asked), bucket.ids[found])
                    asked[t] = False
        for k in range(len(items)):
            if len(best.ids[k]):
                ids = pa.array(best.ids[k], mask=best.ids[k] == NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), k, np.int32)), ids, pa.array(best.scores[k])], ["item", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, block_words: int) -> Iterator[tuple[list[int], list[bytes], list[list[int]]]]:
    """(marks of the items, vocabulary, terms of each item by their numbers), about ``block_words`` words at a time on the driver."""
    chars = items.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-chars // (2 * block_words)))
    for part in range(n):
        marks, number, terms = [], {}, []
        for r in items.where(F.pmod(F.xxhash64("mark"), F.lit(n)) == part).toLocalIterator():
            own = sorted(set(words_of(r["text"])))
            if own:
                marks.append(r["mark"])
                terms.append([number.setdefault(w, len(number)) for w in own])
        if marks:
            yield marks, list(number), terms


def top_documents(documents: DataFrame, items: DataFrame, most: int = 50, block_words: int = 500_000) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best of ``documents`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    first = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    with Scratch(spark, "lemp") as scratch:
        asked = scratch.keep(items.select("item_id", "text").withColumn("mark", F.monotonically_increasing_id()), "items")
        found = []
        for marks, vocabulary, terms in _blocks(asked, block_words):
            shared = spark.sparkContext.broadcast((vocabulary, terms))
            counted = docs.mapInArrow(_counted(shared), "doc_id long, n long, terms binary, tfs binary").withColumn("row", F.monotonically_increasing_id())
            counted = scratch.keep(counted, "counts")
            whole = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
            held = counted.select("terms").mapInArrow(_held_by(len(vocabulary)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
            df = np.zeros(len(vocabulary), np.int64)
            for r in held.collect():  # a row for each term of the block at most
                df[r["term"]] = r["df"]
            weights = np.array([weight(whole["documents"], int(x)) for x in df], np.int64)
            long = counted.mapInArrow(_long(weights, whole["documents"], whole["total"] or 1), "doc_id long, row long, norm double, terms binary, xs binary")
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            # the row keeps apart vectors of one length, so that copies are on many tasks
            order = [F.desc("norm"), F.xxhash64("row")]
            long = long.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
            long = scratch.keep(long, "vectors")
            ahead = F.col("part") < max(1, parts // FIRST)
            search = lambda rows, bounds: rows.select("doc_id", "norm", "terms", "xs").mapInArrow(_searched(shared, most, bounds), "item int, doc_id long, score long")  # noqa: B023, E731
            best = scratch.keep(search(long.where(ahead), {}), "best")
            reached = best.withColumn("rank", first).where(F.col("rank") == most)
            bounds = {r["item"]: r["score"] for r in reached.collect()}  # a row for each item of the block at most
            other = scratch.keep(search(long.where(~ahead), bounds), "best")
            ranked = best.unionByName(other).withColumn("rank", first).where(F.col("rank") <= most)
            marked = spark.createDataFrame(list(enumerate(marks)), "item int, mark long")
            named = ranked.join(F.broadcast(marked), "item").join(asked.select("mark", "item_id"), "mark")
            found.append(scratch.keep(named.select("item_id", F.col("rank").cast("int"), "doc_id", "score"), "ranked"))
        if not found:
            return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return keep(out, "ranked")


def op11(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return top_documents(documents, benchmark)


#: Rows of the benchmark are items of their own.
OP11_SQL = r"""
WITH t AS (
  SELECT k, doc_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents)
), q AS (
  SELECT DISTINCT i, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark)
), f AS (
  SELECT k, doc_id, t, count(*) AS tf FROM t WHERE t IN (SELECT t FROM q) GROUP BY ALL
), d AS (
  SELECT k, count(*) AS n FROM t GROUP BY k
), c AS (
  SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM d
), v AS (
  SELECT t, count(*) AS df FROM f GROUP BY t
), x AS (
  SELECT f.k, f.doc_id, f.t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // ll)))) AS x
  FROM f JOIN d USING (k) JOIN v USING (t), c
), s AS (
  SELECT i, item_id, k, doc_id, sum(x)::BIGINT AS score FROM q JOIN x USING (t) GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 50
"""
