"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are normalised to words (A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``). A document's words are
streamed once through the automaton of all items, which keeps the longest match that ends at each
word; a match of at least ``window`` words, or of a whole shorter item, marks its words as hit. No
document is shuffled, and no pair of document and item is formed.

Items go to the executors in blocks of at most about ``block_words`` words. One block is the usual
case; further blocks are further passes over the documents, so memory has a bound however many
items there are.

Cases: null text has no words; an item without words has no window; an item with a null id marks words but isn't
counted among the items; items that repeat an id count once; an empty benchmark hits nothing; documents are judged
row by row, so repeated rows repeat their result. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, once, small

WINDOW = 13
#: A-Z to lower case, everything that is no part of a word to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences.

    ``whole[s]`` are the items with a window that ends in state s and has ``window`` words;
    ``short[s]`` the (length, item) of shorter items; ``near[s]`` the first state with short items on
    the way up from s.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.size = [-1], [0]
        for _, words in items:
            at = 0
            for w in words:
                at = self._extend(at, w)
        n = len(self.size)
        self.whole: dict[int, set[str | None]] = {}
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        for item, words in items:
            at = 0
            for i, w in enumerate(words):
                at = self.step[at][w]
                if i + 1 >= window:
                    self.whole.setdefault(self.up_to(at, window), set()).add(item)
            if 0 < len(words) < window:
                self.short.setdefault(at, []).append((len(words), item))
        self.near = [0] * n
        for s in sorted(range(1, n), key=self.size.__getitem__):
            self.near[s] = s if s in self.short else self.near[self.link[s]]
        self.alert = [bool(self.near[s]) or self.size[s] >= window for s in range(n)]

    def _new(self, size: int, link: int, step: dict[bytes, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.step.append(step)
        return len(self.size) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        """The state for p's strings followed by w, taken out of q if q holds longer ones too."""
        if self.size[q] == self.size[p] + 1:
            return q
        part = self._new(self.size[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = part
        while p != -1 and self.step[p].get(w) == q:
            self.step[p][w] = part
            p = self.link[p]
        return part

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.step[last]:
            return self._split(last, self.step[last][w], w)
        new, p = self._new(self.size[last] + 1, 0, {}), last
        while p != -1 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p != -1:
            self.link[new] = self._split(p, self.step[p][w], w)
        return new

    def up_to(self, s: int, length: int) -> int:
        """The state on the way up from s that holds the suffix of ``length`` words."""
        while self.size[self.link[s]] >= length:
            s = self.link[s]
        return s

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Disjoint hit ranges (first word, word after the last), and the items found."""
        step, link, size, alert, window = self.step, self.link, self.size, self.alert, self.window
        root = step[0]
        s, length, here = 0, 0, root
        ranges: list[tuple[int, int]] = []
        found: set[str | None] = set()
        for i, w in enumerate(words):
            t = here.get(w)
            if t is None:
                if not s:
                    continue
                while s:
                    s = link[s]
                    t = step[s].get(w)
                    if t is not None:
                        break
                if t is None:
                    length, here = 0, root
                    continue
                length = size[s]
            s, length = t, length + 1
            here = step[s]
            if alert[s]:
                first = i + 1
                if length >= window:
                    first = i + 1 - window
                    found |= self.whole[self.up_to(s, window)]
                u = self.near[s]
                while u:
                    for n, item in self.short[u]:
                        if n <= length:
                            found.add(item)
                            first = min(first, i + 1 - n)
                    u = self.near[link[u]]
                if first <= i:
                    while ranges and ranges[-1][1] >= first:
                        first = min(first, ranges.pop()[0])
                    ranges.append((first, i + 1))
        return ranges, found


def _merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(a + b):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in blocks of about ``block_words`` words, one block at a time on the driver."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), "text")
    chars = rows.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-chars // (2 * block_words)))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else rows
        yield [(r["item"], words_of(r["text"])) for r in part.toLocalIterator()]


RANGES = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("ranges", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = 500_000) -> DataFrame:
    """Adds to ``docs`` (which has ``text``): n_words, ranges (hit words as first and end), items."""
    spark = docs.sparkSession
    plain = [c for c in docs.columns if c not in ("n_words", "ranges", "items")]
    out = docs.select(*plain)
    schema = T.StructType([*out.schema.fields, *FOUND.fields])
    for k, block in enumerate(item_blocks(items, block_words)):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = once(("items", window), shared.value, lambda: ItemAutomaton(shared.value, window))
            for b in small(batches):
                n_words, ranges, names = [], [], []
                before = b.column("ranges").to_pylist() if "ranges" in b.schema.names else None
                known = b.column("items").to_pylist() if before is not None else None
                for j, text in enumerate(b.column("text").to_pylist()):
                    words = words_of(text)
                    r, found = automaton.match(words)
                    if before is not None:
                        r = _merge(r, [(x["first"], x["end"]) for x in before[j]])
                        found = found | set(known[j])
                    n_words.append(len(words))
                    ranges.append([{"first": x, "end": y} for x, y in r])
                    names.append(sorted(x for x in found if x is not None))
                own = [pa.array(n_words, pa.int64()), pa.array(ranges, RANGES), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([b.column(c) for c in plain] + own, plain + ["n_words", "ranges", "items"])

        if k:
            out = keep(out, "decontaminate")
        out = out.mapInArrow(scan, schema)
    return out


def judge(found: DataFrame, coverage: int = 20) -> DataFrame:
    """Adds n_hit and contaminated: hit words are at least one in ``coverage``."""
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["first"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words")))


def remove_spans(found: DataFrame, min_words: int = WINDOW) -> DataFrame:
    """Cuts hit ranges of ``min_words`` words or more out of ``text``; other texts stay as they are."""

    @F.pandas_udf("string")
    def cut(text, ranges):
        out = []
        for t, rs in zip(text, ranges, strict=True):
            drop = [(r["first"], r["end"]) for r in rs if r["end"] - r["first"] >= min_words]
            if drop:
                at = [m.span() for m in WORD.finditer(t)]
                for first, end in reversed(drop):
                    t = t[: at[first][0]] + t[at[end - 1][1] :]
            out.append(t)
        import pandas as pd

        return pd.Series(out, dtype=object)

    return found.withColumn("text", F.when(F.size("ranges") > 0, cut("text", "ranges")).otherwise(F.col("text")))


def op4(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = judge(find_items(documents.select("doc_id", "text"), benchmark))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP4_SQL = """
WITH w AS (
  SELECT 'd' AS kind, row_number() OVER () AS k, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'i', row_number() OVER (), item_id, coalesce(text, '') FROM benchmark
), v AS (
  SELECT kind, k, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM w
), i AS (
  SELECT id, w, least(len(w), 13) AS n FROM v WHERE kind = 'i' AND len(w) > 0
), g AS (
  SELECT DISTINCT id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM i)
), d AS (
  SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM v, (SELECT DISTINCT n FROM g) WHERE kind = 'd' AND len(w) >= n
), h AS (
  SELECT d.k, d.s, d.n, g.id FROM (SELECT *, array_to_string(w[s:s + n - 1], ' ') AS g FROM d) d JOIN g USING (n, g)
), p AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT k, s, n FROM h)) GROUP BY k
), t AS (
  SELECT k, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT k, id::VARCHAR AS x FROM h WHERE id IS NOT NULL) GROUP BY k
)
SELECT v.id AS doc_id, len(v.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(v.w) AS contaminated
FROM v LEFT JOIN p USING (k) LEFT JOIN t USING (k) WHERE v.kind = 'd'
"""
