"""URL filter: rules by host and path, and for urls without a rule a model of segmented words.

Names (runs of letters) in hosts and paths are split into words by unigram Viterbi. The word counts come from the text of all pages and
all their words: the names' parts are joined with the counts, so what a task holds is what one name can be split into. A part that is
no word of the text has the probability 10 / (N * 10**length), N being the sum of all counts. Multinomial naive Bayes with Laplace smoothing over
host and path words learns from all urls that a rule judges, each as often as it stands in the table, and judges the others.

Urls are counted before anything is joined, so a url or name that is in many rows is handled once. Nothing grows on the driver or in a
broadcast: only sums come there, and the lengths that words have, up to the longest name. Logarithms are added as whole numbers of
1e-9, so that the order of sums doesn't matter.

Cases: a null url, or one without ``://``, has an empty host and path; without host and path the prior decides, which allows on
a tie; with no judged url of one of the classes everything without a rule is allowed. Equally likely splits keep the longest last word. Null or
empty html has no words; without any words names stay whole. Repeated rows are judged alike and
count each; no rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, keep, small

#: The rules of the contract: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
LETTERS = "\\p{L}+"
UNIT = 1e9
#: Characters of words after which a task sends its counts on.
HELD = 4_000_000


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict), null where none fits; the longest rule comes first."""
    rule = verdict = None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a stretch of pages; (word, n) goes out before it has too many words."""
    unseen, word = re.compile(r"<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I), re.compile(r"[^\W\d_]+")
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return batch

    since = 0
    for b in small(batches):
        for html in b.column("html").to_pylist():
            if html:
                text = unseen.sub(" ", html).lower()
                counts.update(word.findall(text))
                since += len(text)
                if len(counts) > 50_000 or since > 20 * HELD or since > HELD and sum(map(len, counts)) > HELD:
                    yield out()
                    since = 0
    yield out()


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, count) of all words in the text of all pages."""
    return pages.select("html").mapInArrow(_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("count"))


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words of ``name``; ``counts`` has the words that occur in it. Time grows with its length."""
    tenth, unknown = round(math.log(10) * UNIT), round(math.log(10 / total) * UNIT)
    known = {w: round(math.log(c / total) * UNIT) for w, c in counts.items()}
    sizes = sorted({len(w) for w in known})
    best, cut = [0], [0]
    free, at = 0, 0  # where an unknown part that ends here begins best
    for end in range(1, len(name) + 1):
        if best[end - 1] + (end - 1) * tenth > free:
            free, at = best[end - 1] + (end - 1) * tenth, end - 1
        options = [(unknown + free - end * tenth, -at)]
        for size in sizes:
            if size > end:
                break
            p = known.get(name[end - size : end])
            if p is not None:
                options.append((best[end - size] + p, size - end))
        top, start = max(options)
        best.append(top)
        cut.append(-start)
    words, end = [], len(name)
    while end:
        words.append(name[cut[end] : end])
        end = cut[end]
    return words[::-1]


def segmented(names: DataFrame, words: DataFrame, keep=keep) -> DataFrame:
    """(name, words) of the distinct ``names`` (name), split by the counts of ``words`` (word, count)."""
    total = words.agg(F.sum("count")).first()[0] or 1
    longest = names.agg(F.max(F.length("name"))).first()[0] or 0
    sizes = [r[0] for r in words.select(F.length("word").alias("size")).where(F.col("size") <= longest).distinct().collect()]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1000):
            held: list[tuple[str, str]] = []
            for name in b.column("name").to_pylist():
                for size in sizes:
                    held += [(name, w) for w in {name[i : i + size] for i in range(len(name) - size + 1)}]
                    if len(held) > 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*held, strict=True)], ["name", "word"])
                        held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*held, strict=True)], ["name", "word"])

    known = names.mapInArrow(parts, "name string, word string").join(words, "word").groupBy("name").agg(F.collect_list("word").alias("known"), F.collect_list("count").alias("counts"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 1000):
            columns = (b.column(c).to_pylist() for c in ("name", "known", "counts"))
            out = [split_name(n, dict(zip(ws or (), cs or (), strict=True)), total) for n, ws, cs in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("name"), pa.array(out, pa.list_(pa.string()))], ["name", "words"])

    return names.join(keep(known, "known"), "name", "left").select("name", "known", "counts").mapInArrow(split, "name string, words array<string>")


def names_of(urls: DataFrame) -> DataFrame:
    """A row for each name in the host (kind h) and the path (kind p) of ``urls``."""
    found = lambda kind, c: F.transform(F.regexp_extract_all(c, F.lit(LETTERS), F.lit(0)), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("name")))
    return urls.withColumn("part", F.explode(F.concat(found("h", F.lower("host")), found("p", F.lower("path"))))).withColumns({"kind": F.col("part.kind"), "name": F.col("part.name")}).drop("part")


def blocked(urls: DataFrame, words: DataFrame, keep=keep) -> DataFrame:
    """(host, path, blocked) of the distinct ``urls`` (id, host, path, verdict, n) without a verdict, learned from those with one."""
    is_block = F.col("verdict") == "block"
    known = F.col("verdict").isNotNull()
    n = urls.agg(F.sum(F.when(is_block, F.col("n"))).alias("block"), F.sum(F.when(~is_block, F.col("n"))).alias("allow")).first()
    fresh = urls.where(~known)
    if not n["block"] or not n["allow"]:
        return fresh.select("host", "path", F.lit(False).alias("blocked"))
    # names are counted before they are split, so that frequent ones meet in no task
    counted = names_of(urls).groupBy("kind", "name").agg(F.sum(F.when(is_block, F.col("n"))).alias("x"), F.sum(F.when(~is_block, F.col("n"))).alias("y"))
    counted = keep(counted, "names")
    words_of = keep(segmented(counted.select("name").distinct(), words, keep), "segments")
    each = counted.join(words_of, "name").select("kind", "name", "x", "y", F.explode("words").alias("word"))
    learned = each.groupBy("kind", "word").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).where("x is not null or y is not null").fillna(0)
    learned = keep(learned, "learned")
    t = learned.agg(F.coalesce(F.sum("x"), F.lit(0)).alias("x"), F.coalesce(F.sum("y"), F.lit(0)).alias("y"), F.count("*").alias("v")).first()
    whole = lambda c: F.round(c * UNIT).cast("long")
    base = math.log(t["y"] + t["v"] + 1) - math.log(t["x"] + t["v"] + 1)  # one more for words that no judged url has
    value = learned.select("kind", "word", whole(F.log(F.col("x") + 1) - F.log(F.col("y") + 1) + base).alias("value"))
    weights = each.select("kind", "name", "word").join(value, ["kind", "word"], "left").groupBy("kind", "name").agg(F.sum(F.coalesce("value", F.lit(round(base * UNIT)))).alias("weight"))
    scores = names_of(fresh.select("id", "host", "path")).select("id", "kind", "name").join(keep(weights, "weights"), ["kind", "name"]).groupBy("id").agg(F.sum("weight").alias("score"))
    prior = round((math.log(n["block"]) - math.log(n["allow"])) * UNIT)
    return fresh.join(keep(scores, "scores"), "id", "left").select("host", "path", (F.coalesce("score", F.lit(0)) + prior > 0).alias("blocked"))


def op6(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    with Scratch(spark, "urls") as scratch:
        words = scratch.keep(word_counts(pages), "words")
        # the written number of a url is unique and stays the same
        urls = scratch.keep(rows.groupBy("host", "path", "verdict").agg(F.count("*").alias("n")).withColumn("id", F.monotonically_increasing_id()), "urls")
        judged = keep(blocked(urls, words, scratch.keep), "judged")
    verdict = F.coalesce("verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return rows.join(judged, ["host", "path"], "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
