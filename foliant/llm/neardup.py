"""Near duplicates: an LSH forest over MinHash signatures, and exact confirmation on full shingle sets.

A node is a distinct shingle set (128-bit digest); copies share their node. A forest of ``TREES`` sorted signature orders
gives each node a key of its first ``BASE`` values and the next values, up to ``DEPTH``, as a tail to sort by.

1. In every region (equal key) the longest-common-prefix neighbours of its sorted order are candidates. Confirmed links
   give components.
2. The depth of a region adapts to its nodes: one of at most ``REGION`` nodes keeps the depth ``BASE``; of a larger one, each node goes as deep, up
   to ``DEPTH``, as it must so that at most ``REGION`` nodes share its prefix. All pairs of different components in such a
   region are candidates, and are confirmed on full sets.
3. What a deeper region parts may still be linked. So the nodes of larger regions that still hold several components share hubs, and all links between different
   components of a hub's nodes are found exactly from what these differ in from the hub (``_apart``); a large group of near copies never becomes a set of pairs.

So nodes that share a key are compared whatever the region's size, and a pair is missed only if it shares no key. The
trees share no value of their keys, so at similarity 0.8 that has the probability (1 - 0.8**4)**24 = 3.2e-6. Confirmed
links are exact: 64-bit hashes of shingles are compared, all of them.

Cases: null text and texts without words have the empty set and are linked with nothing; fewer words than a
shingle has are one shingle; a null id takes part, and has a component_id only if another id of its component has
one; repeated rows share a component, and ``kept`` is true for each row that has the least id; no rows give no
rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, keep, small
from .components import joined

POOL, TREES, BASE, DEPTH, REGION = 96, 24, 4, 8, 64
#: A region of more nodes is sorted in parts of about so many; neighbours across parts aren't needed, since step 3 is exact.
PART = 512
#: Words of a mask of differences.
MASK = 8

_rng = np.random.RandomState(20240607)
A = (_rng.randint(0, 2**63, POOL, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
B = _rng.randint(0, 2**63, POOL, dtype=np.int64).astype(np.uint64)
_dealt = _rng.permutation(POOL).reshape(TREES, BASE)
#: Keys of different trees share no value; the values of a tail are any others.
ORDERS = [np.concatenate((d, _rng.permutation(np.setdiff1d(np.arange(POOL), d))[: DEPTH - BASE])) for d in _dealt]
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space (bytes.split cuts at 09-0D and 20)."""
    return text.encode().lower().split() if text else []


class Shingler:
    """Sorted distinct 64-bit hashes of word shingles; remembers hashes of words up to a bound."""

    def __init__(self, size: int, most: int = 500_000):
        self.size, self.most, self.known = size, most, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], np.uint64)
        size = min(self.size, len(h))
        acc = h[: len(h) - size + 1] + np.uint64(size)
        for j in range(1, size):
            acc = (acc ^ (acc >> np.uint64(29))) * MIX + h[j : len(h) - size + 1 + j]
        acc = (acc ^ (acc >> np.uint64(31))) * MIX
        return np.unique(acc ^ (acc >> np.uint64(30)))


def signature(s: np.ndarray) -> np.ndarray:
    out = np.full(POOL, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(s), 4096):
        part = s[i : i + 4096, None] * A
        part += B
        out = np.minimum(out, (part.min(axis=0) >> np.uint64(32)).astype(np.uint32))
    return out


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for b in small(batches):
            nodes, counts, sigs = [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t)
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                counts.append(len(s))
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()), pa.array(sigs, pa.binary())],
                ["doc_id", "row", "node", "n", "sig"],
            )

    return run


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, sig) to a row for each tree: region key, tail to sort by, node, n."""
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, POOL).astype(np.uint64)
        for t, order in enumerate(ORDERS):
            key = np.full(len(sig), t + 1, np.uint64)
            for c in order[:BASE]:
                key = (key ^ (key >> np.uint64(29))) * MIX + sig[:, c]
            key = (key ^ (key >> np.uint64(31))) * MIX
            tail = np.zeros(len(sig), np.uint64)
            for c in order[BASE:DEPTH]:
                tail = (tail << np.uint64(16)) | (sig[:, c] & np.uint64(0xFFFF))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(tail.view(np.int64)), b.column("node"), b.column("n")], ["key", "tail", "node", "n"])


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([shingles(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())], ["node", "members"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ok = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda c: sets.select(F.col("node").alias(c), F.col("members").alias(f"set_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), "a binary, b binary")


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def mask_of(elements: np.ndarray) -> np.ndarray:
    """``MASK`` words with a bit for each element; a bit that another mask lacks is at least one element that the other set lacks."""
    bit = (elements.view(np.uint64) >> np.uint64(5)) % np.uint64(64 * MASK)
    out = np.zeros(MASK, np.uint64)
    np.bitwise_or.at(out, (bit // np.uint64(64)).astype(np.int64), np.uint64(1) << bit % np.uint64(64))
    return out.view(np.int64)


def _compare(percent: int):
    """Each node with its hub: whether they are linked, the elements that only one of them has, the node's own first, and their mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            linked, only, masks = [], [], []
            for x, h in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist(), strict=True):
                x, h = np.frombuffer(x, np.uint64), np.frombuffer(h, np.uint64)
                own, missing = np.setdiff1d(x, h, assume_unique=True), np.setdiff1d(h, x, assume_unique=True)
                common = len(x) - len(own)
                linked.append(100 * common >= percent * (len(h) + len(own)))
                only.append(np.concatenate((own, missing)).view(np.int64))
                masks.append(mask_of(only[-1]))
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), b.column("n"), pa.array(linked, pa.bool_()), pa.array(only, pa.list_(pa.int64())), pa.array(masks, pa.list_(pa.int64()))],
                ["node", "hub", "n", "linked", "only", "mask"],
            )

    return run


def _divided(members: DataFrame, root_of: DataFrame, by: list[str], keep) -> DataFrame:
    """The rows of ``members`` (node, ...) of groups ``by`` that hold several components, with their root. The groups are written first, so that few of them don't move the rows."""
    rooted = members.join(root_of, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy(*by).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select(*by)
    return rooted.join(keep(several, "divided"), by)


def _leaves(crowd: DataFrame, keep) -> DataFrame:
    """(key, depth, prefix, node, n, root): the nodes of crowded regions (key, tail, node, n, root), each at the least depth where 2 to ``REGION`` nodes share its prefix.

    ``prefix`` are the values after the key, 16 bits of each, as many as the region is deeper than ``BASE``. Depths are chosen for each distinct tail, not for each node.
    """
    at = F.array(*[F.struct(F.lit(d).alias("depth"), F.shiftright("tail", 16 * (DEPTH - d)).alias("prefix")) for d in range(BASE + 1, DEPTH + 1)])
    tails = crowd.groupBy("key", "tail").agg(F.count("*").alias("nodes")).select("key", "tail", "nodes", F.explode(at).alias("at")).select("key", "tail", "nodes", "at.*")
    tails = keep(tails, "tails")
    fitting = tails.groupBy("key", "depth", "prefix").agg(F.sum("nodes").alias("nodes")).where((F.col("nodes") > 1) & (F.col("nodes") <= REGION)).drop("nodes")
    first = tails.join(fitting, ["key", "depth", "prefix"]).groupBy("key", "tail").agg(F.min(F.struct("depth", "prefix")).alias("at"))
    return crowd.join(first, ["key", "tail"]).select("key", "at.*", "node", "n", "root")


def _stars(crowd: DataFrame, region: DataFrame, sets: DataFrame, percent: int, keep) -> DataFrame:
    """(node, hub, n, linked, only) for each node of ``crowd`` (key, node, n, root), crowded regions of several components, and the hub of that region.

    The hub is the most central node, which is the one that stands in the most crowded regions; regions whose central
    nodes are of one component take the most central of these for their common hub.
    """
    central = region.groupBy("node").agg(F.sum("count").alias("central"))
    named = crowd.select("key", "node", "root").join(central, "node")
    hub = keep(named.groupBy("key").agg(F.max(F.struct("central", "node", "root")).alias("hub")).select("key", "hub.*"), "hubs")
    best = hub.groupBy("root").agg(F.max_by("node", F.struct("central", "node")).alias("hub"))
    hub = keep(hub.join(best, "root").select("key", "hub"), "hubs")
    star = crowd.join(hub, "key").where("node <> hub").select("node", "hub", "n").distinct()
    a = sets.select("node", F.col("members").alias("set_a"))
    b = sets.select(F.col("node").alias("hub"), F.col("members").alias("set_b"))
    both = star.join(a, "node").join(b, "hub").select(F.col("node").alias("a"), F.col("hub").alias("b"), "n", "set_a", "set_b")
    return keep(both.mapInArrow(_compare(percent), "node binary, hub binary, n long, linked boolean, only array<bigint>, mask array<bigint>"), "stars")


def _apart(stars: DataFrame, root_of: DataFrame, percent: int, keep) -> DataFrame:
    """All links (a, b) between nodes of one hub that are of different components; exact.

    Two sets are linked if they differ in at most c * (sum of their sizes) elements, c = (100 - percent) / (100 + percent).
    What both differ from the hub in cancels out, so they must have (d + e - c * (sum of sizes)) / 2 of their d and e
    differences from the hub in common. Of two components one at least isn't the hub's, and the nodes of such a
    component, the far ones, aren't linked with the hub. The least that a far node can add to that number bounds how
    many of its differences a node may miss, so each goes by a prefix of its differences, in an order that puts what the hub
    lacks first, since that is rare. Elements that only one component has are dropped.
    """
    c = (100 - percent) / (100 + percent)
    root = lambda col: root_of.select(F.col("node").alias(col), F.col("root").alias(f"root_{col}"))
    rooted = stars.select("node", "hub", "n", "linked", F.size("only").alias("d")).join(root("node"), "node", "left").join(root("hub"), "hub", "left")
    rooted = rooted.withColumn("root", F.coalesce("root_node", "node")).withColumn("far", F.col("root") != F.coalesce("root_hub", "hub"))
    rooted = keep(rooted.select("node", "hub", "n", "d", "root", "far").withColumn("over", F.col("d") - c * F.col("n")), "rooted")
    when_far = lambda x: F.when(F.col("far"), F.col(x))
    known = rooted.groupBy("hub").agg(F.min(when_far("n")).alias("low"), F.max(when_far("n")).alias("high"), F.min(when_far("over")).alias("far_over"), F.min("over").alias("any_over"))
    known = keep(known.where("low is not null"), "known")  # else all nodes are of the hub's component
    each = rooted.join(known, "hub").where((100 * F.col("n") >= percent * F.col("low")) & (percent * F.col("n") <= 100 * F.col("high")))
    # of a far node and any other: by the triangle inequality, the other differs from the hub in at least d - c * (sum of sizes)
    need = F.when(F.col("far"), F.greatest(F.col("over") - c * F.col("n") * (100 / percent), (F.col("over") + F.col("any_over")) / 2)).otherwise((F.col("over") + F.col("far_over")) / 2)
    prefix = F.col("d") - F.greatest(F.lit(1), F.ceil(need - 1e-6)) + 1
    each = each.withColumn("prefix", prefix.cast("int")).where("prefix > 0").select("node", "hub", "n", "d", "root", "far", "prefix")
    first = each.join(stars.select("node", "hub", "only"), ["node", "hub"]).select("node", "hub", "n", "d", "root", "far", F.posexplode(F.slice("only", F.lit(1), F.col("prefix"))).alias("place", "element"))
    first = keep(first, "prefixes")
    met = first.groupBy("hub", "element").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("hub", "element")
    # the join is of ids, numbers and masks of a fixed size; what two nodes have in common is read for the pairs that are left
    rare = first.join(keep(met, "elements"), ["hub", "element"]).join(stars.select("node", "hub", "mask"), ["node", "hub"])
    rare = keep(rare, "rare")
    side = lambda x: rare.select("hub", "element", F.col("node").alias(x), *[F.col(f).alias(f"{f}_{x}") for f in ("n", "d", "root", "far", "place", "mask")])
    sizes = F.col("n_x") + F.col("n_y")
    linked = lambda common: 100 * (sizes - (F.col("d_x") + F.col("d_y") - 2 * common)) >= percent * (sizes + (F.col("d_x") + F.col("d_y") - 2 * common))
    lacks = lambda x, y: sum((F.bit_count(F.element_at(f"mask_{x}", i + 1).bitwiseAND(F.bitwise_not(F.element_at(f"mask_{y}", i + 1)))) for i in range(MASK)), F.lit(0))
    most = F.least(F.col("d_x") - lacks("x", "y"), F.col("d_y") - lacks("y", "x"))
    fit = 100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")
    fit = fit & (F.least(F.col("d_x") - F.col("place_x"), F.col("d_y") - F.col("place_y")) >= (F.col("d_x") + F.col("d_y") - c * sizes) / 2 - 1e-6) & linked(most)
    pairs = side("x").where("far_x").join(side("y"), ["hub", "element"]).where((F.col("root_x") != F.col("root_y")) & (~F.col("far_y") | (F.col("x") < F.col("y"))) & fit)
    pairs = keep(pairs.select("hub", "x", "y", "n_x", "n_y", "d_x", "d_y").distinct(), "met")
    only = lambda x: stars.select("hub", F.col("node").alias(x), F.col("only").alias(f"only_{x}"))
    common = F.size(F.array_intersect("only_x", "only_y"))
    return pairs.join(only("x"), ["hub", "x"]).join(only("y"), ["hub", "y"]).where(linked(common)).select(*_ordered("x", "y")).distinct()


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80, mark: str | None = None) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept, node, root).

    ``row`` tells apart rows that share an id: it is the column ``mark`` (long), or else xxhash64 of the text. ``root`` is the same for all
    rows of a component, also of one without an id; it is null where the set is empty.
    """
    fits = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)
    docs = documents.select("doc_id", "text", (F.col(mark) if mark else F.xxhash64("text")).alias("row"))
    signed = keep(docs.mapInArrow(_signed(size), "doc_id long, row long, node binary, n long, sig binary"), "signed")
    with Scratch(documents.sparkSession, "neardup") as scratch:
        keep_ = scratch.keep
        # one row of each distinct set, before anything is joined
        one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
        nodes = signed.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig"), one.alias("of"))
        nodes = keep_(nodes.select("node", "n", "sig", F.col("of.row").alias("row"), F.coalesce("of.doc_id", F.lit(0)).alias("id"), F.col("of.none").alias("none")), "nodes")
        forest = nodes.select("node", "n", "sig").mapInArrow(_forest, "key long, tail long, node binary, n long")
        crowded = keep_(forest.groupBy("key").agg(F.count("*").alias("count")).where("count > 1"), "keys")
        region = keep_(forest.join(crowded, "key"), "regions")

        # full sets of the nodes that have a neighbour; each from one of its rows
        of = nodes.join(region.select("node").distinct(), "node", "left_semi").select("node", "row", "id", "none")
        texts = docs.select("row", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "text")
        sets = keep_(texts.join(of, ["row", "id", "none"]).select("node", "text").mapInArrow(_sets(size), "node binary, members binary").dropDuplicates(["node"]), "sets", "none")

        # 1. neighbours in sorted order
        part = F.when(F.col("count") > PART, F.pmod(F.xxhash64("node"), F.ceil(F.col("count") / PART))).otherwise(0)
        after = F.lead(F.struct("node", "n")).over(W.partitionBy("key", "part").orderBy("tail", "node"))
        pairs = region.withColumn("part", part).withColumn("next", after).where(F.col("next").isNotNull() & fits(F.col("n"), F.col("next.n"))).withColumn("other", F.col("next.node"))
        root_of = joined(None, _confirmed(pairs.select(*_ordered("node", "other")).distinct(), sets, percent), keep_)

        # 2. pairs of different components in regions as deep as they must be
        by, rows = ["key", "depth", "prefix"], region.select("key", "tail", "node", "n", "count")
        shallow = _divided(rows.where(F.col("count") <= REGION).select("key", F.lit(BASE).alias("depth"), F.lit(0).cast("long").alias("prefix"), "node", "n"), root_of, by, keep_)
        crowded = keep_(_divided(rows.where(F.col("count") > REGION).select("key", "tail", "node", "n"), root_of, ["key"], keep_), "crowded")
        deep = _divided(_leaves(crowded, keep_).drop("root"), root_of, by, keep_)
        about = keep_(shallow.unionByName(deep), "members")
        x = about.select(*by, F.col("node").alias("x"), F.col("n").alias("nx"), F.col("root").alias("rx"))
        y = about.select(*by, F.col("node").alias("y"), F.col("n").alias("ny"), F.col("root").alias("ry"))
        found = x.join(y, by).where((F.col("x") < F.col("y")) & (F.col("rx") != F.col("ry")) & fits(F.col("nx"), F.col("ny")))
        found = keep_(found.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "candidates")
        root_of = joined(root_of, _confirmed(found, sets, percent), keep_)

        # 3. crowded regions that still hold several components
        crowd = keep_(_divided(crowded.select("key", "node", "n"), root_of, ["key"], keep_), "crowds")
        if not crowd.isEmpty():
            stars = _stars(crowd, region, sets, percent, keep_)
            root_of = joined(root_of, stars.where("linked").select(F.col("node").alias("a"), F.col("hub").alias("b")), keep_)
            root_of = joined(root_of, _apart(stars, root_of, percent, keep_), keep_)

        least = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(root_of, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = keep_(least, "least")
        whole = keep_(least.groupBy("root").agg(F.min("least").alias("component_id")), "whole")
        label = keep(least.join(whole, "root").select("node", "component_id", "root"), "labels")
    out = signed.select("doc_id", "row", "node", F.col("n").alias("n_shingles")).join(label, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "row", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "node", "root")


def op5(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return near_duplicates(documents.select("doc_id", "text"), size=2).select("doc_id", "n_shingles", "component_id", "kept")


#: Exact components over all pairs: candidates share one of their rarest shingles, which a pair of similarity 0.8 must.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), f AS (
  SELECT s, count(*) AS f FROM s GROUP BY 1
), r AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY f, s) AS k FROM s JOIN f USING (s) JOIN n USING (doc_id)
), p AS (
  SELECT * FROM r WHERE k <= n - (80 * n + 99) // 100 + 1
), c AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b USING (s) WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), l AS (
  SELECT c.a, c.b FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b AND y.s = x.s GROUP BY c.a, c.b, na, nb HAVING 100 * count(*) >= 80 * (na + nb - count(*))
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), reach(id, of) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, reach.of FROM reach JOIN e ON e.a = reach.id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(of) AS c FROM reach GROUP BY 1) m ON m.id = d.doc_id
"""
