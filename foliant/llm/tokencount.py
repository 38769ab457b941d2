"""Token counts of documents by dynamic programming that shares prefixes in a trie.

The distinct pre-tokens of a stretch of documents are inserted in a trie in sorted order. A node holds the
best forward score of its prefix, the tokens of that segmentation, its last piece, and the pieces
that may still grow; so each shared prefix is computed once. Every piece that ends at a node, and may follow the last piece
where it starts (``pieces.Junctions``), relaxes the node's score. A branch that is complete is dropped after the counts of its
terminal nodes are stored. Ties and unknown characters are as in ``codec``, so counts equal the lengths of its ids.

Nothing is shuffled: a task has its own trie, with a bound on what it remembers.

Cases: a null or empty text has no tokens; repeated rows repeat their counts; no rows give no rows. Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import once, small
from .pieces import MODEL, SPACE, Junctions, Pieces, load_pieces, parts_of, units_of

#: Units of a stretch; what a task remembers of units, in bytes, of those of at most ``SHORT`` characters.
STRETCH, MEMO_BYTES, SHORT = 100_000, 32 << 20, 64
#: About what a remembered unit takes besides its characters.
ENTRY = 150


class CountingTrie:
    def __init__(self, pieces: Pieces):
        self.floor, self.may = pieces.floor, Junctions(pieces)
        self.root: dict = {}
        for p, (i, score) in pieces.scores.items():
            node = self.root
            for c in p:
                node = node.setdefault(c, {})
            node[None] = (i, score)

    def counts(self, tokens: list[str]) -> dict[str, int]:
        """Best segmentation's length of each token; ``tokens`` are distinct and sorted."""
        out: dict[str, int] = {}
        root, floor, may, pieces = self.root, self.floor, self.may, self.may.count
        # by depth on the path from the trie's root: score, count, last piece, and growing pieces (start, node)
        score, count, last, grow = [0.0], [0], [-1], [[]]
        before = ""
        for token in tokens:
            depth = 0
            for x, y in zip(before, token, strict=False):
                if x != y:
                    break
                depth += 1
            del score[depth + 1 :], count[depth + 1 :], last[depth + 1 :], grow[depth + 1 :]
            for at in range(depth, len(token)):
                c = token[at]
                best, n, piece = score[at] + floor, count[at] + (1 if c < "\x80" else len(c.encode())), -1
                alive = []
                for start, node in (*grow[at], (at, root)):
                    child = node.get(c)
                    if child is not None:
                        alive.append((start, child))
                        found = child.get(None)
                        if found is None:
                            continue
                        i, s = found
                        if score[start] + s > best and may[(last[start] + 1) * pieces + i]:
                            best, n, piece = score[start] + s, count[start] + 1, i
                score.append(best)
                count.append(n)
                last.append(piece)
                grow.append(alive)
            out[token] = count[-1]
            before = token
        return out


class Counter:
    """Counts of whole texts, a stretch of texts at a time."""

    def __init__(self, pieces: Pieces):
        self.trie, self.units = CountingTrie(pieces), pieces.units
        self.known: dict[str, int] = {}
        self.held = 0

    def learn(self, units: set[str]) -> dict[str, int]:
        """Remembers the counts of short ``units``; returns those of the others."""
        plain = sorted(x.replace(" ", SPACE) for x in units if SPACE not in x)
        got = self.trie.counts(plain)
        long: dict[str, int] = {}
        for u in units:
            if SPACE not in u:
                n = got[u.replace(" ", SPACE)]
            else:
                parts = parts_of(u)
                own = self.trie.counts(sorted({p for p in parts if p is not None}))
                n = sum(len(SPACE.encode()) if p is None else own[p] for p in parts)
            if len(u) > SHORT:
                long[u] = n
            else:
                self.known[u] = n
                self.held += ENTRY + len(u)
        return long

    def counts(self, texts: list[str | None]) -> Iterator[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        held: list[list[str]] = []
        size = 0
        for i, t in enumerate(texts):
            held.append(units_of(t, self.units))
            size += len(held[-1])
            if size >= STRETCH or i == len(texts) - 1:
                units = set().union(*held)
                if self.held > MEMO_BYTES:
                    self.known, self.held = {}, 0
                long = self.learn(units.difference(self.known))
                get = self.known.get
                for us in held:
                    yield len(us), sum([n if (n := get(u)) is not None else long[u] for u in us])
                held, size = [], 0


def token_counts(df: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of each row of ``df`` (doc_id, text)."""
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once("counter", shared.value, lambda: Counter(shared.value))
        for b in small(batches):
            got = list(counter.counts(b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x for x, _ in got], pa.int64()), pa.array([y for _, y in got], pa.int64())], ["doc_id", "n_pretokens", "n_tokens"]
            )

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")


def op7(spark: SparkSession, documents: DataFrame, path: str = MODEL) -> DataFrame:
    return token_counts(documents, load_pieces(path))
