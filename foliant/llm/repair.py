"""Conversation repair: the cheapest edits that make roles alternate, with the least audit string among the cheapest.

Rows of a conversation, in order, are kept (K, free), given the role user or assistant (R, 3), deleted (D, 4; what is blank or repeats
must be), or turns without text are inserted (I, 3); what ends without a full stop and isn't deleted costs 3 more. The
roles that remain must read ``(s?(ua)+)?`` by their first letters.

1. Rows are numbered in their conversation and lie in blocks of ``BLOCK`` rows, each a task's row with the texts apart from the codes
   that costs depend on. So a conversation of any length is worked on in many tasks.
2. Costs: a node is a place between rows and a state of the pattern. In each block a dynamic program runs from the end to the start. Where a
   conversation has several blocks, each gives its costs as a 4 x 4 table, and tables are multiplied (least sum) by doubling, so block k knows the
   cost of all that follows after about log2(blocks) rounds.
3. Paths: the arcs that keep the least cost form a graph without circles, and the letter of an arc tells where it leads. Prefix doubling ranks its nodes by
   the least audit strings of 1, 2, 4, ... letters from them, each round by the pair of a node's rank and that of the node that many
   letters on; the pointers of all rounds then give the node at any distance on the least path. Over blocks, which state leaves a block for each state
   that enters it is joined up by doubling in the same way.
4. Audits, faults and repaired lines of blocks are put together in order; the digest is fed block by block, so no task holds a whole
   conversation's text.

Cases: null role and text are one space; a null conversation is one; null turns come first; equal turns go by role, then by md5 of the
text; repeated rows are duplicates by the rule; a conversation without rows needs no edits; no rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import number_rows
from .common import Scratch, keep, small

BLOCK = 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Faults of a row in the codes, and first letters of roles; a code is 4 * letter + fault.
FINE, CUT, BLANK, COPY = range(4)
LETTERS = "sua"
#: States: nothing yet, after s, after u, after a. What remains to be paid at the end of the rows.
END = (0, 6, 3, 0)
#: State after a letter in each state, -1 where it may not follow; letters are s, u, a, and all others.
AFTER = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: State after the role that may be given or inserted, and that role.
NEXT, ROLE = np.array([2, 2, 3, 2]), ("user", "user", "assistant", "user")
NEVER = 1 << 40
#: White space, and signs that a whole text ends with.
WHITE, ENDS = " \t\n\x0b\f\r", ".!?"
#: Letters of edits, in the order of their codes.
SIGNS = "DIKR"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults by a checksum of their place, each with ``copy``, its number among copies."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(kind == 4, "user").otherwise(spaced("role"))
    out = rows.where(kind != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), spaced("role").alias("first_role"), F.md5(spaced("text").cast("binary")).alias("tie"), F.when(kind == 3, 2).otherwise(1).alias("times")
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def _close(d: np.ndarray) -> np.ndarray:
    """Costs with turns inserted before the next row; the last axis but one is the state."""
    u, a = d[..., 2, :].copy(), d[..., 3, :].copy()
    d[..., 2, :] = np.minimum(u, a + INSERT)
    d[..., 3, :] = np.minimum(a, u + INSERT)
    d[..., 0, :] = np.minimum(d[..., 0, :], d[..., 2, :] + INSERT)
    d[..., 1, :] = np.minimum(d[..., 1, :], d[..., 2, :] + INSERT)
    return d


def _row_costs(d: np.ndarray, letter: np.ndarray, fault: np.ndarray) -> list[np.ndarray]:
    """Costs (n, state, k) of deleting, keeping and giving a role, from the costs ``d`` after the row; not closed under insertion."""
    cut = np.where(fault >= BLANK, NEVER, np.where(fault == CUT, TRUNCATED, 0))[:, None, None]
    to = AFTER[:, letter].T  # (n, state)
    kept = np.take_along_axis(d, np.maximum(to, 0)[:, :, None], axis=1) + np.where(to < 0, NEVER, KEEP)[:, :, None] + cut
    return [d + DELETE, kept, d[:, NEXT, :] + REROLE + cut]


def block_costs(codes: list[bytes], after: np.ndarray) -> list[np.ndarray]:
    """For each block, costs (rows + 1, state, k) at each place, from ``after`` (n, state, k) at its end. Blocks of about one length are worked on together."""
    out: list[np.ndarray] = [np.zeros(0)] * len(codes)
    sizes = np.array([len(c) for c in codes])
    for size in np.unique(sizes):
        of = np.flatnonzero(sizes == size)
        c = np.frombuffer(b"".join(codes[i] for i in of), np.uint8).reshape(len(of), size).astype(np.int64)
        d = np.zeros((size + 1, len(of), 4, after.shape[2]), np.int64)
        d[size] = after[of]
        for i in range(size - 1, -1, -1):
            d[i] = np.minimum(_close(np.minimum.reduce(_row_costs(d[i + 1], c[:, i] // 4, c[:, i] % 4))), NEVER)
        for j, i in enumerate(of):
            out[i] = d[:, j]
    return out


class LeastPaths:
    """Least audit strings over the arcs that keep the least cost, for many blocks at once.

    Nodes of a block are (place, state). A block that isn't its conversation's last ends at any node of its last place.
    """

    def __init__(self, codes: list[bytes], costs: list[np.ndarray], last: list[bool]):
        sizes = np.array([4 * (len(c) + 1) for c in codes])
        self.base = np.cumsum(sizes) - sizes
        letters, targets = [], []
        for base, c, d, end in zip(self.base, codes, costs, last, strict=True):
            d, c = d[:, :, 0], np.frombuffer(c, np.uint8).astype(np.int64)
            own = base + np.arange(d.size).reshape(d.shape)
            # a column for each letter: whether its arc keeps the least cost, and where it leads
            best, to = np.zeros((*d.shape, len(SIGNS)), bool), np.repeat(own[:, :, None], len(SIGNS), axis=2)
            deleted, kept, reroled = (x[:, :, 0] for x in _row_costs(d[1:, :, None], c // 4, c % 4))
            best[:-1, :, 0], to[:-1, :, 0] = deleted == d[:-1], own[1:]
            best[:, :, 1], to[:, :, 1] = d[:, NEXT] + INSERT == d, own[:, NEXT]
            best[-1, :, 1] &= end
            best[:-1, :, 2], to[:-1, :, 2] = kept == d[:-1], np.take_along_axis(own[1:], np.maximum(AFTER[:, c // 4].T, 0), axis=1)
            best[:-1, :, 3], to[:-1, :, 3] = reroled == d[:-1], own[1:, NEXT]
            letters.append(best.reshape(-1, len(SIGNS)))
            targets.append(to.reshape(-1, len(SIGNS)))
        best, to = np.concatenate(letters), np.concatenate(targets)
        nodes = np.arange(len(to))
        # ranks by the least string of one letter, then of 2, 4, ...; 0 is the end of a path
        code = np.where(best, np.arange(1, len(SIGNS) + 1), len(SIGNS) + 1)
        code[~best.any(axis=1)] = 0
        rank, pointer, reach = code.min(axis=1), np.where(best.any(axis=1), to[nodes, best.argmax(axis=1)], nodes), 1
        while (rank[pointer] > 0).any() and reach <= len(nodes):
            rank = np.unique(rank * (len(nodes) + 1) + rank[pointer], return_inverse=True)[1] + (rank.min() > 0)
            pointer, reach = pointer[pointer], 2 * reach
        self.rank = rank
        # of a node's arcs, that of the least letter, then of the node of least rank, is on its least path
        chosen = np.argmin(code * (len(nodes) + 1) + rank[to], axis=1)
        there = best.any(axis=1)
        self.letter = np.where(there, chosen, -1)
        pointer = np.where(there, to[nodes, chosen], nodes)
        self.pointers, length = [pointer], there.astype(np.int64)
        while (length[pointer] > 0).any():
            length, pointer = length + length[pointer], pointer[pointer]
            self.pointers.append(pointer)
        self.length, self.end = length, pointer

    def walk(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the least paths from the starts, without their ends, one path after the other; and the paths' lengths."""
        lengths = self.length[starts]
        away = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.repeat(starts, lengths)
        for k, pointer in enumerate(self.pointers):
            far = (away >> k) & 1 == 1
            at[far] = pointer[at[far]]
        return at, lengths


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, codes) to the block's costs from each state at its start to each at its end."""
    for b in small(batches):
        codes = b.column("codes").to_pylist()
        units = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, NEVER), (len(codes), 4, 4))
        tables = [d[0].ravel().tolist() for d in block_costs(codes, units)]
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("block"), pa.array(tables, pa.list_(pa.int64()))], ["conv", "block", "costs"])


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, codes, after, last) to the state at the block's end for each at its start."""
    for b in small(batches):
        codes, last = b.column("codes").to_pylist(), b.column("last").to_pylist()
        paths = LeastPaths(codes, block_costs(codes, np.array(b.column("after").to_pylist(), np.int64)[:, :, None]), last)
        ends = (paths.end[paths.base[:, None] + np.arange(4)] - paths.base[:, None]) % 4
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("block"), pa.array(ends.tolist(), pa.list_(pa.int64()))], ["conv", "block", "exits"])


PIECE = "conv string, block long, last boolean, cost long, blank long, duplicate long, truncated long, illegal long, first int, final int, audit string, lines long, repaired string"


def _illegal(letters: np.ndarray) -> int:
    """Adjacent letters that aren't su, ua or au."""
    a, b = letters[:-1], letters[1:]
    return int(np.count_nonzero(~((b == 1) & (a == 0) | (b == 2) & (a == 1) | (b == 1) & (a == 2))))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the costs after them and the state that enters them to what they add to their conversation."""
    for b in small(batches):
        codes, last = b.column("codes").to_pylist(), b.column("last").to_pylist()
        costs = block_costs(codes, np.array(b.column("after").to_pylist(), np.int64)[:, :, None])
        paths = LeastPaths(codes, costs, last)
        state = np.array(b.column("state").to_pylist())
        nodes, lengths = paths.walk(paths.base + state)
        signs, ends = "".join(np.array(list(SIGNS))[paths.letter[nodes]]), np.cumsum(lengths)
        out: dict[str, list] = {c: [] for c in ("cost", "blank", "duplicate", "truncated", "illegal", "first", "final", "audit", "lines", "repaired")}
        for i, (c, roles, texts) in enumerate(zip(codes, b.column("roles").to_pylist(), b.column("texts").to_pylist(), strict=True)):
            audit, lines = signs[ends[i] - lengths[i] : ends[i]], []
            for sign, node in zip(audit, (nodes[ends[i] - lengths[i] : ends[i]] - paths.base[i]).tolist(), strict=True):
                if sign != "D":
                    k, given = node // 4, ROLE[node % 4]
                    lines.append(f"{roles[k]}:{texts[k]}" if sign == "K" else f"{given}:{texts[k]}" if sign == "R" else f"{given}:")
            own = np.frombuffer(c, np.uint8)
            fault, letters = own % 4, own // 4
            values = (int(costs[i][0][state[i]][0]), *(int(np.count_nonzero(fault == f)) for f in (BLANK, COPY, CUT)), _illegal(letters), int(letters[0]), int(letters[-1]), audit, len(lines), "\n".join(lines))
            for name, v in zip(out, values, strict=True):
                out[name].append(v)
        kinds = {"audit": pa.string(), "repaired": pa.string(), "first": pa.int32(), "final": pa.int32()}
        columns = [b.column("conv"), b.column("block"), b.column("last"), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "block", "last", *out])


RESULT = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces, sorted by conversation and block, to a row for each conversation; the digest is fed piece by piece."""
    for b in small(batches):
        rows: list[dict] = []
        for p in b.to_pylist():
            if p["block"] == 0:
                held = p | {"audit": [p["audit"]], "lines": 0, "hash": hashlib.sha256()}
            else:
                for c in ("blank", "duplicate", "truncated"):
                    held[c] += p[c]
                held["illegal"] += p["illegal"] + _illegal(np.array([held["final"], p["first"]]))
                held["final"] = p["final"]
                held["audit"].append(p["audit"])
            if p["lines"]:
                held["hash"].update(("\n" * (held["lines"] > 0) + p["repaired"]).encode())
                held["lines"] += p["lines"]
            if p["last"]:
                rows.append({c: held[c] for c in ("conv", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "".join(held["audit"]), "repaired_sha256": held["hash"].hexdigest()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, JOINED)


JOINED = pa.schema([("conv", pa.string()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _product(x: Column, y: Column) -> Column:
    """Least sums over what lies between two tables of costs."""
    at = lambda t, i: F.element_at(t, i + 1)
    return F.array(*[F.least(F.lit(NEVER), *[at(x, 4 * i + j) + at(y, 4 * j + k) for j in range(4)]) for i in range(4) for k in range(4)])


def _doubled(rows: DataFrame, column: str, combine, blocks: int, back: bool, keep_) -> DataFrame:
    """(conv, block, column): each block's value combined with those of all blocks after it, or before it, in about log2(blocks) rounds."""
    reach = 1
    while reach < blocks:
        other = rows.select("conv", (F.col("block") + (reach if back else -reach)).alias("block"), F.col(column).alias("other"))
        both = combine(F.col("other"), F.col(column)) if back else combine(F.col(column), F.col("other"))
        both = F.when(F.col("other").isNotNull(), both).otherwise(F.col(column))
        rows = keep_(rows.join(other, ["conv", "block"], "left").select("conv", "block", both.alias(column)), "doubled")
        reach *= 2
    return rows


def _long_ones(blocks: DataFrame, most: int, keep_) -> DataFrame:
    """(conv, block, after, state) for the blocks of conversations of several blocks: costs after each, and the state that enters it."""
    long = keep_(blocks.where("blocks > 1").select("conv", "block", "codes", (F.col("block") == F.col("blocks") - 1).alias("last")), "long")
    tables = keep_(long.select("conv", "block", "codes").mapInArrow(_tables, "conv string, block long, costs array<long>"), "tables")
    suffix = _doubled(tables, "costs", _product, most, False, keep_)
    end = F.array(*[F.least(*[F.element_at("costs", 4 * i + j + 1) + F.lit(END[j]) for j in range(4)]) for i in range(4)])
    after = suffix.where("block > 0").select("conv", (F.col("block") - 1).alias("block"), end.alias("after"))
    long = keep_(long.join(after, ["conv", "block"], "left").withColumn("after", F.coalesce("after", F.array(*map(F.lit, END)).cast("array<long>"))), "after")
    exits = keep_(long.select("conv", "block", "codes", "after", "last").mapInArrow(_exits, "conv string, block long, exits array<long>"), "exits")
    # exits of all blocks up to one, for each state that enters the first: the earlier map is followed by the later
    follow = lambda first, then: F.transform(first, lambda s: F.element_at(then, (s + 1).cast("int")))
    prefix = _doubled(exits, "exits", follow, most, True, keep_)
    state = prefix.select("conv", (F.col("block") + 1).alias("block"), F.element_at("exits", 1).alias("state"))
    return keep_(long.select("conv", "block", "after").join(state, ["conv", "block"], "left").select("conv", "block", "after", F.coalesce("state", F.lit(0)).alias("state")), "entered")


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``rows``: conv (string), pos (1, 2, ... in its conversation), role, text, none of them null.
    """
    with Scratch(rows.sparkSession, "repair") as scratch:
        # the first rows of each role and text; all others are duplicates, if not blank. A row's own number keeps the join from any hot key
        place = F.floor((F.col("pos") - 1) / block).cast("long").alias("block")
        firsts = rows.groupBy("conv", "role", F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.min("pos").alias("pos"))
        firsts = firsts.select("conv", place, "pos").groupBy("conv", "block").agg(F.collect_list("pos").alias("firsts"))  # a block's rows at most
        last = F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)
        fault = F.when(last == "", BLANK).when(~last.isin(*ENDS), CUT).otherwise(FINE)
        letter = F.lit(len(LETTERS))
        for i, x in enumerate(LETTERS):
            letter = F.when(F.startswith("role", F.lit(x)), i).otherwise(letter)
        coded = rows.select("conv", place, F.struct("pos", fault.alias("fault"), letter.alias("letter"), "role", "text").alias("row"))
        grouped = coded.groupBy("conv", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))  # a block's rows at most
        fault = lambda r: F.when((r["fault"] != BLANK) & ~F.array_contains("firsts", r["pos"]), COPY).otherwise(r["fault"])
        hexed = F.array_join(F.transform("rows", lambda r: F.lpad(F.hex((4 * r["letter"] + fault(r)).cast("long")), 2, "0")), "")
        grouped = grouped.join(firsts, ["conv", "block"], "left").withColumn("firsts", F.coalesce("firsts", F.array().cast("array<long>")))
        grouped = grouped.select("conv", "block", F.unhex(hexed).alias("codes"), F.transform("rows", lambda r: r["role"]).alias("roles"), F.transform("rows", lambda r: r["text"]).alias("texts"))
        blocks = scratch.keep(grouped, "blocks")
        counts = scratch.keep(blocks.groupBy("conv").agg((F.max("block") + 1).alias("blocks")), "counts")
        most = counts.agg(F.max("blocks")).first()[0] or 0
        numbered = blocks.join(counts, "conv")
        ready = numbered.withColumn("last", F.col("block") == F.col("blocks") - 1)
        end = F.array(*map(F.lit, END)).cast("array<long>")
        if most > 1:
            entered = _long_ones(numbered, most, scratch.keep)
            ready = ready.join(entered, ["conv", "block"], "left").withColumns({"after": F.coalesce("after", end), "state": F.coalesce("state", F.lit(0))})
        else:
            ready = ready.withColumns({"after": end, "state": F.lit(0)})
        pieces = scratch.keep(ready.select("conv", "block", "last", "codes", "roles", "texts", "after", F.col("state").cast("long")).mapInArrow(_pieces, PIECE), "pieces")
        alone = pieces.where("last and block = 0").select(
            "conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256")
        )
        many = pieces.where("not (last and block = 0)").repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(_joined, RESULT)
        return keep(alone.unionByName(many), "repaired")


def op12(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    key = lambda rows: rows.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    rows = number_rows(key(damaged(conversations.select("conv_id", "turn", "role", "text"))), ["turn", "first_role", "tie", "copy"], within="conv", out="pos")
    rows = keep(rows.select("conv", "turn", "pos", "role", "text"), "damaged")
    span = (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps")
    gaps = rows.where("turn is not null").groupBy("conv").agg(span)
    out = key(conversations.select("conv_id").distinct()).join(gaps, "conv", "left").join(repair(rows), "conv", "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id", *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def _edits(state: int) -> str:
    """SQL for the ways to treat a row in a state, as structs of cost, audit and lines; null where a way is not open."""
    to = {1: (2, "user"), 0: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}[state]
    keep = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
    ways = [f"{{'c': s{state}.c + 4, 'a': 'D' || s{state}.a, 'r': s{state}.r}}"]
    ways.append(f"CASE WHEN fault < 2 THEN {{'c': s{to[0]}.c + 3 + 3 * fault, 'a': 'R' || s{to[0]}.a, 'r': list_prepend('{to[1]}:' || text, s{to[0]}.r)}} END")
    ways += [f"CASE WHEN fault < 2 AND letter = '{x}' THEN {{'c': s{t}.c + 3 * fault, 'a': 'K' || s{t}.a, 'r': list_prepend(role || ':' || text, s{t}.r)}} END" for x, t in keep.items()]
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1] AS b{state}"


def _inserted(state: str, of: str, role: str) -> str:
    return f"list_sort([{state}, {{'c': {of}.c + 3, 'a': 'I' || {of}.a, 'r': list_prepend('{role}:', {of}.r)}}])[1]"


#: The dynamic program over whole strings, a row at a time from the end.
OP12_SQL = rf"""
WITH RECURSIVE m AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS m
), o AS (
  SELECT conv_id, turn, coalesce(conv_id::VARCHAR, '') AS conv, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations
), k AS (
  SELECT o.*, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(place, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, m[(xor(c, b) & 255) + 1]))) % 20 AS kind FROM o, m
), d AS (
  SELECT conv, turn, role0, md5(text0) AS tie, CASE WHEN kind = 4 THEN 'user' ELSE role0 END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role0, tie, copy) AS pos, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last FROM d
), f AS (
  SELECT *, left(role, 1) AS letter, CASE WHEN last = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 3 WHEN last NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault FROM p
), w AS (
  SELECT conv, max(pos) + 1 AS i, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS s0, {{'c': 6::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS s1, {{'c': 3::BIGINT, 'a': 'I', 'r': ['assistant:']}} AS s2, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS s3
  FROM f GROUP BY conv
  UNION ALL
  SELECT conv, i, {_inserted("b0", "t2", "user")}, {_inserted("b1", "t2", "user")}, t2, t3 FROM (
    SELECT *, {_inserted("b2", "b3", "assistant")} AS t2, {_inserted("b3", "b2", "user")} AS t3 FROM (
      SELECT w.conv, pos AS i, {", ".join(_edits(q) for q in range(4))} FROM w JOIN f ON f.conv = w.conv AND f.pos = w.i - 1))
), a AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
    count(*) FILTER (pos > 1 AND (before || letter) NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(letter) OVER (PARTITION BY conv ORDER BY pos) AS before FROM f) GROUP BY conv
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(w.s0.c, 0)::BIGINT AS cost, coalesce(w.s0.a, '') AS audit, sha256(coalesce(array_to_string(w.s0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM o) c LEFT JOIN a USING (conv) LEFT JOIN w ON w.conv = c.conv AND w.i = 1
"""
