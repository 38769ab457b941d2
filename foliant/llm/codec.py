"""SentencePiece encoding and decoding: an Aho-Corasick automaton over all pieces drives one Viterbi pass.

The automaton reads a unit once; at each position it follows its output links, longest piece first, and each
piece that ends there, and may follow the last piece where it starts (``pieces.Junctions``), relaxes the best score. Equal
scores keep the longest last piece. Units repeat, so a task remembers the ids of short ones, up to ``MEMO_BYTES``. The
vocabulary is broadcast; its size is fixed by the file.

Cases: a null or empty text has no ids and decodes to an empty text. Every text is decoded to itself.
A long run without spaces is one unit, and is not remembered. Repeated rows repeat their result; no rows give no rows. Columns named
like the results are replaced.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import once, small
from .pieces import MODEL, SPACE, Junctions, Pieces, load_pieces, parts_of, units_of

#: What a task remembers of units, in bytes; units of more characters than ``SHORT`` aren't remembered.
MEMO_BYTES, SHORT = 96 << 20, 64
#: About what a remembered unit takes besides its characters and ids.
ENTRY = 200


class Encoder(dict):
    """Ids of units as int32 bytes. What was used since about half of ``MEMO_BYTES`` of new units is remembered."""

    def __init__(self, pieces: Pieces):
        import ahocorasick

        super().__init__()
        self.pieces, self.units, self.older, self.held = pieces, pieces.units, {}, 0
        self.lengths = [0] * len(pieces.raw)
        self.automaton = ahocorasick.Automaton()
        for p, (i, score) in pieces.scores.items():
            self.lengths[i] = len(p)
            self.automaton.add_word(p, (i, len(p), score))
        self.automaton.make_automaton()
        self.may = Junctions(pieces)
        self.space = [pieces.byte_ids[b] for b in SPACE.encode()]

    def __missing__(self, unit: str) -> bytes:
        out = self.older.get(unit)
        if out is None:
            ids: list[int] = []
            for part in parts_of(unit):
                ids += self.space if part is None else self.best(part)
            out = array("i", ids).tobytes()
            if len(unit) > SHORT:
                return out
        self.held += ENTRY + len(unit) + len(out)
        if self.held > MEMO_BYTES // 2:
            self.older, self.held = dict(self), 0
            self.clear()
        self[unit] = out
        return out

    def last_pieces(self, part: str) -> list[int]:
        """Last piece of the best segmentation of each prefix, -1 for bytes."""
        may, count, floor, n = self.may, self.may.count, self.pieces.floor, len(part)
        score, last, row = [0.0], [-1], [0]  # by position; row is where the junctions of the last piece begin
        done = 0
        for end, (i, length, s) in self.automaton.iter(part):
            while done <= end:  # positions that are reached for the first time, by bytes
                score.append(score[done] + floor)
                last.append(-1)
                row.append(0)
                done += 1
            end += 1
            start = end - length
            s += score[start]
            if s > score[end] and may[row[start] + i]:
                score[end] = s
                last[end] = i
                row[end] = (i + 1) * count
        last += [-1] * (n - done)
        return last

    def best(self, part: str) -> list[int]:
        last, lengths, at = self.last_pieces(part), self.lengths, len(part)
        ids: list[int] = []
        while at:
            i = last[at]
            if i >= 0:
                ids.append(i)
                at -= lengths[i]
            else:
                at -= 1
                ids += [self.pieces.byte_ids[b] for b in reversed(part[at].encode())]
        ids.reverse()
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, units_of(text, self.units)))


def decode_ids(ids: list[int], raw: list[bytes]) -> str:
    return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")[1:]


def _mapped(df: DataFrame, column: str, fields: list[T.StructField], make) -> DataFrame:
    """``df`` with ``fields``, which ``make()`` makes a function of an Arrow column to Arrow columns for."""
    names = [f.name for f in fields]
    rows = df.select(*[c for c in df.columns if c not in names or c == column])
    plain = [c for c in rows.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in plain), *f(b.column(column))], [*plain, *names])

    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in plain), *fields]))


def _ids(encoder: Encoder, texts: list[str | None]) -> pa.ListArray:
    ids = [encoder.encode(t) for t in texts]
    at = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(x) // 4 for x in ids], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _texts(raw: pa.Array, column: pa.ListArray) -> list[str]:
    """The bytes of all ids of a batch are taken at once, and cut at the documents' ends."""
    ends = column.offsets.to_numpy().astype(np.int64)
    taken = raw.take(column.values.slice(ends[0], ends[-1] - ends[0]))
    at = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset : taken.offset + len(taken) + 1]
    data, cuts = taken.buffers()[2], at[ends - ends[0]]
    data = b"" if data is None else data.to_pybytes()
    return [data[a:b].decode("utf-8", "replace")[1:] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, pieces: Pieces, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Adds ``out``, the ids of ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def make():
        encoder = once("encoder", shared.value, lambda: Encoder(shared.value))
        return lambda texts: [_ids(encoder, texts.to_pylist())]

    return _mapped(df, text, [T.StructField(out, IDS)], make)


def decode(df: DataFrame, pieces: Pieces, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text that ``ids`` stand for."""
    shared = df.sparkSession.sparkContext.broadcast(pieces.raw)

    def make():
        raw = pa.array(shared.value, pa.binary())
        return lambda column: [pa.array(_texts(raw, column), pa.string())]

    return _mapped(df, ids, [T.StructField(out, T.StringType())], make)


def round_trip(df: DataFrame, pieces: Pieces, text: str = "text") -> DataFrame:
    """Adds ``token_ids``, ``decoded_sha256`` of the text decoded from them, and ``round_trip``, whether that is ``text``; in one step."""
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def make():
        encoder = once("encoder", shared.value, lambda: Encoder(shared.value))
        raw = pa.array(shared.value.raw, pa.binary())

        def f(column):
            texts = column.to_pylist()
            ids = _ids(encoder, texts)
            decoded = _texts(raw, ids)
            same = [d == (t or "") for d, t in zip(decoded, texts, strict=True)]
            return [ids, pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()), pa.array(same, pa.bool_())]

        return f

    return _mapped(df, text, [T.StructField("token_ids", IDS), T.StructField("decoded_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())], make)


def op8(spark: SparkSession, documents: DataFrame, path: str = MODEL) -> DataFrame:
    coded = round_trip(documents.select("doc_id", "text"), load_pieces(path))
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded_sha256", "round_trip")
