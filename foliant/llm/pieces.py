"""The piece vocabulary of a SentencePiece file, and the units it is applied to.

Files of type BPE hold merge ranks for scores. Summing those isn't a likelihood, and its best segmentation is about
a third longer than the model's own. So for such files a segmentation may only have junctions
that merging leaves: a piece may follow another if merging the characters of both ends in just these
two. The dynamic programs relax the best score among all pieces that may follow, and their
result equals that of the file's own encoder. For files of type unigram (``kind="unigram"``) every piece may follow every other.

A character that no piece holds is written as its UTF-8 bytes. A text is normalised as the file's model does
it: one space is put in front, and spaces are written as U+2581. No piece holds U+2581 after
another character, so a text may be cut before each run of spaces without any effect; a cut round a line
feed is likewise free if no piece holds one. U+2581 in the text itself is written as bytes, so decoding gives back
every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"


@dataclass(frozen=True)
class Pieces:
    scores: dict[str, tuple[int, float]]  # of a piece: id and score
    byte_ids: list[int]  # by byte
    raw: list[bytes]  # by id, what a piece decodes to
    floor: float  # score of a character written as bytes
    cut_lines: bool
    kind: str = "merges"

    @property
    def units(self) -> re.Pattern:
        return re.compile("\n| *[^ \n]+| +" if self.cut_lines else " *[^ ]+| +")


def load_pieces(path: str = MODEL, kind: str = "merges") -> Pieces:
    """Read a SentencePiece file with byte fallback; ``kind`` is "merges" for type BPE, "unigram" for type unigram."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, byte_ids, raw, least = {}, [0] * 256, [], 0.0
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            raw.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            raw.append(b"")
        else:
            scores[p] = (i, sp.get_score(i))
            least = min(least, scores[p][1])
            raw.append(p.replace(SPACE, " ").encode())
    if any(SPACE in p.lstrip(SPACE) for p in scores):
        raise ValueError("a piece holds a space after another character, so texts can't be cut at spaces")
    # with merges, bytes are only for characters that no piece holds: worse than any pieces over a piece's length
    floor = least - 10.0 if kind == "unigram" else (max(map(len, scores), default=0) + 2) * least - 10.0
    return Pieces(scores, byte_ids, raw, floor, not any("\n" in p for p in scores), kind)


class Junctions(dict):
    """Whether a piece may follow another, by (id of the first + 1) * number of pieces + id of the second; the first
    is -1 after bytes and at the start. Those of the last ``MOST`` new ones are remembered (about 100 bytes each, twice)."""

    MOST = 600_000

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.scores, self.free = pieces.scores, pieces.kind == "unigram"
        self.count, self.older = len(pieces.raw), {}
        self.names: list[str | None] = [None] * self.count
        for name, (i, _) in pieces.scores.items():
            self.names[i] = name

    def __missing__(self, key: int) -> bool:
        ok = self.older.get(key)
        if ok is None:
            first, second = divmod(key, self.count)
            a, b = self.names[first - 1] if first else None, self.names[second]
            ok = self.free or a is None or self.merged(a + b) == [a, b]
        if len(self) >= self.MOST:
            self.older = dict(self)
            self.clear()
        self[key] = ok
        return ok

    def merged(self, text: str) -> list[str]:
        """The characters of ``text``, merged by best score, at equal scores from the left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.scores.get(parts[i] + parts[i + 1])
                if found and (best is None or found[1] > best):
                    best, at = found[1], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


def units_of(text: str | None, units: re.Pattern) -> list[str]:
    return units.findall(" " + text) if text else []


def parts_of(unit: str) -> list[str | None]:
    """A unit in normal form, cut at each U+2581 of the text itself, which becomes None."""
    if SPACE not in unit:
        return [unit.replace(" ", SPACE)]
    out: list[str | None] = []
    for i, x in enumerate(unit.split(SPACE)):
        out += [None] * (i > 0) + [x.replace(" ", SPACE)] * bool(x)
    return out
