"""SentencePiece merge-type (BPE) encoding by backtracking, and decoding.

The merge procedure joins the best-scored neighbours again and again.  Its result is the only sequence of pieces over a
text in which every two neighbours are compatible: merging the two pieces' characters anew gives just these two.  (A
merge across a border would be made in the same order for the two pieces alone, so compatible neighbours never merge;
and what the procedure leaves apart, it leaves apart for the two pieces alone as well.)  So pieces are placed from left
to right, the longest match first; where it isn't compatible with the piece before it, the next shorter one is tried,
and where none is, the last piece is taken back and the position is marked as failed in a bitfield, so that no position
is worked off twice.  Matches come from an Aho-Corasick automaton over the reversed pieces and the reversed text, which
gives the longest piece that starts at each position.  Work is linear in the text, for one word of many MB as well.

Texts are cut where no piece of the vocabulary goes across: before a space mark that follows another character, and
after the last of some letters.  The ids of short parts are remembered, up to a number of them.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Fixed values of the model file: field numbers and kinds of pieces.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Latin letters with and without accents; a part is space marks, then what is neither a mark nor such a letter, then letters.
LETTERS = "A-Za-zÀ-ɏ"
PARTS = f"{SPACE}*[^{SPACE}{LETTERS}]*[{LETTERS}]*"
#: Parts of up to so many characters are remembered, and twice so many of them; texts that are worked off together, in bytes.
SHORT, REMEMBERED, TEXTS = 48, 400_000, 1 << 22
#: Positions of a long part for which matches are held at a time.
BLOCK = 1 << 12


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""

    def number(at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            out |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return out, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = {1: (8, at), 5: (4, at)}.get(key & 7) or number(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Pieces:
    """A merge-type model with byte fallback, a dummy prefix and no normalisation; other models are refused."""

    def __init__(self, path: str):
        import struct

        import ahocorasick

        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        trainer, normalizer = (dict(x for n, v in parts if n == k for x in _fields(v)) for k in (TRAINER, NORMALIZER))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24) or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(3, 1):
            raise ValueError("not a merge-type model with byte fallback, dummy prefix and plain spaces")
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        for n, (_, value) in enumerate(p for p in parts if p[0] == PIECES):
            piece = dict(_fields(value))
            name, kind = piece[1].decode(), piece.get(3, NORMAL)
            if kind not in (NORMAL, UNKNOWN, CONTROL, BYTE):
                raise ValueError("pieces of the user's own or without use aren't supported")
            self.pieces.append(name)
            self.kinds.append(kind)
            if kind == NORMAL:
                self.ids[name] = n
                self.scores[name] = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.controls = {i for i, k in enumerate(self.kinds) if k == CONTROL}
        self.control = min(self.controls, default=-1)
        spaces = not any(SPACE in p.lstrip(SPACE) for p in self.scores)
        letters = not any(re.search(f"[{LETTERS}][^{LETTERS}]", p) for p in self.scores)
        self.parts = re.compile(PARTS if spaces and letters else f"{SPACE}*[^{SPACE}]*" if spaces else ".*", re.S)
        self.merges: dict[str, list[tuple[float, str, str]]] = {}
        for p in self.scores:
            left, steps = self.merge(p)
            if left == [p]:  # no other piece is ever left by merging
                self.merges[p] = steps
        whole = list(self.merges)
        self.width = max(map(len, whole), default=1)
        self.automaton = ahocorasick.Automaton()
        for p in whole:
            if len(p) > 1:  # a character stands for itself anyway
                self.automaton.add_word(p[::-1], p)
        self.automaton.make_automaton()
        known = set(whole)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known), "") for p in whole}
        self.compatible: dict[tuple[str, str], str] = {}
        self.codes: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}  # what was remembered before, until it is forgotten
        self.surface = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() if k == NORMAL else b" \xe2\x81\x87 " if k == UNKNOWN else b"" for p, k in zip(self.pieces, self.kinds)]

    def merge(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The merge procedure itself, for short texts: the best-scored pair first, of equal ones the leftmost.

        What is left, and for each merge its score and the first and the last part after it.
        """
        parts: list[str] = list(text)
        n, last, steps = len(parts), len(parts) - 1, []
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def pair(i: int) -> list[tuple[float, int, str]]:
            if i < 0 or after[i] >= n or (score := self.scores.get(both := parts[i] + parts[after[i]])) is None:
                return []
            return [(-score, i, both)]

        heap = [x for i in range(n) for x in pair(i)]
        heapify(heap)
        while heap:
            worth, i, both = heappop(heap)
            if not parts[i] or after[i] >= n or parts[i] + parts[after[i]] != both:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = both, "", after[gone]
            if after[i] < n:
                before[after[i]] = i
            else:
                last = i
            steps.append((-worth, parts[0], parts[last]))
            for x in pair(before[i]) + pair(i):
                heappush(heap, x)
        return [p for p in parts if p], steps

    def fitting(self, one: str, other: str) -> str:
        """The longest piece that begins ``other``, a piece itself, and can stand behind ``one``; '' if there is none."""
        held = self.compatible.get((one, other))
        if held is None:
            if len(self.compatible) > REMEMBERED:
                self.compatible.clear()
            held = other
            while held and not self.fits(one, held):
                held = self.shorter.get(held, "")
            self.compatible[one, other] = held
        return held

    def fits(self, one: str, other: str) -> bool:
        """Whether two pieces can be neighbours: merging both anew, no merge across their border is ever the best one."""
        left, right, score = self.merges.get(one, []), self.merges.get(other, []), self.scores.get
        i, j, last, first = 0, 0, one[-1], other[0]
        while True:
            x, y = left[i][0] if i < len(left) else -inf, right[j][0] if j < len(right) else -inf
            across = score(last + first)
            if across is not None and across > x and across >= y:  # of equal scores the one further left comes first
                return False
            if x >= y:
                if i == len(left):
                    return True
                last = left[i][2]
                i += 1
            else:
                first = right[j][1]
                j += 1

    def _longest(self, text: str):
        """Function from a position, as its distance from the text's last, to the longest piece of two characters or more that starts there.

        Of long texts a block of positions is looked at when one of it is asked for.
        """
        if len(text) <= BLOCK:
            return dict(list(self.automaton.iter(text[::-1]))[::-1]).get  # of one place the longest comes first
        held: dict[int, dict[int, str]] = {}

        def get(distance: int) -> str | None:
            block = distance // BLOCK
            if block not in held:
                if len(held) > 2:
                    held.clear()
                low = max(0, len(text) - (block + 1) * BLOCK)
                high = len(text) - block * BLOCK
                some = text[low : high + self.width]
                past = len(some) - (high - low)
                held[block] = {end - past + block * BLOCK: piece for end, piece in list(self.automaton.iter(some[::-1]))[::-1] if end >= past}
            return held[block].get(distance)

        return get

    def split(self, text: str) -> list[str]:
        """The pieces of a text whose spaces are marked; a character that is in no piece stands for itself."""
        longest, compatible, shorter = self._longest(text), self.compatible, self.shorter
        failed = bytearray()  # a bit for each position that has no way on
        out: list[str] = []
        at, n, last = 0, len(text), ""
        piece = longest(n - 1) or text[0] if n else ""
        while at < n:
            while piece:
                if last:
                    held = compatible.get((last, piece))
                    piece = self.fitting(last, piece) if held is None else held
                if not failed or not failed[(end := at + len(piece)) >> 3] >> (end & 7) & 1:
                    break
                piece = shorter.get(piece, "")
            if piece:
                out.append(piece)
                at += len(piece)
                last = piece
                if at < n:
                    piece = longest(n - 1 - at) or text[at]
            else:
                failed = failed or bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = shorter.get(out.pop(), "")
                at -= len(last)
                last = out[-1] if out else ""
        return out

    def _ids(self, part: str) -> bytes:
        pieces = self.split(part)
        out = list(map(self.ids.get, pieces))
        if None in out:
            out = [i for piece, known in zip(pieces, out) for i in ([self.bytes[b] for b in piece.encode()] if known is None else [known])]
        ids = array("i", out).tobytes()
        if len(part) <= SHORT:
            if len(self.codes) > REMEMBERED:
                self.codes, self.earlier = {}, self.codes
            self.codes[part] = ids
        return ids

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers."""
        if not text:
            return b""
        parts, codes = self.parts.findall(SPACE + text.replace(" ", SPACE)), self.codes
        out = list(map(codes.get, parts))
        if None in out:
            for i, held in enumerate(out):
                if held is None and parts[i]:
                    held = self.codes.get(parts[i]) or self.earlier.get(parts[i])
                    out[i] = self._ids(parts[i]) if held is None else held
        return b"".join(out[:-1])  # the last part is the empty one at the end

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without begin or end."""
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the mark that was put before the text goes, and bytes that are no character become U+FFFD each."""
        if self.controls.isdisjoint(ids):
            return self._text(ids, True)
        out, run = "", []
        for i in (*ids, self.control):  # bytes on both sides of a control piece are no character together
            if i in self.controls:
                out += self._text(run, not out)
                run = []
            else:
                run.append(i)
        return out

    def _text(self, ids: list[int], begins: bool) -> str:
        data = b"".join(map(self.surface.__getitem__, ids))
        if begins and ids and self.kinds[ids[0]] == NORMAL and self.pieces[ids[0]].startswith(SPACE):
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _repaired(data)


def _repaired(data: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


@lru_cache(2)
def _pieces(path: str | None) -> Pieces:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    made = Pieces(path)
    gc.freeze()  # the model stays: the collector needn't walk over it again and again
    return made


def _mapped(df: DataFrame, column: str, made: dict[str, str], work) -> DataFrame:
    """All columns by place and new ones (name: kind), which ``work`` makes of an array of ``column``; columns of their names are replaced."""
    kept = [c for c in df.columns if c not in made]
    rows = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(f"`{column}`").alias("value"))
    names = [*(f"c{i}" for i in range(len(kept))), *(f"made{i}" for i in range(len(made)))]
    kinds = [*(rows.schema[i].dataType.simpleString() for i in range(len(kept))), *made.values()]

    def run(batches):
        for batch in batches:
            at, size = 0, max(1, batch.num_rows * TEXTS // max(batch.nbytes, 1))
            while at < batch.num_rows:
                some = batch.slice(at, size)
                at += size
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], *work(some.column(len(kept)))], names)

    return rows.mapInArrow(run, ", ".join(map(" ".join, zip(names, kinds)))).toDF(*kept, *made)


def encode(documents: DataFrame, path: str | None = None, column: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """The rows with the ids of a text column, as ``sentencepiece`` encodes it without sampling, begin or end.

    With ``decoded``, what the ids decode to is a column too.  A null or empty text has no ids (an empty list).  Repeated
    rows stay.  Columns named as the results are replaced; all others stay, whatever their names.  The model's path is
    looked up in the tasks if none is given.
    """

    def work(texts: pa.Array) -> list[pa.Array]:
        model = _pieces(path)
        packed = [np.frombuffer(model.packed(t or ""), np.int32) for t in texts.to_pylist()]
        offsets = np.cumsum([0, *map(len, packed)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *packed])))
        return [lists, pa.array([model.decode(p.tolist()) for p in packed], pa.string())] if decoded else [lists]

    made = {ids: "array<int>"} | ({decoded: "string"} if decoded else {})
    return _mapped(documents.withColumn(column, F.col(f"`{column}`").cast("string")), column, made, work)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their ids; null and empty lists give an empty text, null ids count as none."""

    def work(lists: pa.Array) -> list[pa.Array]:
        model = _pieces(path)
        return [pa.array([model.decode([i for i in some if i is not None] if None in some else some) if some else "" for some in lists.to_pylist()], pa.string())]

    return _mapped(encoded, ids, {text: "string"}, work)
