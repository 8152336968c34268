"""Packing of token sequences by vector bin packing.

An example is a vector (tokens, segments, loss-bearing tokens) and a sequence has a limit on each.  Each task keeps up to
``WAITING`` examples that fit a sequence, more if these are so short that they don't fill two.  When they are that many it fills one sequence: among the examples that still
fit it takes the one whose need has the largest dot product with the room left (both as shares of the limits), until
none fits.  So examples that fit a sequence are placed whole.  Longer examples are cut anyway: they are the stock, from
which full sequences are made and gaps are closed, and a reserve of it is kept to the end of the task.  Only where the
stock has run out and a gap is above ``SLACK`` tokens, an example that would fit is cut and goes to the stock.  The last
sequence of the stock is cut into power-of-two lengths, which need no padding.

Nothing is shuffled for documents: a sequence holds documents of one task, whose rows are those of one input split, so a
task that is run again builds the same sequences.  Memory per task is one Arrow batch, the waiting examples and the
stock's reserve with the example in work.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.text import byte_column

LENGTH = 1024
SEGMENTS = 64
WAITING = 192
SLACK = 16
#: Tokens of the stock, in sequences, that are kept for gaps until the end of a task.
RESERVE = 24
#: Turns of a conversation that are one example.
TURNS = 64
END_ID = 0
SPECIAL, SPECIAL_ID = b"<|endoftext|>", 50256

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def _encoder(ranks_path: str):
    """bytes -> ids as little-endian 32-bit numbers, equal to those of the tokenizers file of the same vocabulary."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    core = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = np.array([SPECIAL_ID], "<u4")

    def encode(text: bytes) -> np.ndarray:
        parts = text.split(SPECIAL)  # the file has it as an added token
        ids = [core.encode_to_numpy(p.decode("utf-8", "replace"), disallowed_special=()) for p in parts]
        if len(ids) > 1:
            ids = [x for i in ids for x in (special, i)][1:]
        return np.concatenate([*ids, np.array([END_ID])]).astype("<u4")

    return encode


class Packer:
    """Sequences of one task; ``rows`` gets (key, start, length, crc, doc_tokens, sequence, offset, loss)."""

    def __init__(self, length: int, segments: int, loss: int, waiting: int, first_id: int):
        self.limits = np.array([length, segments, loss], float)
        self.length, self.next_id = length, first_id
        self.needs = np.full((waiting, 3), np.inf)  # no need fits where nobody waits
        self.waiting: list[tuple | None] = [None] * waiting
        self.free_places = list(range(waiting))[::-1]
        self.stock: deque[list] = deque()  # [key, ids, marks of loss-bearing tokens or None, next token]
        self.stocked = self.held = 0  # tokens of the stock and of those that wait
        self.rows: list[tuple] = []

    def _loss(self, trained: np.ndarray | None, start: int, end: int) -> int:
        return end - start if trained is None else int(trained[start:end].sum())

    def add(self, key: tuple, ids: np.ndarray, trained: np.ndarray | None = None) -> None:
        """Take one example; ``trained`` marks the loss-bearing tokens, by default all."""
        need = np.array([len(ids), 1, self._loss(trained, 0, len(ids))], float)
        if (need > self.limits).any():
            self._stock(key, ids, trained)
            while self.stocked > (RESERVE + 1) * self.length:
                self._fill(whole=False)
            return
        place = self.free_places.pop()
        self.needs[place], self.waiting[place] = need, (key, ids, trained)
        self.held += len(ids)
        if not self.free_places:
            if self.held < 2 * self.length:  # they are too short to fill a sequence: more of them wait
                self._widen()
            else:
                self._fill()

    def _widen(self) -> None:
        n = len(self.waiting)
        self.needs = np.concatenate([self.needs, np.full((n, 3), np.inf)])
        self.waiting += [None] * n
        self.free_places = list(range(n, 2 * n))[::-1]

    def _take(self, place: int) -> tuple:
        out = self.waiting[place]
        self.needs[place], self.waiting[place] = np.inf, None
        self.free_places.append(place)
        self.held -= len(out[1])
        return out

    def _fill(self, whole: bool = True, last: bool = False) -> None:
        """One sequence: examples placed whole while any fits, then pieces of the stock."""
        taken, pieces, free = [], [], self.limits.copy()
        while whole and free.min() > 0:
            fits = (self.needs <= free).all(axis=1)
            if not fits.any():
                break
            gain = np.where(fits[:, None], self.needs, 0) @ (free / self.limits**2)
            place = int(gain.argmax())
            free -= self.needs[place]
            taken.append(self._take(place))
        alone = len(self.free_places) == len(self.waiting)
        if not whole and last:  # the end of the stock
            free[0] = min(self.length, 1 << (self.stocked.bit_length() - 1))
        elif not self.stock and free[0] > SLACK and free.min() > 0:
            if not alone:  # the largest of the others closes the gap
                self._stock(*self._take(int(np.where(np.isfinite(self.needs[:, 0]), self.needs[:, 0], -1).argmax())))
            elif last:
                for example in taken:
                    self._stock(*example)
                return
        pieces = [(key, 0, ids, len(ids), self._loss(trained, 0, len(ids))) for key, ids, trained in taken]
        while self.stock and free.min() > 0:
            key, ids, trained, start = self.stock[0]
            end = min(len(ids), start + int(free[0]))
            if self._loss(trained, start, end) > free[2]:  # as far as the limit on loss-bearing tokens allows
                end = start + (int(free[2]) if trained is None else int(np.searchsorted(np.cumsum(trained[start:end]), free[2], side="right")))
            if end == start:
                break
            loss = self._loss(trained, start, end)
            pieces.append((key, start, ids[start:end], len(ids), loss))
            free -= (end - start, 1, loss)
            self.stocked -= end - start
            self.stock[0][3] = end
            if end == len(ids):
                self.stock.popleft()
        at = 0
        for key, start, ids, total, loss in pieces:
            self.rows.append((key, start, len(ids), zlib.crc32(ids), total, self.next_id, at, loss))
            at += len(ids)
        self.next_id += 1

    def _stock(self, key: tuple, ids: np.ndarray, trained: np.ndarray | None) -> None:
        self.stock.append([key, ids, trained, 0])
        self.stocked += len(ids)

    def finish(self) -> None:
        """Place all that waits, then all of the stock."""
        while len(self.free_places) < len(self.waiting):
            self._fill(last=True)
        while self.stock:
            self._fill(whole=False, last=True)

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _place(batches: Iterator, ranks_path: str | None, limits: tuple[int, int, int], examples, more: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    """Packs what ``examples(batches, encode)`` gives: lists of ((id, ...), token ids, marks or None), one list at a time.

    Parts of the id beyond the first are columns at the end.
    """
    import public_tokenizers

    encode = _encoder(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    packer = Packer(*limits, WAITING, TaskContext.get().partitionId() << 36)
    names = [*NAMES, *more]

    def out():
        rows = [(key[0], *row, *key[1:]) for key, *row in packer.taken()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*rows)) or [()] * len(names)], names)

    for some in examples(batches, encode):
        for example in some:
            packer.add(*example)
        yield out()
    packer.finish()
    yield out()


def pack(documents: DataFrame, ranks_path: str | None = None, length: int = LENGTH, segments: int = LENGTH, loss_tokens: int = LENGTH) -> DataFrame:
    """One row per piece of a document: where it starts in the document, its length, and its sequence and offset.

    A null or empty text is one end token.  Every token lies in exactly one piece; pieces of a sequence follow each
    other without a gap.  By default a sequence may hold as many pieces as tokens, so that short documents leave no
    padding.  Repeated rows are packed each.  All tokens of plain documents bear loss.  The vocabulary's
    path is looked up in the tasks if none is given.
    """

    def examples(batches, encode):
        for batch in batches:
            yield (((doc_id,), encode(text), None) for doc_id, text in zip(batch.column(0).to_pylist(), byte_column(batch.column(1))))

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda batches: _place(batches, ranks_path, (length, segments, loss_tokens), examples), SCHEMA)


def pack_conversations(
    conversations: DataFrame, ranks_path: str | None = None, length: int = LENGTH, segments: int = SEGMENTS, loss_tokens: int = LENGTH * 3 // 4, answers: str = "assistant"
) -> DataFrame:
    """One row per piece of an example of instruction data, with the columns of ``pack`` and ``first_turn``.

    An example is a run of turns of one conversation: those whose turn numbers are in the same block of ``TURNS``, so a
    conversation of any length is split.  Each turn ends with the end token; the tokens of turns whose role is ``answers``
    bear loss, and a sequence has ``loss_tokens`` of them at most.  Equal rows count once, several texts of one turn are in
    order of role and text; a null turn comes before the others, in an example of its own.  A null text is empty, and
    ``doc_id`` is the conversation.  Examples meet in tasks by a hash of conversation and block, sorted, so no task holds
    more than an example.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.floor(F.col("turn") / TURNS).cast("long").alias("block"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    ).distinct()
    turns = turns.repartition("conv", "block").sortWithinPartitions("conv", "block", "turn", "role", "text")

    def examples(batches, encode):
        key, parts, marks = None, [], []
        whole = lambda: ((key[0], None if key[1] is None else key[1] * TURNS), np.concatenate(parts), np.concatenate(marks))
        for batch in batches:
            done = []
            for conv, block, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), byte_column(batch.column(4))):
                if parts and (conv, block) != key:
                    done.append(whole())
                    parts, marks = [], []
                key = conv, block
                parts.append(encode(text))
                marks.append(np.full(len(parts[-1]), role == answers))
            yield done
        if parts:
            yield [whole()]

    return turns.mapInArrow(lambda batches: _place(batches, ranks_path, (length, segments, loss_tokens), examples, ("first_turn",)), SCHEMA + ", first_turn long")
