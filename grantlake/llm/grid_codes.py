"""Product quantisation of vectors to byte codes, exact, by memoised grid cells.

A vector of integers is cut into equal parts, each with a codebook of up to 256 entries.  To find a part's nearest entry,
the part's coarse grid cell is looked up.  For a cell that isn't known yet, the least and the greatest squared distance of
its box from every entry are summed up from tables by coordinate; an entry whose least distance is above the smallest
greatest one is dominated in the whole box and can't be the nearest of any part in it.  The entries that are left are
remembered with the cell, and only they are evaluated exactly.  So the size of the cells and of the memory changes the
work alone, never the result.

A round of training is one pass over the vectors: tasks sum up the parts of each entry, Spark adds the sums, and the
codebooks (parts x 256 entries, whatever the number of vectors) go back to the tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.shared import cut

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Side of a grid cell in scaled units, and the cells remembered in a task.
CELL, REMEMBERED = 32, 100_000
#: Cells bounded, and distances evaluated, in one block.
BLOCK, PAIRS = 1024, 1 << 18


class Codebook:
    """Nearest entries of one part; ``entries`` is an array (entry, component) of integers."""

    def __init__(self, entries: np.ndarray, cell: int = CELL):
        self.entries, self.cell = entries, cell
        self.cells: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def _undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell (row of coordinates) the entries that may be the nearest of a point in it, in order."""
        out = []
        tables = []
        for j in range(cells.shape[1]):
            at, place = np.unique(cells[:, j], return_inverse=True)
            low, e = at[:, None] * self.cell, self.entries[None, :, j]
            below, above = low - e, e - (low + self.cell - 1)
            tables.append((place, np.maximum(np.maximum(below, above), 0) ** 2, np.maximum(np.abs(below), np.abs(above)) ** 2))
        for i in range(0, len(cells), BLOCK):
            least, most = (sum(t[k][t[0][i : i + BLOCK]] for t in tables) for k in (1, 2))
            rows, entries = np.nonzero(least <= most.min(axis=1)[:, None])
            out += np.split(entries.astype(np.int16), np.searchsorted(rows, np.arange(1, len(least))))
        return out

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """As above, from memory where a cell was met before."""
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in self.cells]
        found = dict(zip(new, self._undominated(cells[new]))) if new else {}
        out = [found[i] if i in found else self.cells[k] for i, k in enumerate(keys)]
        if len(self.cells) + len(new) > REMEMBERED:
            self.cells.clear()
        self.cells.update((keys[i], x) for i, x in list(found.items())[:REMEMBERED])
        return out

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest entry; of equal ones the first."""
        cells = np.ascontiguousarray(values // self.cell)
        _, first, which = np.unique(cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel(), return_index=True, return_inverse=True)
        lists = self.candidates(cells[first])
        sizes = np.array([len(x) for x in lists])
        flat, begins = np.concatenate(lists).astype(np.int64), np.cumsum(sizes) - sizes
        codes, errors = np.empty(len(values), np.int64), np.empty(len(values), np.int64)
        counts = sizes[which]
        ends = np.cumsum(counts)
        self.evaluated += int(ends[-1])
        at = 0
        while at < len(values):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
            n = counts[at:to]
            starts = np.cumsum(n) - n
            entry = flat[np.repeat(begins[which[at:to]] - starts, n) + np.arange(int(n.sum()))]
            distance = ((np.repeat(values[at:to], n, axis=0) - self.entries[entry]) ** 2).sum(axis=1)
            errors[at:to] = np.minimum.reduceat(distance, starts)
            codes[at:to] = np.minimum.reduceat(np.where(distance == np.repeat(errors[at:to], n), entry, len(self.entries)), starts)
            at = to
        return codes, errors


def usable(vectors: DataFrame, parts: int = PARTS) -> tuple[DataFrame, int]:
    """(vec_id, label, v) of the vectors that count, and their length; 0 if there are none.

    Vectors that are null or hold a null or non-finite component go.  Vectors must have one length, a multiple of the
    number of parts; of several lengths the most frequent counts (then the smallest), and the other vectors go.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall("v", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), v.alias("v")).where(F.col("v").isNotNull() & finite)
    size = F.size("v")
    common = rows.where((size > 0) & (size % parts == 0)).groupBy(size.alias("size")).count().orderBy(F.desc("count"), "size").first()
    return (rows.where(size == (common["size"] if common else 0)), common["size"] if common else 0)


def _integers(column: pa.Array, length: int, scale: int) -> np.ndarray:
    """Rows of floor(scale x); raises where squared distances wouldn't fit a long."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length) * float(scale))
    if values.size and np.abs(values).max() >= (2**61 / length) ** 0.5:
        raise ValueError("components too large: squared distances overflow a long")
    return values.astype(np.int64)


def first_entries(rows: DataFrame, entries: int, length: int, scale: int) -> np.ndarray:
    """The vectors of the smallest ids, in order; of rows that repeat an id the smallest vector, a null id last."""
    ids = rows.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries)
    own = rows.join(F.broadcast(ids.withColumnRenamed("vec_id", "of")), F.col("vec_id").eqNullSafe(F.col("of")), "left_semi")
    some = own.groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(F.asc_nulls_last("vec_id")).collect()
    return _integers(pa.array([r.v for r in some], pa.list_(pa.float64())), length, scale)


def train(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, cell: int = CELL) -> np.ndarray:
    """Codebooks (part, entry, component) after some rounds of assigning and averaging."""
    start = first_entries(rows, entries, length, scale)
    books = np.stack(np.split(start, parts, axis=1))

    def sums(books: np.ndarray):
        def run(batches):
            own = [Codebook(b, cell) for b in books]
            total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                for p, values in enumerate(np.split(_integers(batch.column(0), length, scale), parts, axis=1)):
                    if len(values):
                        codes, _ = own[p].nearest(values)
                        np.add.at(total[p], codes, values)
                        count[p] += np.bincount(codes, minlength=books.shape[1])
            p, e = np.nonzero(count)
            width = books.shape[2]
            columns = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p)), total[p, e].ravel(), np.repeat(count[p, e], width)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "place", "total", "n"])

        return run

    for _ in range(rounds):
        added = rows.select("v").mapInArrow(sums(books), "part long, entry long, place long, total long, n long").groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        new = books.copy()
        for r in added.collect():
            new[r.part, r.entry, r.place] = r.total // r.n
        books = new
    return books


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_vectors(rows: DataFrame, books: np.ndarray, scale: int = SCALE, cell: int = CELL) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part, and the squared distance from the coded vector."""
    parts, _, width = books.shape

    def run(batches):
        own = [Codebook(b, cell) for b in books]
        for batch in batches:
            values = _integers(batch.column(2), parts * width, scale)
            found = [own[p].nearest(values[:, p * width : (p + 1) * width]) for p in range(parts)] if len(values) else []
            digits = np.stack([c for c, _ in found], axis=1).astype(np.uint8).tobytes().hex() if found else ""
            codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            errors = sum(e for _, e in found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long")


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, cell: int = CELL) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256), a row for each vector that counts (see ``usable``).

    Repeated rows are coded each and all weigh in.  A null vec_id is coded too and comes last among the first entries.
    With fewer vectors than entries the codebooks are as small.  Null labels are together.  No vectors, no rows.
    """
    rows, length = usable(vectors, parts)
    if not length:
        label = vectors.schema["label"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {label}, code string, error long, label_error long, codebooks_sha256 string")
    books = train(rows, length, parts, entries, rounds, scale, cell)
    coded = cut(encode_vectors(rows, books, scale, cell))
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
