"""Product codes: every vector as one codebook index for each of its parts.

Components are whole numbers, floor(scale * x), and all sums are exact.  A codebook is improved by rounds of
assignment and means.  A part is assigned through the grid cell that it lies in: of the cell's box the least and
the greatest distance to every entry are known, and an entry whose least distance exceeds another's greatest
cannot be nearest anywhere in the box.  The entries that remain are kept by cell, and only these are evaluated
exactly; a kept cell serves all later parts in it.

Tasks send sums per part and entry, so a round moves as little as a codebook, whatever the number of rows.

Rows whose vector is null or holds null or non-finite components are left out.  Shorter vectors count as
followed by zeros, up to the length of the longest, rounded up to a multiple of the parts.  A null id comes after all
others and its row is coded like any other; rows with equal ids each count, in the order of their vectors.  Fewer
rows than entries give a smaller codebook; an empty table gives no rows.  Components whose whole number has
an absolute value of ``LARGEST`` or more are refused, since sums would leave 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.arrow_rows import columns_of
from sensorloom.llm.vectors import finite, matrix, width

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Side of a grid cell, as a power of two of whole components.
CELL_BITS = 10
#: Cells kept per part position and task; a full store starts again.
KEPT_CELLS = 1 << 16
LARGEST = 1 << 28
#: Rows worked on at once.
ROWS = 4096
#: Tasks that the rows of one label are spread over.
SALTS = 64


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    scaled = np.floor(vectors * float(scale))
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"components must stay below {LARGEST} in absolute value after scaling")
    return scaled.astype(np.int64)


class Cells:
    """The entries of one codebook that can be nearest, by grid cell."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS, most: int = KEPT_CELLS):
        self.entries, self.bits, self.most = entries, bits, most
        self.kept: dict[bytes, int] = {}

    def _possible(self, cells: np.ndarray) -> np.ndarray:
        """Rows of entries that are not dominated across the box of each cell."""
        low = (cells << self.bits)[:, None, :]
        high = low + (1 << self.bits) - 1
        below, beyond = low - self.entries, self.entries - high
        nearest = np.maximum(0, np.maximum(below, beyond))
        farthest = np.maximum(np.abs(below), np.abs(beyond))
        least, greatest = (nearest * nearest).sum(axis=2), (farthest * farthest).sum(axis=2)
        return least <= greatest.min(axis=1)[:, None]

    def masks(self, parts: np.ndarray) -> np.ndarray:
        """For every part which entries are evaluated, as bits."""
        cells = np.ascontiguousarray(parts >> self.bits)
        keys = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[at].tobytes() for at in first]
        if len(self.kept) + len(names) > self.most:
            self.kept.clear()
        unknown = [k for k, name in enumerate(names) if name not in self.kept]
        if unknown:
            possible = self._possible(cells[first[unknown]])
            bits = possible.astype(np.int64) @ (np.int64(1) << np.arange(len(self.entries), dtype=np.int64))
            for k, mask in zip(unknown, bits.tolist()):
                self.kept[names[k]] = mask
        return np.array([self.kept[name] for name in names], np.int64)[inverse]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry, ties to the lower index."""
        masks = self.masks(parts)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        index = np.zeros(len(parts), np.int64)
        for entry in range(len(self.entries)):
            rows = np.flatnonzero((masks >> entry) & 1)
            away = parts[rows] - self.entries[entry]
            distance = (away * away).sum(axis=1)
            closer = distance < best[rows]
            best[rows[closer]], index[rows[closer]] = distance[closer], entry
        return index, best


def _portions(batches, vector: str, size: int, scale: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, whole(matrix(columns_of(part, [vector])[0], size), scale)


def _summing(books: np.ndarray, vector: str, scale: int):
    """Sums and counts of the parts of each entry, one row for each that a task has met."""
    parts, entries, deep = books.shape

    def summed(batches):
        cells = [Cells(book) for book in books]
        sums, counts = np.zeros((parts, entries, deep), np.int64), np.zeros((parts, entries), np.int64)
        for _, whole_ in _portions(batches, vector, parts * deep, scale):
            for part in range(parts):
                rows = whole_[:, part * deep: (part + 1) * deep]
                index = cells[part].nearest(rows)[0]
                np.add.at(sums[part], index, rows)
                counts[part] += np.bincount(index, minlength=entries)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
             pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return summed


def _improved(rows: DataFrame, books: np.ndarray, vector: str, scale: int) -> np.ndarray:
    """The codebooks after one round; entries without parts stay."""
    deep = books.shape[2]
    sent = rows.select(vector).mapInArrow(
        _summing(books, vector, scale), "part int, entry int, n long, sums array<long>")
    totals = sent.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(deep)])
    books = books.copy()
    for row in totals.collect():  # as many rows as there are entries
        books[row["part"], row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(deep)]
    return books


def train(rows: DataFrame, id_: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> np.ndarray:
    """Codebooks (part, entry, component) that start as the parts of the rows with the smallest ids."""
    size = width(rows, vector, parts)
    first = rows.select(id_, vector).orderBy(F.col(id_).asc_nulls_last(), vector).limit(entries).collect()
    start = np.zeros((len(first), size))
    for k, row in enumerate(first):
        start[k, : len(row[vector])] = row[vector]
    books = whole(start, scale).reshape(len(first), parts, size // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        books = _improved(rows, books, vector, scale)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray, id_: str, vector: str, carried: str, scale: int = SCALE) -> DataFrame:
    """(id, carried column, code, error): two hex digits for each part, and the squared distances summed."""
    parts, entries, deep = books.shape
    schema = rows.schema

    def coded(batches):
        cells = [Cells(book) for book in books]
        for part, whole_ in _portions(batches, vector, parts * deep, scale):
            code, error = np.zeros((len(whole_), parts), np.uint8), np.zeros(len(whole_), np.int64)
            for k in range(parts):
                index, distance = cells[k].nearest(whole_[:, k * deep: (k + 1) * deep])
                code[:, k] = index
                error += distance
            yield pa.RecordBatch.from_arrays(
                [*columns_of(part, [id_, carried]), pa.array([row.tobytes().hex() for row in code], pa.string()), pa.array(error)],
                ["id", "carried", "code", "error"])

    types = [schema[name].dataType.simpleString() for name in (id_, carried)]
    return rows.select(id_, carried, vector).mapInArrow(
        coded, f"id {types[0]}, carried {types[1]}, code string, error long")


def compress(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) for every row that takes part."""
    rows = vectors.filter(finite(vector)).select(id_, vector, label)
    books = train(rows, id_, vector)
    coded = encode(rows, books, id_, vector, label)
    # A label may hold most rows: its sum is copied to every salt, and its rows go to the salt of their code.
    by_label = coded.groupBy(F.col("carried").alias("_label")).agg(F.sum("error").alias("label_error")).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    joined = salted.join(
        by_label.withColumnRenamed("_salt", "_label_salt"),
        F.col("carried").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_label_salt")))
    return joined.select(
        F.col("id").alias(id_), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
