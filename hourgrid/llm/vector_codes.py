"""Product codes of vectors in exact whole numbers.

Components become whole numbers and a vector is cut into parts, each with a codebook. Squared distances come from dot
products by matrix multiplication: numbers are split into limbs so short that every product of two limbs, summed over a
part, stays below 2^53 and float64 multiplication is exact. The limbs' products are shifted and added in int64, and the first
smallest entry wins. Rounds of assignment and means are jobs over all vectors; only sums per entry reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from hourgrid.llm.common import HOT_SHARE, SMALL, col, fresh, spread_lookup
from hourgrid.session import materialise

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Vectors multiplied at a time.
BLOCK = 4096


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, position]``, and a bound on the size of any component, entries and vectors alike."""

    entries: np.ndarray
    bound: int

    def sha256(self) -> str:
        """Digest of all components as decimal numbers by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def limbs(numbers: np.ndarray, width: int, count: int) -> list[np.ndarray]:
    """``numbers`` as float64 digits to the base 2^width, lowest first; the last one carries the sign."""
    mask = (1 << width) - 1
    low = [((numbers >> width * i) & mask).astype(np.float64) for i in range(count - 1)]
    return [*low, (numbers >> width * (count - 1)).astype(np.float64)]


def dots(left: np.ndarray, right: np.ndarray, bound: int) -> np.ndarray:
    """Exact dot products of all rows of ``left`` and ``right`` (..., rows, positions) as int64; no number is beyond ``bound``."""
    width = max((53 - max(left.shape[-1] - 1, 1).bit_length() - 1) // 2, 1)
    count = max(-(-(int(bound).bit_length() + 1) // width), 1)
    out = 0
    turned = [np.swapaxes(limb, -1, -2) for limb in limbs(right, width, count)]
    for i, a in enumerate(limbs(left, width, count)):
        for j, b in enumerate(turned):
            out = out + (np.matmul(a, b).astype(np.int64) << width * (i + j))
    return out


def nearest(parts: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """First nearest entry and its squared distance, for ``parts[part, row, position]``."""
    entries = books.entries
    own = (entries * entries).sum(-1)
    distance = own[:, None, :] - 2 * dots(parts, entries, books.bound)
    code = distance.argmin(-1)
    return code, np.take_along_axis(distance, code[..., None], -1)[..., 0] + (parts * parts).sum(-1)


def _parts(vectors: pa.Array, books: Codebooks) -> np.ndarray:
    """Whole-number parts of vectors that all have the length of the codebooks."""
    n_parts, _, length = books.entries.shape
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * SCALE).astype(np.int64).reshape(len(vectors), n_parts, length)
    return np.ascontiguousarray(whole.transpose(1, 0, 2))


def _sums(books: Codebooks):
    n_parts, n_entries, length = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_parts * n_entries, length + 1), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                parts = _parts(batch.column("vector").slice(at, BLOCK), books)
                code, _ = nearest(parts, books)
                slot = (code + n_entries * np.arange(n_parts)[:, None]).ravel()
                order = np.argsort(slot, kind="stable")
                used, first = np.unique(slot[order], return_index=True)
                rows = np.concatenate([parts.reshape(-1, length), np.ones((len(slot), 1), np.int64)], axis=1)[order]
                total[used] += np.add.reduceat(rows, first, axis=0)
        slot, position = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(position, pa.int32()), pa.array(total[slot, position], pa.int64())],
                                         ["slot", "position", "total"])
    return run


def fit(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the usable vectors; ``None`` where there is none.

    They start as the parts of the vectors with the smallest keys (null keys last, equal keys by their vectors) and
    are moved ``rounds`` times to the means of what is nearest, rounded down; unused entries stay. Vectors of another
    length than the first one, which cannot be cut like it, take no part. Distances that could pass 63 bits raise an error.
    """
    rows = vectors.select(col(vectors, key).alias("key"), col(vectors, vector).cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    start = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
    if not start:
        return None
    length = len(start[0]["vector"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    first = [r["vector"] for r in start if len(r["vector"]) == length]
    rows = rows.where(F.size("vector") == length).select("vector")
    if len(first) < len(start):  # other lengths among the smallest keys: look on among those that fit
        fitting = vectors.select(col(vectors, key).alias("key"), col(vectors, vector).cast("array<double>").alias("vector"))
        found = fitting.where(usable(F.col("vector")) & (F.size("vector") == length)).orderBy(F.col("key").asc_nulls_last(), "vector")
        first = [r["vector"] for r in found.limit(entries).collect()]
    largest = rows.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 0.0
    bound = int(largest * SCALE) + 1
    if 4 * bound * bound * max(length, 1) >= 1 << 63:
        raise ValueError(f"components up to {largest} have squared distances beyond 63 bits")
    whole = np.floor(np.array(first, np.float64).reshape(len(first), length) * SCALE).astype(np.int64)
    books = Codebooks(np.ascontiguousarray(whole.reshape(len(first), parts, -1).transpose(1, 0, 2)), bound)
    shape = books.entries.shape
    for _ in range(rounds):
        # at most one sum per component of the codebooks comes back
        sums = (rows.mapInArrow(_sums(books), "slot int, position int, total long").groupBy("slot", "position")
                .agg(F.sum("total").alias("total")).collect())
        total = np.zeros((shape[0] * shape[1], shape[2] + 1), np.int64)
        for r in sums:
            total[r["slot"], r["position"]] = r["total"]
        count = total[:, -1:]
        moved = np.where(count > 0, total[:, :-1] // np.maximum(count, 1), books.entries.reshape(-1, shape[2]))
        books = Codebooks(moved.reshape(shape), bound)
    return books


def _codes(books: Codebooks, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = books.entries.shape[0] * books.entries.shape[2]
        for batch in batches:
            vectors = batch.column(batch.num_columns - 1)
            n = batch.num_rows
            sizes = np.diff(vectors.offsets.to_numpy()) if n else np.empty(0, np.int64)
            fits = np.flatnonzero(sizes == length)
            codes, errors = [None] * n, [None] * n
            for at in range(0, len(fits), BLOCK):
                some = fits[at:at + BLOCK]
                code, distance = nearest(_parts(vectors.take(pa.array(some)), books), books)
                data, total = code.T.astype(np.uint8), distance.sum(0).tolist()
                for i, row, error in zip(some.tolist(), data, total):
                    codes[i], errors[i] = row.tobytes(), error
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(codes, pa.binary()), pa.array(errors, pa.int64())], names)
    return run


def encode(vectors: DataFrame, books: Codebooks | None, vector: str = "embedding", carry: list[str] | None = None) -> tuple[DataFrame, str, str]:
    """Usable vectors with their code (one byte per part) and squared error; also the names of the two new columns.

    Rows without a usable vector are left out, and so is every row of a table without one. Vectors of another length than the
    codebooks' have a null code and error. Repeated rows are repeated, other columns keep their names and values.
    """
    kept = list(vectors.columns if carry is None else carry)
    code, error = fresh(kept, "code", "error")
    fields = [vectors.schema[c] for c in kept]
    inner = [f"c{i}" for i in range(len(kept))]
    rows = vectors.select(*[col(vectors, c).alias(i) for c, i in zip(kept, inner)], col(vectors, vector).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    schema = StructType([StructField(i, f.dataType) for i, f in zip(inner, fields)]).simpleString()[7:-1]
    if books is None:
        done = rows.where(F.lit(False)).select(*inner, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    else:
        done = rows.mapInArrow(_codes(books, [*inner, "code", "error"]), f"{schema + ', ' if inner else ''}code binary, error long")
    return done.select(*[F.col(i).alias(c) for i, c in zip(inner, kept)], F.col("code").alias(code), F.col("error").alias(error)), code, error


def with_group_error(coded: DataFrame, label: str, error: str, name: str) -> DataFrame:
    """``coded`` with the sum of ``error`` over the rows of equal ``label``, nulls together.

    Sums are made on the map side. Up to ``SMALL`` labels are broadcast after counting; beyond that labels with many rows
    are dealt over several tasks of the join.
    """
    mark, rows, total = fresh(coded.columns, "mark", "rows", "total")
    marked = materialise(coded.withColumn(mark, F.coalesce(F.concat(F.lit("="), col(coded, label).cast("string")), F.lit("null"))), "codes")
    sums = materialise(marked.groupBy(mark).agg(F.sum(error).alias(total), F.count("*").alias(rows)), "label-errors")
    n = sums.agg(F.count("*"), F.sum(rows)).first()
    if n[0] <= SMALL:
        out = marked.join(F.broadcast(sums.drop(rows)), mark, "left")
    else:
        hot = sums.where(F.col(rows) * HOT_SHARE > n[1]).select(mark)
        out = spread_lookup(marked, sums.drop(rows), mark, hot, F.col(error))
    return out.select(*[col(out, c) for c in coded.columns], F.col(total).alias(name))
