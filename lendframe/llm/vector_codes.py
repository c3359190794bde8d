"""Product codes of vectors from exact integer products.

Method: limb-split exact GEMM. A squared distance is |x|^2 - 2 x.c + |c|^2. The integers of x and c are broken into
limbs so small that a float64 BLAS product of two limb matrices stays below 2**53 and is exact; the products of all
limb pairs are recombined in int64, and the first smallest distance wins. Where int64 cannot hold a
distance, the same products are recombined as Python integers.

Vectors stay in their partitions. A round reads them once; a task hands over one sum per codebook entry and
component, so what is shuffled and what the driver holds is a number of values fixed by codebook and vector length.

Rows: one per vector that is not null and holds neither null nor non-finite components. Components lie within
+-2**48 (beyond: that bound). Errors beyond a long are its largest value. Shorter vectors count as if zeros followed,
up to the longest length, rounded up to a multiple of the parts. Starters are the smallest distinct ids (of a repeated
id the smallest vector, null ids last); fewer vectors than entries give fewer entries. Repeated rows each count. Of equal
distances the lower index wins. Empty tables give no rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendframe.llm.common import package_on_workers
from lendframe.operators.lookup import attach
from lendframe.session import LOOKUP_ROWS, materialise

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CHUNK_VALUES = 1 << 20  # components handled at a time; bounds a task's memory, not its input
_LARGEST = float(1 << 48)
_EXACT_BITS = 53
_LONG = (1 << 63) - 1
_HALF = 32  # sums are handed over as high and low halves, so that adding them up never overflows


def usable(vector: Column) -> Column:
    return vector.isNotNull() & ~F.coalesce(
        F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)
    )


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite doubles, within +-2**48."""
    with np.errstate(over="ignore"):
        return np.floor(np.clip(values * float(SCALE), -_LARGEST, _LARGEST)).astype(np.int64)


def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float matrices l with x = sum of l[i] * 2**(bits * i); all but the last lie in [0, 2**bits)."""
    out = []
    while True:
        if not len(x.ravel()) or max(int(x.max()), -int(x.min())) < 1 << bits:
            return [*out, x.astype(float)]
        out.append((x & ((1 << bits) - 1)).astype(float))
        x = x >> bits


def dots(x: np.ndarray, c: np.ndarray, wide: bool) -> np.ndarray:
    """x @ c.T, exact; int64, or Python integers where `wide`."""
    bits = (_EXACT_BITS - max(1, math.ceil(math.log2(max(2, x.shape[1]))))) // 2
    total = np.zeros((len(x), len(c)), object if wide else np.int64)
    for i, a in enumerate(_limbs(x, bits)):
        for j, b in enumerate(_limbs(c, bits)):
            product = (a @ b.T).astype(np.int64)
            total += (product.astype(object) if wide else product) * (1 << bits * (i + j))
    return total


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest row of c, squared distance to it) for every row of x."""
    reach = int(np.abs(x).max(initial=0)) + int(np.abs(c).max(initial=0))
    wide = x.shape[1] * reach * reach > _LONG
    exact = lambda m: m.astype(object) if wide else m
    own, other = (exact(x) ** 2).sum(axis=1), (exact(c) ** 2).sum(axis=1)
    away = own[:, None] - 2 * dots(x, c, wide) + other[None, :]
    at = np.argmin(away, axis=1)
    return at, away[np.arange(len(x)), at]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the Arrow batches with their vectors as an integer matrix of `width` columns."""
    step = max(1, CHUNK_VALUES // max(1, width))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            lists = part.column(part.schema.get_field_index("_vector"))
            flat = integers(lists.flatten().to_numpy(zero_copy_only=False).astype(float))
            lengths = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            x = np.zeros((part.num_rows, width), np.int64)
            x[np.arange(width)[None, :] < lengths[:, None]] = flat
            yield part, x


def _sums(vectors: DataFrame, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums as Python integers by part, entry, component; rows by part, entry) of the vectors nearest to each entry."""
    parts, entries, own = codebooks.shape
    width = parts * own
    sent = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        high = np.zeros((parts, entries, own), np.int64)
        low, rows = np.zeros_like(high), np.zeros((parts, entries), np.int64)
        for _, x in _blocks(batches, width):
            for p in range(parts):
                mine = x[:, p * own : (p + 1) * own]
                at, _ = nearest(mine, books[p])
                order = np.argsort(at, kind="stable")
                counts = np.bincount(at, minlength=entries)
                rows[p] += counts
                starts = np.cumsum(counts) - counts
                full = np.flatnonzero(counts)
                # A block's components stay below 2**48 * 2**20, so halves are added apart.
                split = mine[order]
                high[p, full] += np.add.reduceat(split >> _HALF, starts[full], axis=0)
                low[p, full] += np.add.reduceat(split & ((1 << _HALF) - 1), starts[full], axis=0)
        p, e, k = np.indices(high.shape).reshape(3, -1)
        columns = [p, e, k, high.ravel(), low.ravel(), np.repeat(rows.ravel(), own)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["p", "e", "k", "h", "l", "n"])

    found = vectors.select("_vector").mapInArrow(run, "p long, e long, k long, h long, l long, n long")
    # As many rows as the codebooks have components.
    total = found.groupBy("p", "e", "k").agg(F.sum("h").alias("h"), F.sum("l").alias("l"), F.sum("n").alias("n"))
    sums, counts = np.zeros(codebooks.shape, object), np.zeros((parts, entries), object)
    for r in total.collect():
        sums[r.p, r.e, r.k] = (r.h << _HALF) + r.l
        counts[r.p, r.e] = r.n
    return sums, counts


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks by part, entry and component, after `rounds` of assigning and replacing; None without vectors."""
    longest = vectors.agg(F.max(F.size("_vector"))).first()[0]
    if longest is None:
        return None
    own = -(-longest // parts)
    once = vectors.groupBy("_id").agg(F.min("_vector").alias("_vector"))
    first = once.orderBy(F.col("_id").asc_nulls_last()).limit(entries).collect()
    start = np.zeros((len(first), parts * own), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r._vector)] = integers(np.array(r._vector, float))
    codebooks = np.ascontiguousarray(start.reshape(len(first), parts, own).transpose(1, 0, 2))
    for _ in range(rounds):
        sums, counts = _sums(vectors, codebooks)
        for p, e in np.argwhere(counts > 0):
            codebooks[p, e] = [s // counts[p, e] for s in sums[p, e]]
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """_id, _label, code and error of every vector."""
    parts, _, own = codebooks.shape
    sent = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch, x in _blocks(batches, parts * own):
            at, away = zip(*(nearest(x[:, p * own : (p + 1) * own], books[p]) for p in range(parts)))
            codes = ["".join(f"{i:02x}" for i in row) for row in np.stack(at, axis=1).tolist()]
            error = [min(_LONG, sum(row)) for row in zip(*(a.tolist() for a in away))]
            fields = [batch.column(batch.schema.get_field_index(c)) for c in ("_id", "_label")]
            arrays = [*fields, pa.array(codes, pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["_id", "_label", "code", "error"])

    kinds = dict(vectors.dtypes)
    return vectors.mapInArrow(run, f"_id {kinds['_id']}, _label {kinds['_label']}, code string, error long")


def compress(
    table: DataFrame, vector: str = "embedding", id_column: str = "vec_id", label: str = "label"
) -> DataFrame:
    """id, code, error, label_error and codebooks_sha256 of every usable vector of `table`."""
    package_on_workers(table.sparkSession)
    named = table.select(F.col(id_column).alias("_id"), F.col(label).alias("_label"), F.col(vector).alias("_vector"))
    vectors = named.where(usable(F.col("_vector")))
    codebooks = fit(vectors)
    if codebooks is None:
        codebooks, sha = np.zeros((PARTS, 1, 1), np.int64), None
    else:
        sha = digest(codebooks)
    coded = materialise(encode(vectors, codebooks), "codes")
    # Equal labels, null among them, by one key that is never null.
    key = F.when(F.col("_label").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("_label").cast("string")))
    keyed = coded.withColumn("_key", key)
    summed = keyed.groupBy("_key").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    capped = F.least("_sum", F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    by_label = materialise(summed.select("_key", capped.alias("label_error")), "label-errors")
    small = by_label.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    return attach(keyed, by_label, "_key", small).select(
        F.col("_id").alias(id_column), "code", "error", "label_error", F.lit(sha).cast("string").alias("codebooks_sha256")
    )
