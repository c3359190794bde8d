"""Helpers the corpus operators share: words, hashes of words and spans, session settings."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import public_tokenizers
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_MIX_1, _MIX_2, _STEP = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_BASE = U64(0x2545F4914F6CDD1D)
_BASE_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
# Distinct words a task remembers before it starts afresh; a memory bound, not a limit on input.
REMEMBERED_WORDS = 100_000
PACKAGE_FOLDER = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# A folder of vocabulary files to use in place of the installed ones.
TOKENIZERS = os.environ.get("CORPUS_TOKENIZERS")


def arrow_batches(spark: SparkSession, rows: int = 250) -> SparkSession:
    """Hand texts to Python in batches of `rows`, so a batch of long texts fits a worker's memory.

    Workers also get this package's folder on their path, for runs that were not given it at the start.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_FOLDER)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def package_on_workers(spark: SparkSession) -> SparkSession:
    """Let workers import this package, for runs that were not given its folder at the start."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_FOLDER)
    return spark


def per_text(df: DataFrame, column: str, keep: tuple[str, ...], schema: str, start: Callable[[], Callable]) -> DataFrame:
    """`keep` columns of every row and the fields of `schema`, which a function of `column` gives.

    `start()` runs once in each task and returns that function. The other columns never leave the JVM.
    """
    arrow_batches(df.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = start()
        for batch in batches:
            yield pd.DataFrame([of(x) for x in batch], columns=names)

    return df.select(*keep, run(df[column]).alias("_result")).select(*keep, "_result.*")


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand `rows` rows at a time to Python in what is executed inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, "10000")
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file."""
    return os.path.join(TOKENIZERS, name) if TOKENIZERS else public_tokenizers.path(name)


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash, remembered within a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads sums and products over all 64 bits."""
    x = (x ^ (x >> U64(30))) * _MIX_1
    x = (x ^ (x >> U64(27))) * _MIX_2
    return x ^ (x >> U64(31))


def _times_step(n: int) -> np.uint64:
    return U64(n * int(_STEP) & (1 << 64) - 1)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the distinct `size`-word shingles; shorter texts are one shingle, empty ones none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    total = np.full(n - width + 1, _times_step(width), U64)
    for i in range(width):
        total += mix(hashes[i : n - width + 1 + i] + _times_step(i + 1)) * (_times_step(2 * i + 3) | U64(1))
    return np.unique(mix(total))


class SpanHashes:
    """Hash of any span of a word sequence in constant time, from prefix sums modulo 2**64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        powers = np.ones(n + 1, U64)
        powers[1:] = _BASE
        self._back = np.ones(n + 1, U64)
        self._back[1:] = _BASE_INVERSE
        powers, self._back = np.cumprod(powers), np.cumprod(self._back)
        self._sums = np.zeros(n + 1, U64)
        np.cumsum(mix(hashes) * powers[:n], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(U64) * _STEP)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2. Rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
