"""Helpers that several training-data operators share."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlake.session import shared_path

#: Rows in one Arrow batch. Long texts make wide rows, so batches are kept short.
ARROW_ROWS = 500


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough that a batch of very long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


class Scratch:
    """Written tables under the cluster's shared folder: they cut lineage, are read by every
    executor and survive lost ones. ``drop`` removes a table that nothing reads any more."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = shared_path(spark, f"ledgerlake-{what}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text of an Arrow column; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def mix64(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Word bytes after lower-casing A-Z: digits, a-z and every byte of a non-ASCII character.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


class WordHasher:
    """64-bit hashes of the words of texts, by prefix sums of a polynomial over all bytes.

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. Two
    different words share a hash with a chance of about 2**-64 a pair."""

    def __init__(self):
        self._up = self._down = np.ones(1, np.uint64)

    def spans(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, start and end of each word."""
        data = np.frombuffer(text.lower(), np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = _WORD[data]
        edge = np.diff(inside)
        return data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def __call__(self, text: bytes) -> np.ndarray:
        data, start, end = self.spans(text)
        if len(self._up) <= len(data):
            size = max(1 << 16, 2 * len(data))
            self._up, self._down = _powers(_BASE, size), _powers(_INVERSE, size)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[:len(data)], out=total[1:])
        h = (total[end] - total[start]) * self._down[start]
        return mix64(h + (end - start).astype(np.uint64))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of n consecutive words, sorted; a shorter text has one shingle of all
    its words, an empty one has none."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = mix64(h * np.uint64(31) + words[k:len(words) - n + 1 + k])
    return np.unique(h)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that clashing extra columns never reach an operator."""
    return df.select(*[F.col(f"`{n}`") for n in names])
