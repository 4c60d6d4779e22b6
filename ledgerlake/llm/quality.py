"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

The trees are fitted on at most ``MAX_TRAINING_ROWS`` labelled rows (the ones of lowest hash of
the id, so reruns agree) outside the held-out fold. Every whole text is then scored where it is
read: statistics and tree traversal are numpy over Arrow batches, without a shuffle.

Defined cases: null and empty texts have zero statistics and a score like any other; labels that
are null, repeat or name no document are ignored (of repeated ones the larger counts); without
both labels the score is the base rate; a null doc_id is never held out; extra columns pass by.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import gbdt
from .common import bounded_batches, columns, documents, raw_texts

MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.3
_LOWER, _UPPER, _DIGIT, _SPACE, _PUNCT, _HIGH = range(6)
_KIND = np.full(256, _PUNCT, np.int64)
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A], _KIND[0x80:] = _LOWER, _UPPER, _DIGIT, _HIGH
_KIND[[0x20, *range(9, 14)]] = _SPACE
N_FEATURES = 20


def statistics(text: bytes) -> list[float]:
    """The statistics of one text that the trees see."""
    data = np.frombuffer(text, np.uint8)
    n = max(1, len(data))
    count = np.bincount(data, minlength=256)
    kinds = np.bincount(_KIND, count, 6)
    words, lines = text.split(), text.split(b"\n")
    n_words, n_lines = max(1, len(words)), len(lines)
    punct = count[_KIND == _PUNCT]
    share = punct / max(1, punct.sum())
    marks = count[[ord(c) for c in "!|.,#$"]] / n_words
    ends = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines)
    return [np.log1p(len(data)), np.log1p(n_words), n / n_words, *(kinds / n),
            *marks, (share * share).sum(), len(set(words)) / n_words,
            len(set(lines)) / n_lines, n_words / n_lines, ends / n_lines]


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(labels: DataFrame, label: str, limit: int = MAX_TRAINING_ROWS) -> DataFrame:
    """(doc_id, label): at most ``limit`` labelled rows outside the held-out fold."""
    return columns(labels, "doc_id", label).dropna().filter(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(label).cast("double").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality",
                limit: int = MAX_TRAINING_ROWS) -> gbdt.Trees:
    """Trees fitted on a bounded sample; its statistics (not its texts) reach the driver."""
    def measure(batches):
        for b in batches:
            x = np.array([statistics(t) for t in raw_texts(b.column(0))]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([pa.array(list(x)), b.column(1)], ["x", "label"])
    bounded_batches(docs.sparkSession)
    sample = F.broadcast(training_rows(labels, label, limit))  # ``limit`` rows of two numbers
    rows = columns(docs, "doc_id", "text").join(sample, "doc_id").select("text", "label") \
        .mapInArrow(measure, "x array<double>, label double").collect()
    return gbdt.fit(np.array([r.x for r in rows]).reshape(-1, N_FEATURES),
                    np.array([r.label for r in rows]))


def score_quality(docs: DataFrame, trees: gbdt.Trees, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs`` and the score of each row's text."""
    def score(batches):
        for b in batches:
            x = np.array([statistics(t) for t in raw_texts(b.column(0))]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(trees.score(x))],
                                             [*carry, "score"])
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("text").alias("_text"), *[F.col(f"`{c}`") for c in carry])
    schema = docs.select(*[F.col(f"`{c}`") for c in carry]).schema
    return rows.mapInArrow(score, schema.add("score", "double"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    trees = fit_quality(docs, documents(spark, sf_dir, "labels"))
    return score_quality(docs, trees, ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def in_held_out_fold(doc_id: int) -> bool:
    """The rule of ``held_out`` for one id, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
