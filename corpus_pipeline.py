"""A training corpus from raw documents: classified, deduplicated, decontaminated, mixed and
written as token files. Every stage reads what its predecessor kept; all but the last return
documents with the columns they came with.

Empty tables pass through; repeated rows and rows without an id are handled as each operator's
docstring says."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.common import Scratch, documents
from ledgerlake.llm.decontaminate import find_contamination
from ledgerlake.llm.mixing import materialise, mix, stored_sizes
from ledgerlake.llm.near_dup import one_per_group
from ledgerlake.llm.quality import THRESHOLD, fit_quality, score_quality
from ledgerlake.llm.token_output import token_output


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    trees = fit_quality(docs, documents(spark, sf_dir, "labels"))
    return score_quality(docs, trees, docs.columns).filter(f"score >= {THRESHOLD}").drop("score")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by shared shingles one stays."""
    return one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = find_contamination(docs, documents(spark, sf_dir, "benchmark"), docs.columns)
    return found.filter("NOT contaminated").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a cut document is a row of its taken words."""
    return materialise(docs, mix(stored_sizes(docs)))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, read back: doc_id, start, n_tokens, ids_crc32 of each row."""
    return token_output(docs)


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: The classifier, MinHash and the tokenizer have no SQL form; tests hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
