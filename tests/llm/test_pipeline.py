"""The five stages over a small table."""

import collections
import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import mixing, quality, token_output
from ledgerlake.llm.common import Scratch

from .test_operators import brute_targets, words

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, scratch, counts = docs.columns, Scratch(spark, "test-pipeline"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.write(stage(spark, docs, SF), str(k))
        counts.append(docs.count())
        if k < 4:
            assert docs.columns == names
    assert 200 > counts[0] >= counts[1] >= counts[2] > 0 and counts[3] == counts[4]
    first = sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == first


def test_empty_documents_pass_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def brute_kept(rows, trees, bench):
    """The rows that the first three stages keep, without Spark: classified (by the same trees),
    one of each group of near copies, none with a passage of the benchmark."""
    x = np.array([quality.statistics((r.text or "").encode()) for r in rows])
    rows = [r for r, s in zip(rows, trees.score(x)) if s >= quality.THRESHOLD]
    sets = []
    for r in rows:
        w = words(r.text)
        n = min(5, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) \
                    and len(a & b) >= 0.8 * len(a | b):
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    groups = collections.defaultdict(list)
    for r, g in zip(rows, group):
        groups[g].append(r)
    rows = [min(g, key=lambda r: r.doc_id) for g in groups.values()]
    windows = set()
    for t in bench:
        w = words(t)
        n = min(10, len(w))
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1 if n else 0)}
    sizes = {len(x) for x in windows}
    return [r for r in rows if not any(
        tuple(w[k:k + n]) in windows for w in [words(r.text)] for n in sizes
        for k in range(len(w) - n + 1))]


def test_run_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat(
        F.lit("A room of 5 m², x² and km³. "), "text")).otherwise(F.col("text")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = brute_kept(docs.collect(), quality.fit_quality(docs, labels), bench)
    table = spark.createDataFrame(kept, docs.schema)
    # Which words are taken is seeded; how many is not.
    mixed = mixing.materialise(table, mixing.mix(mixing.stored_sizes(table))).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = collections.Counter(), collections.Counter()
    for r in kept:
        sizes[r.source] += size(r.text)
    for r in mixed:
        taken[r.source] += size(r.text)
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= 2 * mixing.BLOCK_TOKENS + 0.02 * t
    tokenizer = Tokenizer.from_file(token_output.default_tokenizer())
    want, start = [], 0
    for r in sorted(mixed, key=lambda r: (r.doc_id, r.text)):
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == want
