"""The Merkle manifest against a plain recursive version."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " \
         "digest string, tree string, path string, held string, lo long"
UP, LOW = merkle._UPPER, merkle._LOWER


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}"
             for v in (r[0], r[3], r[2], r[4], text)]
    return sha(*parts)


def climb(digests):
    """Per leaf the (before, after) of every level, and the root."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for i, node in enumerate(at):
            first = node // 16 * 16
            paths[i].append(("".join(level[first:node]), "".join(level[node + 1:first + 16])))
            at[i] = node // 16
        level = [sha(*level[k:k + 16]) for k in range(0, len(level), 16)]
    return paths, level[0]


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (
            r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[s] = own, *climb([leaf_of(r, r[1]) for r in own])
    upper, root = climb([trees[s][2] for s in sources])
    out = []
    for s, over in zip(sources, upper):
        own, paths, subroot = trees[s]
        for r, path in zip(own, paths):
            path = path + over
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = text.translate(str.maketrans(UP, LOW))
            made = leaf_of(r, text)
            for before, after in path:
                made = sha(before, made, after)
            out.append((r[0], leaf_of(r, r[1]), subroot, root,
                        sha(*[b + a for b, a in path]), made, made == root))
    return sorted(out, key=str)


def rows_of(n, sources):
    rng = random.Random(n)
    words = ["Alpha", "beta", "É", "Ω x", "", "end."]
    out = []
    for i in range(n):
        text = rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 9)))])
        out.append((i, text, rng.choice(["en", None, ""]), sources[i % len(sources)],
                    rng.choice([None, i]), "d", "t", "p", "h", 1))
    return out


def run(spark, rows, parts=5):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.manifest(docs, F.when(hit, F.translate("text", UP, LOW))).drop("source")
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("n, sources", [
    (1, ["a"]), (16, ["a"]), (17, ["a"]), (300, ["a"]), (4200, ["a", "a", "a", "b"]),
    (40, [None, "", "b", "é", "B", "z"]), (60, [f"s{k}" for k in range(37)]),
])
def test_manifest(spark, n, sources):
    rows = rows_of(n, sources)
    assert run(spark, rows) == brute(rows)


def test_repeats_null_ids_and_a_long_text(spark):
    rows = rows_of(30, ["a", None]) + rows_of(3, ["a"]) + \
        [(None, "A", "en", "a", 1, "", "", "", "", 2)] * 2 + \
        [(900, "Word " * 200_000, "en", "a", 1, "", "", "", "", 2)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_changed_text_is_noticed(spark):
    rows = rows_of(50, ["a", "b"])
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(docs, F.when(F.col("doc_id") == 7, F.lit("other"))).collect()
    assert [r.doc_id for r in got if not r.verified] == [7]
    assert all(r.verified for r in merkle.manifest(docs).collect())
