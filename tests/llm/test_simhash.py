"""SimHash near duplicates against all pairs, one by one."""

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerlake.llm import graph, simhash
from ledgerlake.llm.common import Scratch

SCHEMA = "doc_id bigint, text string, fp string, mask long, key long, component_id long"


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def union_find(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


def pairs_within(fps, radius=2):
    return [(i, j) for i in range(len(fps)) for j in range(i)
            if (fps[i] ^ fps[j]).bit_count() <= radius]


def brute(rows):
    fps = [brute_fingerprint(r[1]) for r in rows]
    distinct = sorted(set(fps))
    root = dict(zip(distinct, union_find(len(distinct), pairs_within(distinct))))
    least = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    return sorted(((r[0], f"{f:016x}", least.get(root[f])) for r, f in zip(rows, fps)), key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)


def texts():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "Ab", "don't", "x y", "\x1fz"]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out = [None, "", " \n\t\x0b\r", "One", "one", "one two", "a b c", "A B c ", "w1 " * 70_000]
    for _ in range(12):
        base = say(rng.randint(200, 500))
        for _ in range(6):
            near = list(base)
            near[rng.randrange(len(near))] = "other"
            out.append("\n".join(near))
        out.append(" ".join(base).upper())
    return out + [" ".join(say(rng.randint(1, 60))) for _ in range(80)]


def test_against_all_pairs(spark):
    rows = list(enumerate(texts())) + [(3, "One"), (None, "one"), (None, "alone with no id")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert len({g[2] for g in got}) < len({g[1] for g in got})


def test_empty_table(spark):
    assert run(spark, []) == []


def test_every_pair_meets_and_buckets_end_small():
    masks = simhash.first_masks()
    assert len(masks) == 6
    for _ in range(3):
        masks = [m for x in masks for m in simhash.finer_masks(x)]
    assert max(map(simhash.free_bits, masks)) <= 10
    assert 2 ** 10 == simhash.BLOCK
    masks, rng = set(masks), random.Random(1)
    for _ in range(300):
        bits = rng.sample(range(64), 2)
        differ = sum(1 << b for b in bits)
        assert any(differ & m == 0 for m in masks)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 12, np.uint64)
    fps = []
    for k in range(400):
        flips = rng.choice(64, rng.integers(0, 6), replace=False)
        fps.append(int(base[k % 12]) ^ sum(1 << int(b) for b in flips))
    sizes = [1, 1, 2, 63, 64, 65, 100, 104]
    first = np.repeat(np.cumsum([0] + sizes[:-1]), sizes)
    fps = np.array(fps, np.uint64)
    got = set(zip(*(x.tolist() for x in simhash.links(fps, first, radius))))
    want = {(i, j) for i, j in pairs_within([int(f) for f in fps], radius) if first[i] <= j}
    assert got == want and want


def test_large_buckets_are_dealt_again(spark, monkeypatch):
    """A dense cluster: all fingerprints that differ from one in a few low bits."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    cluster = {centre ^ sum(1 << b for b in rng.sample(range(40), rng.randint(0, 5)))
               for _ in range(1500)}
    fps = sorted(cluster | {rng.getrandbits(64) for _ in range(200)})
    monkeypatch.setattr(simhash, "BLOCK", 1 << 10)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    scratch = Scratch(spark, "test")
    edges = simhash.near_edges(classes, scratch)
    assert edges.filter("a = b").count() == 0
    nodes = graph.star_components(edges, scratch, "stars").collect()
    number = {f: k for k, f in enumerate(signed)}
    got = union_find(len(fps), [(number[r.node], number[r.root]) for r in nodes])
    assert got == union_find(len(fps), pairs_within(fps))


def test_components_of_a_long_chain(spark):
    scratch = Scratch(spark, "test")
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)],
                                  "a bigint, b bigint")
    got = {r.node: r.root for r in graph.star_components(edges, scratch, "chain").collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert graph.star_components(none, scratch, "none").count() == 0
