"""Every training-data operator against a brute-force version, on hostile small tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import (
    decontaminate, exact_dedup, gbdt, licenses, mixing, near_dup, quality, suffix_dedup,
    token_counts, token_output, toxicity,
)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " \
         "digest string, shard string, size string"


def words(text):
    return WORD.findall((text or "").encode().lower())


def texts():
    rng = random.Random(4)
    vocabulary = ["alpha", "beta", "gamma", "delta", "Éa", "x1", "it's", "end."] + \
        [f"w{k}" for k in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = say(120)
    near = base.split()
    near[7] = "other"
    shared = say(30)
    return [None, "", "", " \n ", "Alpha", "alpha", base, base.upper(), base, " ".join(near),
            "a" * 450, "ab" * 300, shared + " " + say(60), say(40) + "\n" + shared,
            say(9), say(6000), "don't stop! <|endoftext|> é Σ"] + \
        [say(rng.randint(1, 90)) for _ in range(25)]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en", ["a", "b", None, "a"][i % 4], len(t or ""), "d", "s", "z")
           for i, t in enumerate(texts())]
    return out + [(6, texts()[6], "en", None, 1, "d", "s", "z"), (None, "alpha beta", "en", "a", 1, "", "", "")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, rows, none):
    got = exact_dedup.exact_duplicates(docs, F.col("doc_id") <= 10, shard_digests=5).collect()
    assert len(got) == len(rows)
    key = lambda t: (t or "").encode().lower()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[hashlib.sha256(key(r[1])).hexdigest()].append(r[0])
    assert sum(r.kept or False for r in got if r.doc_id is not None) == \
        sum(any(i is not None for i in g) for g in groups.values())
    for r in got:
        g = groups[r.text_sha256]
        assert r.group_size == len(g)
        assert r.keep_id == max((i for i in g if i is not None), default=None)
    assert exact_dedup.exact_duplicates(none, F.col("doc_id") <= 10).count() == 0


def test_new_digests_have_shards_without_history(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i // 2}") for i in range(120)],
                                 "doc_id bigint, text string")
    shards, resolve = [], exact_dedup.resolve
    monkeypatch.setattr(exact_dedup, "resolve",
                        lambda new, index, n: shards.append(n) or resolve(new, index, n))
    for history in (F.lit(False), F.col("doc_id") <= 0, F.lit(True)):
        got = exact_dedup.exact_duplicates(docs, history, shard_digests=5).collect()
        assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {
            (i, i | 1, 2, i % 2 == 1) for i in range(120)}
    assert min(shards) >= 60 // 5


def test_perfect_hash_is_minimal_and_rejects_strangers():
    digests = np.frombuffer(b"".join(hashlib.sha256(bytes([a, b])).digest()
                                     for a in range(40) for b in range(40)), np.uint8).reshape(-1, 32)
    sizes, bits = exact_dedup.build_mph(digests[:1000])
    assert sorted(exact_dedup.slots_of(digests[:1000], sizes, bits)) == list(range(1000))
    assert exact_dedup.slots_of(digests[1000:], sizes, bits).max() < 1000
    assert exact_dedup.build_mph(digests[:0]) [0] == []


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    left, target, open_ = float(sum(sizes.values())), {}, set(names)
    while open_:
        share = {s: left * w[s] / sum(w[t] for t in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target | share
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


def test_mixing(docs, rows, none):
    got = mixing.mix(mixing.stored_sizes(docs)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        assert r.taken <= 3 * r.size and abs(r.target - want[r.source]) < 1e-6
        assert r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * mixing.BLOCK_TOKENS + 0.02 * t
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(mixing.stored_sizes(docs)).collect()))
    unique = docs.dropDuplicates(["doc_id"])
    mixed = mixing.mix(mixing.stored_sizes(unique))
    made = mixing.materialise(unique, mixed)
    assert made.columns == docs.columns
    assert sum(size(r.text) for r in made.collect()) == mixed.agg(F.sum("taken")).first()[0]
    assert mixing.mix(mixing.stored_sizes(none)).count() == 0


def test_tiny_sources_reach_their_targets(spark):
    rng = random.Random(6)
    sizes = {f"s{k:03}": rng.choice([1, 2, 5, 7, 25, 40, 130]) for k in range(90)} | \
        {"large": 9000, "large2": 4000, "none": 0}
    docs = spark.createDataFrame(
        [(k, " ".join(["w"] * n), s) for k, (s, n) in enumerate(sizes.items())],
        "doc_id bigint, text string, source string")
    want, taken = brute_targets(sizes), collections.Counter()
    for r in mixing.mix(mixing.stored_sizes(docs)).collect():
        assert r.taken <= 3 * r.size and abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= (1 if sizes[s] < 256 else mixing.BLOCK_TOKENS), s


def test_sainte_lague_equals_seat_by_seat(spark):
    rng = random.Random(1)
    for seats in (0, 1, 7, 100):
        votes = {f"p{k}": float(rng.choice([0, 1, 3, 3, 50, 700])) for k in range(9)} | {"q": 5.0}
        won = collections.Counter()
        for _ in range(seats):
            won[min(votes, key=lambda p: (-votes[p] / (2 * won[p] + 1), p))] += 1
        df = spark.createDataFrame([("g", p, v) for p, v in votes.items()], "g string, p string, v double")
        got = mixing.sainte_lague(df, ["g"], ["p"], "v", F.lit(seats)).collect()
        assert {r.p: r.quota for r in got} == {p: won[p] for p in votes}


def test_token_counts(spark, docs, rows, none):
    count = token_counts.default_counter()
    trees = token_counts.count_trees(docs)
    got = {(r.doc_id, r.text_id): r.n_tokens for r in trees.collect()}
    for r in rows:
        assert got[r[0], hashlib.md5((r[1] or "").encode()).hexdigest()] == count(r[1] or "")
    rng = random.Random(3)
    for _ in range(150):
        t = "".join(rng.choice(["ab", "don't", "  ", "\n", " ", "é", "'s", ". ", "12", "!!\n\n"])
                    for _ in range(rng.randint(0, 60)))
        lengths, at, counts = token_counts.cut_leaves(t, 4), 0, []
        for n in lengths:
            counts.append(count(t[at:at + n]))
            at += n
        cuts = sorted(rng.sample(range(len(t) + 1), min(4, len(t) + 1)))
        edits = [(cuts[k], cuts[k + 1], rng.choice(["", "  ", "Q'", "x y"]))
                 for k in range(0, len(cuts) - 1, 2)]
        after, _, _ = token_counts.edit(t, lengths, token_counts.build_tree(counts), edits, count)
        for a, z, new in reversed(edits):
            t = t[:a] + new + t[z:]
        assert after[1] == count(t)
    assert token_counts.count_trees(none).count() == 0


def test_edits_of_a_table_equal_counting_again(spark):
    rows = [(1, "mail a.b@c.org or 10.0.0.1 now"), (1, "other text"), (None, "call +1 (555) 123-4567"),
            (2, None), (3, ""), (4, "ip 1.2.3.4"), (4, "ip 1.2.3.4"), (5, "plain " * 300 + "x@y.zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    trees, count = token_counts.count_trees(docs), token_counts.default_counter()
    got = token_counts.apply_edits(token_counts.with_matches(docs), trees,
                                   token_counts.redactions(docs)).collect()
    want = set()
    for i, t in rows:
        new = t or ""
        for name, pattern in token_counts.REDACTIONS.items():
            new = re.sub(pattern, name, new)
        if new != (t or ""):
            want.add((i, count(new)))
    assert {(r.doc_id, r.n_tokens) for r in got} == want and len(got) == len(want)


def brute_links(rows, threshold=0.8):
    sets = []
    for r in rows:
        w = words(r[1])
        n = min(5, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set())
    out = []
    for a in sets:
        out.append([j for j, b in enumerate(sets)
                    if a == b or a & b and len(a & b) >= threshold * len(a | b)])
    return out


def test_ngram_join(spark, docs, rows, none):
    linked = brute_links(rows)
    group = list(range(len(rows)))
    for _ in rows:
        group = [min(group[j] for j in linked[k]) for k in range(len(rows))]
    classes = collections.defaultdict(list)
    for k, g in enumerate(group):
        classes[g].append(rows[k][0])
    want = sorted((str(rows[k][0]), str(min((i for i in classes[g] if i is not None), default=None)),
                   len(linked[k]) - 1) for k, g in enumerate(group))
    got = near_dup.similarity_join(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == want
    kept = near_dup.one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == len(classes)
    assert near_dup.similarity_join(none).count() == 0


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.9999):
        b = near_dup.bands_for(0.8, recall, 5)
        assert 1 - (1 - 0.8 ** 5) ** b >= recall > 1 - (1 - 0.8 ** 5) ** (b - 1)


def test_blocks_across_tasks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(30):
        t = list(base)
        t[i * 6] = f"x{i}"
        rows.append((i, " ".join(t)))
    got = near_dup.similarity_join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 29)}


def test_licenses(spark, none):
    rows = [(1, None), (2, ""), (3, "Intro. Released under the MIT License.\nMore"),
            (4, "you may not use this file except in compliance with the License. "
                "Licensed under the Apache License, Version 2.0. All rights reserved!"),
            (5, "This program is distributed in the hope that it will be useful, but WITHOUT any warranty."),
            (6, "released under the mit licensed")]
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in licenses.scan_licenses(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: ("", ""), 2: ("", ""), 3: ("M1", "MIT"), 4: ("A2,A1,R1", "Apache-2.0,proprietary"),
                   5: ("G3", ""), 6: ("", "")}
    assert licenses.scan_licenses(none).count() == 0


MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE FOR ANY DIRECT DAMAGES.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def test_standard_license_notices(spark):
    gpl2 = GPL.replace("software:", "software;").replace("version 3", "version 2")
    want = {MIT: ("M2,M4,M3,M5", "MIT"), BSD: ("B1,B2,B3,B4,B5", "BSD"),
            GPL: ("G2,G3,G5,G6", "GPL-3.0"), gpl2: ("G4,G3,G5,G6", "GPL-2.0"),
            APACHE: ("A1,A2,A3,A4,A5", "Apache-2.0"),
            APACHE[APACHE.index("you may not"):]: ("A2,A3,A4,A5", "Apache-2.0"),
            MIT[MIT.index("The above"):]: ("M4,M3,M5", "MIT"),
            # cut off or another text: no notice
            "Permission is hereby granted, free of charge, to any person obtaining a copy\n"
            "of this software and associated documentation files\nand more": ("", ""),
            "All rights\nreserved for others": ("", "")}
    unwrapped = lambda t: "\n".join(" ".join(p.split()) for p in t.split("\n\n"))
    comment = lambda t: "\n".join(f" * {line}" for line in t.split("\n"))
    rows = [(make(t), *w) for t, w in want.items()
            for make in (str, comment, lambda t: t.replace("\n", "\r\n"))]
    rows += [(unwrapped(t), *w) for t, w in want.items() if w[0]]
    docs = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "doc_id bigint, text string")
    got = {r.doc_id: (r.sentence_ids, r.licenses) for r in licenses.scan_licenses(docs).collect()}
    assert got == {k: r[1:] for k, r in enumerate(rows)}


def test_trees_learn_a_rule_and_score_flat():
    rng = np.random.default_rng(0)
    x = rng.random((800, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = gbdt.fit(x[:600], y[:600])
    assert ((trees.score(x[600:]) > 0.5) == y[600:]).mean() > 0.95
    assert gbdt.fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]


def test_trees_see_the_share_of_ended_lines():
    seen = quality.statistics(b"One ends.\ntwo does not\nthree\nfour does! ")
    assert len(seen) == quality.N_FEATURES and seen[-1] == 0.5
    assert len(quality.statistics(b"")) == quality.N_FEATURES


def test_classifiers_on_held_out_rows(spark):
    import duckdb
    sf = "/root/testdata/sf0.01"
    truth = {r[0]: r[1:] for r in duckdb.sql(f"select doc_id, quality, toxic from '{sf}/labels.parquet'").fetchall()}
    for query, k, least in ((quality.op5_quality, 0, 0.95), (toxicity.op6_toxicity, 1, 0.93)):
        got = query(spark, sf).collect()
        held = [r for r in got if r.held_out and r.doc_id in truth]
        assert all(r.held_out == quality.in_held_out_fold(r.doc_id) for r in got)
        assert all(0 <= r.score <= 1 for r in got) and len(got) == 1000
        assert np.mean([r.predicted == truth[r.doc_id][k] for r in held]) >= least


def test_classifiers_without_labels(spark, docs, rows, none):
    labels = spark.createDataFrame([(1, None, None)], "doc_id bigint, quality int, toxic int")
    trees = quality.fit_quality(docs, labels)
    assert quality.score_quality(docs, trees, ["doc_id"]).count() == len(rows)
    assert quality.score_quality(none, trees, none.columns).count() == 0
    assert toxicity.score_toxicity(docs, *toxicity.fit_toxicity(docs, labels)).count() == len(rows)


def test_levenshtein_automaton_equals_distance():
    lexicon = toxicity.Lexicon({"pathetic": 3.0, "clown": 2.0, "scum": 1.0})

    def distance(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a):
            e = [i + 1]
            for j, y in enumerate(b):
                e.append(min(d[j] + (x != y), d[j + 1] + 1, e[j] + 1))
            d = e
        return d[-1]
    rng = random.Random(2)
    for _ in range(2000):
        w = list(rng.choice(["pathetic", "clown", "scum"]))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(w))
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "pé"])
            w = w or ["x"]
        w = "".join(w)
        near = [t for t in ("pathetic", "clown", "scum") if w == t or len(t) >= 5 and distance(w, t) <= 1]
        assert (lexicon.find(w.encode()) is not None) == bool(near), w


def test_quotation_counts_apart():
    lexicon = toxicity.Lexicon({"clown": 5.0})
    open_, quoted = (toxicity.features(t, lexicon) for t in
                     (b"you are a clown today", b'a line with "some clown here" in it'))
    assert open_[2] == 1 and open_[6] == 0 and quoted[2] == 0 and quoted[6] == 1


def test_decontamination(spark, docs, rows, none):
    bench = [(1, " ".join((rows[12][1] or "").split()[:20])), (2, rows[14][1]), (3, None), (4, ""),
             (None, "alpha"), (6, "never seen words"), (6, rows[15][1][:900])]
    windows = collections.defaultdict(set)
    for i, t in bench:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add("" if i is None else str(i))
    want = []
    for r in rows:
        w, items = words(r[1]), set()
        hit = [False] * len(w)
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    items |= windows[tuple(w[k:k + n])]
                    hit[k:k + n] = [True] * n
        want.append((str(r[0]), len(w), sum(hit), len(items),
                     hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), any(hit)))
    table = spark.createDataFrame(bench, "item_id bigint, text string")
    for block_words in (1 << 20, 1000):  # one block, and several
        got = decontaminate.find_contamination(docs, table, ["doc_id"], block_words).collect()
        assert sorted((str(r[0]), *r[1:6]) for r in got) == sorted(want)
    assert not any(r.contaminated for r in decontaminate.find_contamination(
        docs, table.limit(0), ["doc_id"]).collect())
    assert decontaminate.find_contamination(none, table, none.columns).count() == 0


def test_few_python_workers(spark, docs, rows, tmp_path):
    """A worker stays, with its memory, for each Python step that a task runs at once, and for
    each kind of Python that any task needs."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    table = spark.createDataFrame([(1, rows[14][1])], "item_id bigint, text string")
    found = decontaminate.find_contamination(docs, table, ["doc_id"])
    assert plan(found).count("MapInArrow") == 1
    assert sum(r.contaminated for r in found.collect()) > 0
    files = token_output.write_corpus(docs, str(tmp_path / "out"), token_output.default_tokenizer)
    assert "ExistingRDD" not in plan(files)
    written = files.collect()
    assert [f.base for f in written] == [sum(f.n_ids for f in written[:k])
                                         for k in range(len(written))]
    assert sum(f.n_docs for f in written) == len(rows)


def test_longest_matches():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 300)
    items = np.concatenate([text[20:60], rng.integers(0, 3, 40)])
    start, end = np.arange(80), np.repeat([40, 80], 40)
    sa = decontaminate.suffix_array(text, 300)
    assert [text[i:].tolist() for i in sa] == sorted(text[i:].tolist() for i in range(300))
    longest, lo, hi = decontaminate.search(sa, text, items, start, end, np.full(80, 5))
    for k in range(80):
        s = items[k:end[k]].tolist()
        best = max(n for n in range(len(s) + 1)
                   if any(text[i:i + n].tolist() == s[:n] for i in range(300)))
        assert longest[k] == best
        found = sorted(sa[lo[k]:hi[k]].tolist())
        assert found == [i for i in range(296) if len(s) >= 5 and text[i:i + 5].tolist() == s[:5]]


def test_token_files(docs, rows, none, tmp_path):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_output.default_tokenizer())
    want, start = [], 0
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    files = token_output.write_corpus(docs, str(tmp_path / "out"), token_output.default_tokenizer, 64)
    got = sorted(map(tuple, token_output.read_corpus(files).collect()), key=lambda r: r[1])
    assert got == want
    ids, mask = token_output.sequence(token_output.open_sequences(files.first().url), 0)
    assert len(ids) == len(mask) == 64
    assert token_output.token_output(none).count() == 0


def test_pieces_equal_whole_texts():
    encoder = token_output.PieceEncoder(token_output.default_tokenizer(), 4000)
    whole = lambda t: encoder.tokenizer.encode(t, add_special_tokens=False).ids
    for text in ("5 m² of x² and km³", "①step ½cup Ⅳth", "a\U000105E4b x\uA7CDy"):
        assert encoder(text).tolist() == whole(text), text
    for c in [*range(0x80, 0x3000), *range(0xA000, 0xAC00), *range(0xF900, 0x20000, 5)]:
        text = f"a{chr(c)}b 5{chr(c)} {chr(c)}'s"
        assert encoder(text).tolist() == whole(text), hex(c)


def test_encoding_holds_little_beside_the_ids():
    import tracemalloc
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 2000, 6000)) for _ in range(200)]  # 6 MB
    encoder = token_output.PieceEncoder(token_output.default_tokenizer())
    encoder.encode(texts[:20])
    tracemalloc.start()
    try:
        encoder.encode(texts)
        assert tracemalloc.get_traced_memory()[1] < 20e6
    finally:
        tracemalloc.stop()


def test_suffix_dedup(docs, rows, none):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, want = {}, []
    for r in order:
        t = (r[1] or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - 99):
            first = seen.setdefault(t[p:p + 100], (r[0], p))
            if first != (r[0], p):
                gone[p:p + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(t, gone) if not g)
        want.append((str(r[0]), len(t), sum(gone), sum(map(bool, bytes(gone).split(b"\0"))),
                     hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.remove_repeats(docs).drop("kept").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_rows_of_one_id_lose_only_their_own_repeats(spark):
    rng = random.Random(8)
    say = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n)).decode()
    passage, other, far = say(150), say(300), (1 << 60) + 1
    rows = [(0, passage), (1, passage), (1, other), (None, say(200)), (None, other[:120]),
            (far, say(90) + passage + "é"), (far, say(400))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r.doc_id, r.n_bytes): r.n_removed
           for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == {(0, 150): 0, (1, 150): 150, (1, 300): 120, (None, 200): 0, (None, 120): 0,
                   (far, 242): 150, (far, 400): 0}


def test_pieces_out_of_the_merge_share_no_window():
    rng = random.Random(9)
    common = [bytes(rng.choice(b"abcd") for _ in range(n)) for n in (32, 60, 99, 100, 101, 140)]
    texts = [b"".join(rng.choice([rng.choice(common), bytes(rng.choice(b"abcd") for _ in range(40))])
                      for _ in range(6)) for _ in range(120)]
    cut = suffix_dedup.Pieces()
    first, _ = suffix_dedup.collapse(np.concatenate([cut(t, i) for i, t in enumerate(texts)]))
    windows = [{texts[p["doc"]][s:s + 100] for s in range(p["start"], p["start"] + p["run"])}
               for p in first]
    seen = collections.Counter(w for found in windows for w in found)
    keep = suffix_dedup.may_share(first)
    assert 0 < (~keep).sum() and any(seen[w] > 1 for found in windows for w in found)
    assert all(keep[k] for k, found in enumerate(windows) if any(seen[w] > 1 for w in found))


def test_merged_transforms_are_sorted():
    rng = random.Random(5)
    shards = [np.frombuffer(b"".join(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30)))
                                     + b"\xff" for _ in range(9)), np.uint8) for _ in range(4)]
    place, new = suffix_dedup.merge_transforms(shards, 6)
    offsets = np.cumsum([0, *map(len, shards)])

    def prefix(p):
        k = int(np.searchsorted(offsets, p, side="right")) - 1
        return bytes(shards[k][(p - offsets[k] + j) % len(shards[k])] for j in range(6))
    order = [prefix(p) for p in place]
    assert order == sorted(order) and sorted(place) == list(range(offsets[-1]))
    assert new.tolist() == [k == 0 or order[k] != order[k - 1] for k in range(len(order))]
