"""The filter audit against every filter order applied to every document, one by one."""

import itertools
import random
import re

import pytest

from ledgerlake.llm import filter_audit

SCHEMA = "doc_id bigint, text string, source string, part string, mask int, key string, n bigint"
LABELS = "doc_id bigint, quality int, toxic int, part string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        out.append({f for f, failed in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            re.search(r"[#$%&*|]", text), doc_id is not None and doc_id > least[text])) if failed})
    return out


def brute(rows, labels):
    good = {i for i, q, *_ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, *_ in labels if t == 1 and i is not None}
    failed, out, shares = fails(rows), [], {}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, failed) if (r[2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shares[part, f] = shares.get((part, f), 0) + len(gone)
                out.append([part, "".join(order), step, len(left), len(gone),
                            sum(f in x[1] for x in own) - len(gone),
                            sum(x[1] == {f} for x in own), sum(x[0] in good for x in gone),
                            sum(x[0] in toxic for x in gone)])
    return sorted((*r, shares[r[0], r[1][r[2] - 1]]) for r in out)


def make():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(500)] + ["É", "x\x1fy", "a b"]

    def text():
        n = rng.choice([3, 190, 199, 200, 201, 400])
        out = rng.choices(words[:rng.choice([50, 100, 500])], k=n)
        out += rng.choice([[], [], ["$5"], ["A&B"], ["ABCDEFGH"] * 8])
        return rng.choice([" ", "\n", "\t \x0b"]).join(out)
    pool = [text() for _ in range(40)] + [None, "", "", " \r\n"]
    hot = text()
    rows = [(i, hot if i % 3 == 0 else rng.choice(pool), rng.choice(["a", "b", None, ""]))
            for i in range(400)]
    rows += [(50, hot, "b"), (0, hot, "a"), (0, hot, None), (None, hot, "a"), (None, hot, "a"),
             (None, None, None), (None, "alone", "c"), (900, "word " * 150_000, "a")]
    rng.shuffle(rows)
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1), "x") for i in range(0, 400, 2)] + \
        [(4, 1, None, "x"), (4, None, 1, "x"), (None, 1, 1, "x"), (5000, 1, 1, "x")]
    return rows, labels


def run(spark, folder, rows, labels, parts, **options):
    path = f"{folder}/documents.parquet"
    whole = [(*r, "p", 1, "k", 7) for r in rows]
    docs = spark.createDataFrame(whole, SCHEMA)
    docs.repartition(parts).write.parquet(path)
    counts = filter_audit.mask_counts(spark, path, spark.createDataFrame(labels, LABELS), **options)
    return sorted(tuple(r) for r in filter_audit.audit(counts).collect())


def test_every_order_of_the_filters(spark, scratch):
    rows, labels = make()
    # many small batches: most smallest ids come late and retract what was counted before
    assert run(spark, scratch, rows, labels, 9, n_batches=9) == brute(rows, labels)


def test_batches_make_no_difference(spark, scratch):
    rows, labels = make()
    assert run(spark, scratch, rows, labels, 3, n_batches=1) == brute(rows, labels)


def test_smaller_ids_that_arrive_later_retract(spark, scratch):
    path, labels = f"{scratch}/documents.parquet", [(9, 1, 0, "x"), (2, 0, 1, "x")]
    rows = [(9, "same", "a"), (5, "same", "b"), (7, "same", "a"), (2, "same", "c")]
    for row in rows:  # one file and one batch each, in this order
        spark.createDataFrame([(*row, "p", 1, "k", 7)], SCHEMA).coalesce(1).write.mode("append") \
            .parquet(path)
    counts = filter_audit.mask_counts(spark, path, spark.createDataFrame(labels, LABELS),
                                      n_batches=4)
    assert sorted(tuple(r) for r in counts.collect() if r.n) == [
        ("a", 17, 2, 1, 0), ("b", 17, 1, 0, 0), ("c", 1, 1, 0, 1)]
    assert sorted(tuple(r) for r in filter_audit.audit(counts).collect()) == brute(rows, labels)


def test_empty_table(spark, scratch):
    assert run(spark, scratch, [], [], 1) == []


@pytest.mark.parametrize("text, mask", [
    ("", 1), ("w " * 200, 2), (" ".join(f"w{k}" for k in range(200)), 0), ("A", 5),
    (" ".join(f"w{k % 100}" for k in range(200)), 0), ("x|", 9),
    ("A" * 2 + "é" * 98, 1), ("A" * 2 + "é" * 97, 5),
])
def test_masks(text, mask):
    assert filter_audit.mask_of(text.encode()) == mask
