"""Toxicity: a learned lexicon, fuzzy matches by automaton, and scores of context windows.

The lexicon holds words and stems (first ``STEM`` letters, written ``stem*``) that stand in toxic
training documents far more often than in others.
It is a trie; the Levenshtein automaton of a text's word (distance 1, from five letters on) is
run down the trie, so misspelled terms are found as well. Around each hit a window of words
gives a score in which hits inside quotation marks or near words of reporting count apart from
open ones. Trees over these scores, fitted on a second part of the sample, give the probability.

Sample: at most ``MAX_TRAINING_ROWS`` labelled rows outside the held-out fold, two thirds for
the lexicon and one third for the trees; at most ``MAX_TERMS`` terms.

Defined cases: null and empty texts have no hit and score like texts without one; null, repeated
or foreign labels as in the quality classifier; without toxic labels the lexicon is empty; extra
columns are not read. Scoring reads every whole text once, without a shuffle."""

from __future__ import annotations

import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import gbdt
from .common import bounded_batches, columns, documents, raw_texts
from .quality import MAX_TRAINING_ROWS, held_out, training_rows

MAX_TERMS = 5_000
MIN_TOXIC_DOCS = 3
MIN_DEVIATION = 5.0
MIN_FUZZY = 5      # letters of a term from which misspellings count
STEM = 5           # letters of a stem
WINDOW = 12        # words on either side of a hit
CACHE_WORDS = 400_000
THRESHOLD = 0.5
N_FEATURES = 9
# Words that report speech.
REPORTING = frozenset(b"said says say called calls wrote writes quote quoted quotes reported "
                      b"term word words slur insult".split())
_SPLIT = bytes(c if 0x30 <= c < 0x3A or 0x61 <= c < 0x7B or c >= 0x80 else 0x20
               for c in range(256))
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_SPLIT).split()


def with_stems(words: set[bytes]) -> list[bytes]:
    """Words, and a stem with a star for each longer word."""
    stems = {w.decode("utf-8", "replace")[:STEM].encode() + b"*" for w in words if len(w) > STEM}
    return sorted(words | stems)


def _without_one(text: str) -> list[str]:
    """A string, and what is left of it without each of its letters."""
    return [text, *[text[:i] + text[i + 1:] for i in range(len(text))]]


def worker_lexicon(weights: dict[str, float]) -> Lexicon:
    """The lexicon of this Python worker, kept from task to task with the words seen."""
    kept = sys.modules.setdefault("_ledgerlake_worker", types.ModuleType("_ledgerlake_worker"))
    if kept.__dict__.get("weights") != weights:
        kept.weights, kept.lexicon = weights, Lexicon(weights)
    return kept.lexicon


class Lexicon:
    """A trie of terms with weights, searched by Levenshtein automata of distance 1."""

    def __init__(self, weights: dict[str, float]):
        self.root: dict = {}
        self.shorter, self.seen = set(), {}  # terms and what is left of them without a letter
        self.stems = {t[:-1]: w for t, w in weights.items() if t.endswith("*")}
        weights = {t: w for t, w in weights.items() if not t.endswith("*")}
        for term, weight in weights.items():
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = weight
            if len(term) >= MIN_FUZZY:
                self.shorter.update(_without_one(term))
        self.exact = {t.encode(): w for t, w in weights.items()}

    def find(self, word: bytes) -> tuple[float, int] | None:
        """Weight and distance of the best term within one edit of a word."""
        weight = self.exact.get(word)
        if weight is not None:
            return weight, 0
        if word in self.seen:
            return self.seen[word]
        text = word.decode("utf-8", "replace")
        stem = self.stems.get(text[:STEM]) if len(word) > STEM else None
        found = (stem, 0) if stem is not None else None
        # one edit apart means one string in common when a letter may go on either side
        if found is None and len(text) >= MIN_FUZZY - 1 and \
                not self.shorter.isdisjoint(_without_one(text)):
            best = self._run(text, 0, self.root, 1, 0)
            found = (best, 1) if best is not None else None
        if len(self.seen) >= CACHE_WORDS:
            self.seen.clear()
        self.seen[word] = found
        return found

    def _run(self, text: str, i: int, node: dict, edits: int, depth: int) -> float | None:
        """The automaton's state is (letters read, edits left); the trie says which letters
        can follow."""
        best = None
        if i == len(text) and depth >= MIN_FUZZY:
            best = node.get("")
        tries = []
        if i < len(text) and text[i] in node:
            tries.append((i + 1, node[text[i]], edits, depth + 1))
        if edits:
            if i < len(text):
                tries.append((i + 1, node, 0, depth))                      # a letter too many
            for c, child in node.items():
                if c:
                    tries.append((i, child, 0, depth + 1))                 # a letter missing
                    if i < len(text) and c != text[i]:
                        tries.append((i + 1, child, 0, depth + 1))         # another letter
        for state in tries:
            got = self._run(text, *state)
            if got is not None and (best is None or got > best):
                best = got
        return best


def _quoted(text: bytes, at: int) -> bool:
    """Whether a position lies between quotation marks of its line."""
    begin = text.rfind(b"\n", 0, at) + 1
    end = text.find(b"\n", at)
    before, after = text[begin:at], text[at:end if end >= 0 else len(text)]
    if before.count(b'"') % 2 and b'"' in after:
        return True
    return any(before.rfind(a) > before.rfind(z) and z in after
               for a, z in ((b"\xe2\x80\x9c", b"\xe2\x80\x9d"), (b"\xc2\xab", b"\xc2\xbb")))


def features(text: bytes, lexicon: Lexicon) -> list[float]:
    """Hits and window scores of one text."""
    hits = {w: h for w in set(words_of(text)) if (h := lexicon.find(w))}
    if not hits:
        return [0.0] * N_FEATURES
    low = text.lower()
    tokens = [(m.start(), m[0]) for m in _TOKEN.finditer(low)]
    places = [(k, at, *hits[w]) for k, (at, w) in enumerate(tokens) if w in hits]
    open_, fuzzy, quoted = [], [], []
    weight_at = np.zeros(len(tokens))
    for k, at, weight, distance in places:
        near = {w for _, w in tokens[max(0, k - WINDOW):k + WINDOW + 1]}
        if _quoted(low, at) or near & REPORTING:
            quoted.append(weight)
            continue
        (fuzzy if distance else open_).append(weight)
        weight_at[k] = weight * (0.5 if distance else 1)
    total = np.concatenate([[0], weight_at.cumsum()])
    at = np.array([k for k, *_ in places])
    window = total[np.minimum(at + WINDOW + 1, len(tokens))] - total[np.maximum(at - WINDOW, 0)]
    return [max(open_, default=0), sum(open_), len(open_), max(fuzzy, default=0), sum(fuzzy),
            max(quoted, default=0), len(quoted), float(window.max()),
            sum(open_) / len(tokens) * 100]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Terms and log-odds from (text, label) rows: counts of documents by word and label."""
    def split(batches):
        for b in batches:
            for t, y in zip(raw_texts(b.column(0)), b.column(1).to_pylist()):
                found = pa.array(with_stems(set(words_of(t))), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [found, pa.array([y] * len(found), pa.float64())], ["word", "label"])
    size = sample.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = size.n, size.toxic or 0
    if not 0 < toxic < n:
        return {}
    p = toxic / n
    counts = sample.mapInArrow(split, "word binary, label double").groupBy("word") \
        .agg(F.sum("label").alias("t"), F.count("*").alias("c"))
    deviation = (F.col("t") - F.col("c") * p) / F.sqrt(F.col("c") * p * (1 - p))
    odds = F.log((F.col("t") + 0.5) / (F.col("c") - F.col("t") + 0.5) / (p / (1 - p)))
    rows = counts.filter((F.col("t") >= MIN_TOXIC_DOCS) & (deviation >= MIN_DEVIATION)
                         & (odds > 1) & (F.octet_length("word") <= 64)) \
        .select("word", odds.alias("weight")) \
        .orderBy(F.desc("weight"), "word").limit(MAX_TERMS).collect()
    return {bytes(r.word).decode("utf-8", "replace"): float(r.weight) for r in rows}


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic",
                 limit: int = MAX_TRAINING_ROWS) -> tuple[dict[str, float], gbdt.Trees]:
    bounded_batches(docs.sparkSession)
    rows = F.broadcast(training_rows(labels, label, limit))  # ``limit`` rows of two numbers
    sample = columns(docs, "doc_id", "text").join(rows, "doc_id") \
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)))
    weights = learn_lexicon(sample.filter("part > 0").select("text", "label"))

    def measure(batches):
        lexicon = Lexicon(weights)
        for b in batches:
            x = [features(t, lexicon) for t in raw_texts(b.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "label"])
    rows = sample.filter("part = 0").select("text", "label") \
        .mapInArrow(measure, "x array<double>, label double").collect()
    trees = gbdt.fit(np.array([r.x for r in rows]).reshape(-1, N_FEATURES),
                     np.array([r.label for r in rows]), n_trees=40, depth=3, min_hessian=0.2)
    return weights, trees


def score_toxicity(docs: DataFrame, weights: dict[str, float], trees: gbdt.Trees) -> DataFrame:
    """(doc_id, score) of every row."""
    def score(batches):
        lexicon = worker_lexicon(weights)
        for b in batches:
            x = np.array([features(t, lexicon) for t in raw_texts(b.column(1))]) \
                .reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(trees.score(x))],
                                             ["doc_id", "score"])
    bounded_batches(docs.sparkSession)
    return columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text") \
        .mapInArrow(score, "doc_id bigint, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score_toxicity(docs, *fit_toxicity(docs, documents(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
