"""Merkle manifest of a dataset: nested-interval labels, containment joins, membership proofs.

Every row is a leaf; the leaves of one source are a tree, and the roots of these trees are the
leaves of the tree of the dataset. In a tree a leaf has a rank and a node is labelled with the
interval of the ranks that it covers. Bottom-up, the nodes of a level that fall in one bucket of
``FANOUT ** (level + 1)`` ranks become one node of the next. Top-down, every level is joined with
the level above by the bucket of that level and by containment of the intervals. What remains
of the parent's interval without the child's, a piece to its left and a piece to its right, names
the siblings: children of the parent whose intervals lie in these pieces. A node's path is its
siblings and the path of its parent, so that a leaf has the whole proof after the last join.

Ranks need no window over a source: rows are sorted by ranges of (source, doc_id), numbered in
each partition, and shifted by the rows of the source in earlier partitions.

Defined cases: null and empty sources are different sources, null is the first; a null doc_id
comes before all others and its text is never tampered with; rows that repeat a doc_id follow
their leaves' digests; a table without rows has no leaf and gives no rows; columns that are not
part of a leaf are not read.

Scale: a text is read once, where it lies; from then on rows are digests and labels. A bucket has
at most ``FANOUT`` children whatever the size of a source, and a level is ``FANOUT`` times
smaller than the one below. The only row that the driver sees is the size of the largest tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import Scratch, columns, documents

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before: string, after: string>>"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values, each with its length in bytes; ``-`` where null."""
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
        for v in [v.cast("string") for v in values]]), 256)


def joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def ranked(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with their rank (from 0) in their ``tree`` by ``order``, and the tree's size."""
    placed = scratch.write(
        rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
        .withColumn("place", F.monotonically_increasing_id()), f"{name}-placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"),
                                               F.count("*").alias("n"))
    earlier = Window.partitionBy("tree").orderBy("part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    parts = scratch.write(parts.select(
        F.col("tree").alias("_tree"), F.col("part").alias("_part"), "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"),
        F.sum("n").over(whole).alias("size")), f"{name}-parts")
    return placed.join(parts, placed["tree"].eqNullSafe(parts["_tree"])
                       & (placed["part"] == parts["_part"])) \
        .withColumn("rank", F.col("place") - F.col("first") + F.col("shift")) \
        .drop("_tree", "_part", "part", "place", "first", "shift")


def is_root() -> Column:
    return (F.col("lo") == 0) & (F.col("hi") == F.col("size"))


def bucket(level: int) -> Column:
    """Which bucket of its level a node's interval begins in."""
    return F.shiftright("lo", FANOUT_BITS * level)


def levels(leaves: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """The nodes (tree, lo, hi, size, digest, children) of all trees, a table for each level;
    the interval [lo, hi) holds the ranks that a node covers. Leaves keep their columns."""
    bottom = leaves.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1).drop("rank")
    found, largest = [bottom], leaves.agg(F.max("size")).first()[0] or 0
    while FANOUT ** (len(found) - 1) < largest:
        k = len(found)
        up = found[-1].filter(~is_root()).groupBy("tree", "size", bucket(k).alias("bucket")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children")) \
            .select("tree", "lo", "hi", "size", F.sha2(joined(F.col("children")), 256)
                    .alias("digest"), "children")
        found.append(scratch.write(up, f"{name}-level-{k}"))
    return found


def attach(nodes: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves of all trees with top, root and path. ``above`` gives the path and the root
    over each tree: (tree, root, path); top is the tree's own root. A path is the longest of the
    columns, so a leaf's is made by the last join and is not shuffled again."""
    above = above.select(F.col("tree").alias("_tree"), "root", "path")
    upper = None
    for k in reversed(range(len(nodes))):
        level = nodes[k]
        done = level.filter(is_root()).join(above, F.col("tree").eqNullSafe(F.col("_tree"))) \
            .drop("_tree").withColumn("top", F.col("digest"))
        if upper is not None:
            parent = upper.select(
                F.col("tree").alias("p_tree"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                F.col("children").alias("p_children"), F.col("path").alias("p_path"), "root", "top",
                bucket(k + 1).alias("p_bucket"))
            child = level.filter(~is_root()).withColumn("bucket", bucket(k + 1))
            contained = F.col("tree").eqNullSafe(F.col("p_tree")) \
                & (F.col("bucket") == F.col("p_bucket")) \
                & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
            # the parent's interval without the child's: [p_lo, lo) and [hi, p_hi)
            before = F.filter("p_children", lambda c: c["hi"] <= F.col("lo"))
            after = F.filter("p_children", lambda c: c["lo"] >= F.col("hi"))
            step = F.array(F.struct(joined(before).alias("before"), joined(after).alias("after")))
            below = child.join(parent, contained).select(
                *level.columns, "root", F.concat(step, "p_path").alias("path"), "top")
            done = done.select(*below.columns).unionByName(below)
        upper = done
    return upper


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, make."""
    return F.aggregate(path, leaf, lambda made, step: F.sha2(
        F.concat(step["before"], made, step["after"]), 256))


def prove(leaves: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """``leaves`` (tree, digest, ...) with top, root and path; ``order`` sorts a tree."""
    trees = levels(ranked(leaves, order, scratch, "leaves"), scratch, "tree")
    tops = None
    for level in trees:
        own = level.filter(is_root()).select(F.col("tree").alias("name"), "digest")
        tops = own if tops is None else tops.unionByName(own)
    tops = scratch.write(tops.withColumn("tree", F.lit(0)), "tops")
    forest = levels(ranked(tops, ["name"], scratch, "tops"), scratch, "forest")
    # the path over the only root of the forest is empty, and that root is the dataset's
    over = None
    for level in forest:
        own = level.filter(is_root()).select("tree", F.col("digest").alias("root"))
        over = own if over is None else over.unionByName(own)
    over = over.withColumn("path", F.array().cast(_PATH))
    over = attach(forest, over).select(F.col("name").alias("tree"), "root", "path")
    return attach(trees, scratch.write(over, "over"))


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.
    ``tampered`` is the text that a verifier holds where it is not null."""
    scratch = Scratch(docs.sparkSession, "merkle")
    rows = columns(docs, *FIELDS)
    held = tampered if tampered is not None else F.lit(None).cast("string")
    rows = scratch.write(rows.withColumn("held", held).select(
        "doc_id", F.col("source").alias("tree"), digest(*[F.col(c) for c in FIELDS]).alias("digest"),
        F.when(F.col("held").isNotNull(), digest(*[F.col(c) for c in FIELDS[:-1]], F.col("held")))
        .alias("held")), "leaves")
    proved = prove(rows, ["doc_id", "digest"], scratch)
    siblings = F.array_join(F.transform(
        "path", lambda step: F.concat(step["before"], step["after"])), "")
    folded = fold(F.coalesce("held", "digest"), F.col("path"))
    return proved.select(
        "doc_id", F.col("tree").alias("source"), F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"), "root",
        F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's manifest; texts are lower-cased where 5 divides the id's CRC-32."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.when(hit, F.translate("text", _UPPER, _LOWER))
    return manifest(documents(spark, sf_dir), lowered).drop("source")


#: The same by recursion over levels. CRC-32 is written out bit by bit.
OP12_SQL = """
WITH RECURSIVE rows AS (
  SELECT doc_id, source, lang, n_chars, text,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(1, 1 + length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 5 = 0 AS hit
  FROM documents
), parts AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
    || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      ELSE text END AS held
  FROM rows
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(held) || ':' || held, '-')) AS held
  FROM parts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
    count(*) OVER (PARTITION BY source) AS size
  FROM leaves
), tree AS (
  SELECT 0 AS level, source, rank AS node, size, leaf AS digest FROM ranked
  UNION ALL
  SELECT level + 1, source, node // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY node))
  FROM tree WHERE size > 1 GROUP BY ALL
), tops AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank,
    count(*) OVER () AS size
  FROM tree WHERE size = 1
), forest AS (
  SELECT 0 AS level, rank AS node, size, digest FROM tops
  UNION ALL
  SELECT level + 1, node // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY node))
  FROM forest WHERE size > 1 GROUP BY ALL
), low AS (
  SELECT a.level, a.source, a.node, a.size, a.digest,
    coalesce(string_agg(b.digest, '' ORDER BY b.node) FILTER (b.node < a.node), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.node) FILTER (b.node > a.node), '') AS after
  FROM tree a JOIN tree b ON a.level = b.level AND a.source IS NOT DISTINCT FROM b.source
    AND a.node // 16 = b.node // 16 GROUP BY ALL
), high AS (
  SELECT a.level, a.node, a.size, a.digest,
    coalesce(string_agg(b.digest, '' ORDER BY b.node) FILTER (b.node < a.node), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.node) FILTER (b.node > a.node), '') AS after
  FROM forest a JOIN forest b ON a.level = b.level AND a.node // 16 = b.node // 16 GROUP BY ALL
), climb AS (
  SELECT r.doc_id, r.source, r.rank AS id, 0 AS level, r.rank AS node, r.size, r.leaf, '' AS proof,
    r.held AS made
  FROM ranked r
  UNION ALL
  SELECT c.doc_id, c.source, c.id, c.level + 1, c.node // 16, (c.size + 15) // 16, c.leaf,
    c.proof || l.before || l.after, sha256(l.before || c.made || l.after)
  FROM climb c JOIN low l ON c.level = l.level AND c.source IS NOT DISTINCT FROM l.source
    AND c.node = l.node WHERE c.size > 1
), summit AS (
  SELECT c.doc_id, c.leaf, t.digest AS subroot, 0 AS level, t.rank AS node, t.size, c.proof, c.made
  FROM climb c JOIN tops t ON c.source IS NOT DISTINCT FROM t.source WHERE c.size = 1
  UNION ALL
  SELECT s.doc_id, s.leaf, s.subroot, s.level + 1, s.node // 16, (s.size + 15) // 16,
    s.proof || h.before || h.after, sha256(h.before || s.made || h.after)
  FROM summit s JOIN high h ON s.level = h.level AND s.node = h.node WHERE s.size > 1
)
SELECT s.doc_id, s.leaf, s.subroot, f.digest AS root, sha256(s.proof) AS proof_sha256,
  s.made AS folded_root, s.made = f.digest AS verified
FROM summit s, (SELECT digest FROM forest WHERE size = 1) f WHERE s.size = 1
"""
