"""Merkle manifest of a table by sibling-shift self-joins.

Every row is a leaf; leaves of one group (language) ascend by id and form a tree of runs of `arity` nodes, whose top is
the group's subroot.  The subroots, ordered by group, form one more tree, whose top is the root.

A level is a table of nodes (group, position, digest).  It joins itself on computed sibling positions: a node asks for
position XOR 1 in a binary tree, else for the positions at all slot offsets in its run, so every node meets its whole
run by an equijoin.  The rows in slot zero then emit the parents, the next level's nodes.  On the way back, level joins
level on the parent's position and hands down the path: the runs above a node, up to the root.  A path serves as proof
(its siblings) and folds any leaf up to a root.  Texts are read once; from there on only 32-byte digests move.  No key of
a join is shared by more than `arity` nodes, whatever the group's size.

Positions come from one range-partitioned sort: positions within a partition plus the counts of the partitions before
it, per group.  The sort ends with a row number of its own, so that a key which repeats spreads over partitions.

Nulls: a null field has the text `-`; a null group is a group of its own and comes first; a null id comes first in its
group and is never tampered with.  Rows that repeat an id are leaves of their own, ordered by digest; equal ones cannot be
told apart and take adjacent positions.  Empty texts are fields of size 0, long ones are hashed whole.  An empty table gives
an empty result.  Columns that are no fields are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.frames import kept, read

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EVERY = 3
WIDTH = 32
PATH = "array<struct<slot:int,run:binary>>"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_text(digests: Column) -> Column:
    """One or more digests in lowercase hexadecimal."""
    return F.lower(F.hex(digests))


def field(value: Column) -> Column:
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(columns: list[Column]) -> Column:
    return digest(F.concat(*map(field, columns)))


def group_key(group: Column) -> Column:
    """A group as text that is never null; null sorts before all others."""
    return F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group.cast("string")))


def positioned(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their place `i` in their group `g`, from 0 by `order`, and the group's size `n`."""
    keys = ["g", *order, "tie"]
    laid = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = kept(laid.withColumn("at", F.monotonically_increasing_id()), "laid").withColumn("part", F.expr("at >> 33"))
    runs = laid.groupBy("g", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    before = F.expr("coalesce(sum(rows) OVER (PARTITION BY g ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    starts = runs.select("g", "part", (before - F.col("first")).alias("start"), F.expr("sum(rows) OVER (PARTITION BY g)").alias("n"))
    return laid.join(starts, ["g", "part"]).withColumn("i", F.col("at") + F.col("start")).drop("tie", "at", "part", "start")


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """Every node of a group that still has several, with the digests of its run in order and its slot there."""
    own, slot = F.col("i"), F.col("i") % arity
    if arity == 2:
        asked = F.array(own, own.bitwiseXOR(F.lit(1)))
    else:
        asked = F.transform(F.sequence(F.lit(0), F.lit(arity - 1)), lambda shift: own - slot + (slot + shift) % arity)
    asking = nodes.filter("n > 1").select("g", "i", "n", F.explode(asked).alias("sibling")).filter("sibling < n")
    answers = nodes.select("g", F.col("i").alias("sibling"), "h")
    met = asking.join(answers, ["g", "sibling"]).groupBy("g", "i", "n").agg(F.array_sort(F.collect_list(F.struct("sibling", "h"))).alias("met"))
    run = F.aggregate("met", F.lit(b"").cast("binary"), lambda all_, one: F.concat(all_, one["h"]))
    return met.select("g", "i", "n", slot.cast("int").alias("slot"), run.alias("run"))


def _parents(runs: DataFrame, arity: int) -> DataFrame:
    up = runs.filter("slot = 0")
    return up.select("g", F.floor(F.col("i") / arity).alias("i"), F.ceil(F.col("n") / arity).alias("n"), digest(as_text(F.col("run"))).alias("h"))


def _grown(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """All levels' nodes and runs.  Level k + 1 holds the parents of level k; a group ends with its single node."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, runs = [nodes], []
    while most > 1:
        runs.append(kept(_runs(levels[-1], arity), "runs"))
        levels.append(_parents(runs[-1], arity))
        most = -(-most // arity)
    return levels, runs


def _paths(levels: list[DataFrame], runs: list[DataFrame], arity: int, tops: DataFrame) -> DataFrame:
    """The nodes of level 0 with their `path`, an array of (slot, run) from the bottom up, and what `tops` has for
    their group: `path` above the subroot, and other columns."""
    more = [c for c in tops.columns if c not in ("g", "path")]
    known = None
    for level in reversed(range(len(levels))):
        single = levels[level].filter("n = 1").select("g", "i").join(tops, "g").select("g", "i", "path", *more)
        if level < len(runs):
            above = known.select("g", F.col("i").alias("up"), F.col("path").alias("above"), *more)
            step = F.array(F.struct("slot", "run"))
            below = runs[level].withColumn("up", F.floor(F.col("i") / arity)).join(above, ["g", "up"])
            single = single.unionByName(below.select("g", "i", F.concat(step, "above").alias("path"), *more))
        known = kept(single, "paths")
    return known


def _around(step: Column) -> tuple[Column, Column]:
    """The digests of a step's run before and behind the node itself."""
    run, at = step["run"], step["slot"] * WIDTH
    return F.substring(run, F.lit(1), at), F.substring(run, at + WIDTH + 1, F.octet_length(run))


def siblings(path: Column) -> Column:
    """The siblings' digests in a path as text, level by level."""
    return F.aggregate(path, F.lit(""), lambda text, step: F.concat(text, *map(as_text, _around(step))))


def folded(leaf_: Column, path: Column) -> Column:
    """The root that a leaf (a digest) and the siblings of a path give."""

    def up(h: Column, step: Column) -> Column:
        before, behind = _around(step)
        return digest(as_text(F.concat(before, h, behind)))

    return F.aggregate(path, leaf_, up)


def manifest(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """`leaves` (g, id, leaf and others) with `path`, `subroot` and `root`; g is a group_key, digests are binary."""
    nodes = kept(positioned(leaves, ["id", "leaf"]), "leaves")
    levels, runs = _grown(nodes.select("g", "i", "n", F.col("leaf").alias("h")), arity)
    subroots = levels[0].filter("n = 1")
    for level in levels[1:]:
        subroots = subroots.unionByName(level.filter("n = 1"))
    upper = subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), "h")
    upper = kept(positioned(upper, ["of"]), "subroots")
    upper_levels, upper_runs = _grown(upper.select("g", "i", "n", "h"), arity)
    root = F.lit((upper_levels[-1].select("h").first() or [None])[0])
    start = upper_levels[-1].select("g", F.array().cast(PATH).alias("path"))
    upper_paths = _paths(upper_levels, upper_runs, arity, start)
    tops = upper.join(upper_paths, ["g", "i"]).select(F.col("of").alias("g"), "path", F.col("h").alias("subroot"))
    paths = _paths(levels, runs, arity, kept(tops, "tops"))
    return nodes.drop("n").join(paths, ["g", "i"]).withColumn("root", root.cast("binary"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_EVERY == 0
    changed = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    leaves = docs.select(
        group_key(F.col("lang")).alias("g"),
        F.col("doc_id").alias("id"),
        leaf([F.col(c) for c in FIELDS]).alias("leaf"),
        F.when(tampered, leaf(changed)).alias("tampered"),
    )
    out = manifest(kept(leaves, "digests"))
    out = out.withColumn("folded", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return out.select(
        F.col("id").alias("doc_id"),
        *[as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        as_text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


# DuckDB has no crc32, so its table comes from the polynomial.
OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY b) AS entry
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(b))
), sums AS (
  SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
    lambda c, x: xor(c >> 8, entry[(xor(c, x) & 255) + 1])), 4294967295) AS crc32
  FROM documents, crc WHERE doc_id IS NOT NULL
), fields AS (
  SELECT d.doc_id, d.lang, COALESCE(crc32 % 3 = 0, FALSE) AS touched, text,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    COALESCE(octet_length(encode(CAST(d.doc_id AS VARCHAR))) || ':' || d.doc_id, '-') || COALESCE(octet_length(encode(source)) || ':' || source, '-')
      || COALESCE(octet_length(encode(lang)) || ':' || lang, '-') || COALESCE(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head
  FROM documents d LEFT JOIN sums USING (doc_id)
), digests AS (
  SELECT doc_id, lang, sha256(head || COALESCE(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || COALESCE(octet_length(encode(low)) || ':' || low, '-')) AS low_leaf, touched
  FROM fields
), leaves AS (
  SELECT *, COALESCE('=' || lang, '-') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, COUNT(*) OVER (PARTITION BY lang) AS n
  FROM digests
), tree(k, g, i, n, h) AS (
  SELECT 0, g, i, n, leaf FROM leaves
  UNION ALL
  SELECT k + 1, g, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY k, g, i // 8, n
), tops AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, COUNT(*) OVER () AS n FROM tree WHERE n = 1
), crown(k, i, n, h) AS (
  SELECT 0, i, n, h FROM tops
  UNION ALL
  SELECT k + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM crown WHERE n > 1 GROUP BY k, i // 8, n
), places AS (
  SELECT l.doc_id, l.leaf, l.g, l.i, t.i AS top, h AS subroot, unnest(range(20)) AS k FROM leaves l JOIN tops t USING (g)
), around AS (
  SELECT p.g, p.i, p.k AS step, string_agg(CASE WHEN t.i < p.i >> (3 * p.k) THEN h END, '' ORDER BY t.i) AS pre, string_agg(CASE WHEN t.i > p.i >> (3 * p.k) THEN h END, '' ORDER BY t.i) AS post
  FROM places p JOIN tree t ON t.g = p.g AND t.k = p.k AND t.n > 1 AND t.i // 8 = p.i >> (3 * p.k + 3) GROUP BY p.g, p.i, p.k
  UNION ALL
  SELECT p.g, p.i, 100 + p.k, string_agg(CASE WHEN t.i < p.top >> (3 * p.k) THEN h END, '' ORDER BY t.i), string_agg(CASE WHEN t.i > p.top >> (3 * p.k) THEN h END, '' ORDER BY t.i)
  FROM places p JOIN crown t ON t.k = p.k AND t.n > 1 AND t.i // 8 = p.top >> (3 * p.k + 3) GROUP BY p.g, p.i, p.k
), steps AS (
  SELECT g, i, row_number() OVER (PARTITION BY g, i ORDER BY step) AS s, COALESCE(pre, '') AS pre, COALESCE(post, '') AS post FROM around
), fold(g, i, s, h) AS (
  SELECT g, i, 0, CASE WHEN touched THEN low_leaf ELSE leaf END FROM leaves
  UNION ALL
  SELECT f.g, f.i, f.s + 1, sha256(pre || h || post) FROM fold f JOIN steps t ON t.g = f.g AND t.i = f.i AND t.s = f.s + 1
), proofs AS (
  SELECT g, i, string_agg(pre || post, '' ORDER BY s) AS proof FROM steps GROUP BY g, i
), roots AS (
  SELECT h AS root FROM crown WHERE n = 1
), ends AS (
  SELECT g, i, arg_max(h, s) AS folded_root FROM fold GROUP BY g, i
)
SELECT l.doc_id, l.leaf, t.h AS subroot, root, sha256(COALESCE(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN tops t USING (g) JOIN ends e ON e.g = l.g AND e.i = l.i LEFT JOIN proofs p ON p.g = l.g AND p.i = l.i CROSS JOIN roots
"""
