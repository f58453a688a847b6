"""Near duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidates.

A text's set is that of its distinct word shingles, as 64-bit hashes.  Hashes are one permutation of all shingles: the range
of hashes is cut into BINS bins, and a bin's value is the smallest hash in it.  A bin without a hash borrows from the first
bin with one in an order drawn for each bin alone (optimal densification), so two sets agree in a bin with a chance of
about their similarity, however small they are.  BANDS bands of ROWS bins each name a bucket; two sets at the threshold
of 0.8 meet in none with a chance of (1 - 0.8 ** ROWS) ** BANDS = 5e-9.

1. One pass over the texts writes every row's id, set size and set key, and the buckets of each distinct set.  Equal sets
   are one class from here on.
2. Buckets of a single class go.  Each other bucket names a few centres, and every other class in it makes candidate
   edges with these only: a star, so a bucket of k classes has candidates in proportion to k, not to its square.
3. A candidate edge is dropped at once if the sizes of its sets, or how many of the SKETCH_BITS bits of their odd
   sketches differ, rule a link out.  The others are confirmed on the full sets, save pairs that links of the same task
   connect already; links merge classes into components.
4. Centres have met all of their bucket and leave it; buckets whose classes are now of one component close.  Others take
   MORE_CENTRES times the centres in the next round, until none is open.  So every pair of classes that shares a bucket is confirmed,
   refused, or connected already, and nothing is capped.  A class's turn in a bucket is its hash times the bucket's size, so
   no bucket is sorted or gathered to choose its centres.

Keys that many rows share (buckets of near copies, sets of exact copies) are joined by broadcast: those with at least
HEAVY_ROWS rows and one in HEAVY_KEYS of all, so there are at most HEAVY_KEYS of them; where a key has k centres it must
have k times as many rows, so about HEAVY_KEYS centres are sent at most.  Before texts of candidate classes
move, a bit table of fixed size drops the others; when it is full it drops less, and the join still decides.

Null and empty texts have no shingles, are linked with nothing and are kept.  A null id gets no component, links nothing and
is kept.  Rows that repeat an id are answered each.  Texts with fewer words than a shingle are one shingle.  Long texts are
read whole, a slice of SLICE_BYTES at a time.  Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.components import components
from suturestar.llm.frames import kept, read, sliced
from suturestar.llm.shingles import mixed, set_key, shingle_sets

WORDS = 2
PERCENT = 80
ROWS = 5
BANDS = 48
BINS = ROWS * BANDS
CENTRES = 2
MORE_CENTRES = 8
HEAVY_ROWS = 1_000
HEAVY_KEYS = 1 << 16
FILTER_BITS = 1 << 26
BITMAP = 1 << 15
SLICE_BYTES = 4 << 20
KEPT_SETS = 2 << 20
DONE_CLASSES = 500_000
SKETCH_BITS = 512
TURNS = 1 << 31
SKETCH = "id long, n int, class long, bands array<long>, bits array<long>"

_RANDOM = np.random.Generator(np.random.PCG64(20250713))
_EDGES = np.array([i * 2**64 // BINS for i in range(BINS)], np.uint64)
_LENDERS = np.stack([_RANDOM.permutation(BINS) for _ in range(BINS)])
_BAND = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signature(s: np.ndarray) -> np.ndarray:
    """The smallest hash of every bin of a sorted set, empty bins densified."""
    first = np.searchsorted(s, _EDGES)
    filled = first < np.append(first[1:], len(s))
    value = s[np.minimum(first, len(s) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        lenders = _LENDERS[empty]
        value[empty] = value[lenders[np.arange(len(empty)), filled[lenders].argmax(1)]]
    return value


def band_keys(s: np.ndarray) -> np.ndarray:
    """The buckets of a set, one for every band."""
    value = signature(s).reshape(BANDS, ROWS)
    key = _BAND.copy()
    for row in range(ROWS):
        key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + value[:, row])
    return key.view(np.int64)


def sketch_bits(s: np.ndarray) -> np.ndarray:
    """SKETCH_BITS bits (an odd sketch): whether an odd number of the set's hashes falls on each.

    What two sets share cancels out, so their bits differ only where the shingles in one of them do: at most as many
    bits as such shingles, and few less, however large the shared part is.
    """
    fallen = np.bincount((s & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((fallen & 1).astype(bool)).view(np.int64)


def _sketched(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row's set; the buckets and bits of a class with its first row of the task that has an id."""
    done: set[int] = set()
    for rows in sliced(batches, SLICE_BYTES, "text"):
        sets = shingle_sets(rows.column("text").cast(pa.binary()).to_pylist(), words)
        keys, bands, bits = [set_key(s) for s in sets], [], []
        for id_, s, k in zip(rows.column("id").to_pylist(), sets, keys):
            new = id_ is not None and len(s) > 0 and k not in done
            bands.append(band_keys(s) if new else None)
            bits.append(sketch_bits(s) if new else None)
            if new:
                if len(done) >= DONE_CLASSES:
                    done.clear()
                done.add(k)
        longs = [pa.array(x, pa.list_(pa.int64())) for x in (bands, bits)]
        columns = [rows.column("id"), pa.array(map(len, sets), pa.int32()), pa.array(keys, pa.int64()), *longs]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "class", "bands", "bits"])


def spread_join(rows: DataFrame, keys: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """`rows` joined with `keys` (one row a key, `size` rows of `rows` have it) with no task for one heavy key."""
    heavy = F.col("size") >= max(HEAVY_ROWS, total // HEAVY_KEYS)
    few, light = F.broadcast(keys.filter(heavy).drop("size")), keys.filter(~heavy).drop("size")
    return rows.join(few, key).unionByName(rows.join(few, key, "left_anti").join(light, key, how))


def may_link(a: str, b: str) -> Column:
    """Whether sizes and bits of two sets allow a link: of two sets with d shingles in only one, p % are shared by
    both only if d * (100 + p) <= (100 - p) * (their sizes' sum)."""
    n = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = F.least(*n) * 100 >= F.greatest(*n) * PERCENT
    differ = sum((F.bit_count(F.col(f"{a}.bits{i}").bitwiseXOR(F.col(f"{b}.bits{i}"))) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return sizes & (differ * (100 + PERCENT) <= (n[0] + n[1]) * (100 - PERCENT))


def star(members: DataFrame, centres: int, total: int) -> tuple[DataFrame, DataFrame]:
    """Candidate edges of a round, and the members that may have more in a later one.

    `members`: band, size (of the bucket), turn (from 0 to size), class, root, n and bits.  Buckets whose classes are of
    several components stay; their classes with a turn below `centres` are the centres, and leave.
    """
    several = (F.min("root") != F.max("root")).alias("open")
    open_ = members.groupBy("band").agg(several, F.first("size").alias("size")).filter("open").drop("open")
    met = kept(spread_join(members.withColumnRenamed("size", "held"), open_, "band", total).withColumnRenamed("held", "size"), "members")
    heavy = F.col("size") >= max(HEAVY_ROWS, total * centres // HEAVY_KEYS)
    first = met.filter(F.col("turn") < centres)
    edges = []
    for some, side in ((heavy, F.broadcast(first.filter(heavy))), (~heavy, first.filter(~heavy))):
        on = (F.col("x.band") == F.col("y.band")) & (F.col("x.root") != F.col("y.root")) & may_link("x", "y")
        edges.append(met.filter(some).alias("x").join(side.alias("y"), on))
    pair = [F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")]
    return edges[0].select(*pair).unionByName(edges[1].select(*pair)).distinct(), met.filter(F.col("turn") >= centres)


def _confirmed(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidate pairs whose full sets reach the threshold, but for those that the task's other links connect."""
    sets: dict[int, np.ndarray] = {}
    parent: dict[int, int] = {}
    held = 0

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    for rows in sliced(batches, SLICE_BYTES, "text_a", "text_b"):
        if held > KEPT_SETS:
            sets, held = {}, 0
        if len(parent) > DONE_CLASSES:
            parent.clear()
        texts = {}
        for side in "ab":
            for k, t in zip(rows.column(side).to_pylist(), rows.column(f"text_{side}").cast(pa.binary()).to_pylist()):
                if k not in sets:
                    texts[k] = t
        for k, s in zip(texts, shingle_sets(list(texts.values()), words)):
            sets[k] = s
            held += len(s)
        linked = []
        for a, b in zip(rows.column("a").to_pylist(), rows.column("b").to_pylist()):
            x, y, root_a, root_b = sets[a], sets[b], find(a), find(b)
            both = len(np.intersect1d(x, y, assume_unique=True)) if root_a != root_b else 0
            linked.append(root_a != root_b and 100 * both >= PERCENT * (len(x) + len(y) - both))
            if linked[-1]:
                parent[root_b] = root_a
        found = rows.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
        yield pa.RecordBatch.from_arrays(found.columns, names=["u", "v"])


def _of_classes(words: int, bits, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose (class, id) may be wanted."""
    for rows in sliced(batches, SLICE_BYTES, "text"):
        rows = rows.filter(rows.column("id").is_valid())
        keys = np.array([set_key(s) for s in shingle_sets(rows.column("text").cast(pa.binary()).to_pylist(), words)], np.int64)
        at = (keys ^ rows.column("id").to_numpy()) & (FILTER_BITS - 1)
        may = (bits.value[at >> 3] >> (at & 7)) & 1 == 1
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(keys)], names=["id", "text", "class"]).filter(pa.array(may))


def _bit_table(wanted: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, those of the (class, id) set."""
    at = F.col("class").bitwiseXOR(F.col("id")).bitwiseAND(F.lit(FILTER_BITS - 1))
    parts = wanted.groupBy(F.floor(at / BITMAP).alias("part")).agg(F.bitmap_construct_agg(at % BITMAP).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for p in parts:
        out[p.part * BITMAP // 8 :][: BITMAP // 8] = np.frombuffer(p.bits, np.uint8)
    return out


def class_texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """The text of every class in `wanted` (class, id of a row that has it)."""
    bits = docs.sparkSession.sparkContext.broadcast(_bit_table(wanted))
    own = docs.mapInArrow(lambda it: _of_classes(words, bits, it), "id long, text string, class long")
    return own.join(wanted, ["id", "class"], "left_semi").dropDuplicates(["id", "class"]).select("class", "text")


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """For every row: id, n_shingles, component_id (the smallest id reachable by links), kept (the component's first)."""
    plain = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"))
    sketch = kept(plain.mapInArrow(lambda it: _sketched(words, it), SKETCH), "sketch")
    postings = sketch.filter("bands IS NOT NULL").select("class", F.explode("bands").alias("band"))
    buckets = postings.groupBy("band").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("size"))
    shared = kept(buckets.filter("low <> high").select("band", "size"), "buckets")
    total = sketch.filter("bands IS NOT NULL").count() * BANDS
    turn = F.floor(F.xxhash64("class", "band").bitwiseAND(F.lit(TURNS - 1)) * F.col("size") / TURNS)
    members = spread_join(postings, shared.withColumn("held", F.col("size")), "band", total).distinct().withColumnRenamed("held", "size")
    members = kept(members.withColumn("turn", turn), "members")
    bits = [F.col("bits")[i].alias(f"bits{i}") for i in range(SKETCH_BITS // 64)]
    sets = sketch.filter("bands IS NOT NULL").select("class", F.col("n").cast("long").alias("n"), *bits).dropDuplicates(["class"])
    sets = kept(sets.join(members.select("class").distinct(), "class", "left_semi"), "sets")
    roots = kept(sets.select("class", F.col("class").alias("root")), "roots")
    members = members.join(sets, "class").withColumn("root", F.col("class"))
    classes = sketch.filter("n > 0 AND id IS NOT NULL").groupBy("class").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"))
    classes = kept(classes, "classes")
    texts = kept(class_texts(plain, classes.join(roots, "class").select("id", "class"), words), "texts")

    centres = CENTRES
    while True:
        edges, members = star(members, centres, total)
        edges = kept(edges, "candidates")
        centres *= MORE_CENTRES
        if edges.isEmpty():
            if members.isEmpty():
                break
            continue
        for side in "ba":
            edges = edges.join(texts.select(F.col("class").alias(side), F.col("text").alias(f"text_{side}")), side)
        links = edges.select("a", "b", "text_a", "text_b").mapInArrow(lambda it: _confirmed(words, it), "u long, v long")
        # Which links of a cycle a task leaves out depends on its rows' order, so they are written before use.
        links = kept(links, "links")
        if links.isEmpty():
            continue
        of = [roots.select(F.col("class").alias(c), F.col("root").alias(f"root_{c}")) for c in "uv"]
        merged = components(links.join(of[0], "u").join(of[1], "v").select(F.col("root_u").alias("u"), F.col("root_v").alias("v")))
        merged = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
        roots = kept(roots.join(merged, "root", "left").select("class", F.coalesce("to", "root").alias("root")), "roots")
        members = members.drop("root").join(roots, "class")

    rooted = kept(classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")), "rooted")
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").select("class", "component_id", "size")
    out = spread_join(sketch.select("id", "n", "class"), named, "class", total, "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    keep = F.coalesce(F.col("id") == component, F.lit(True))
    return out.select(F.col("id").alias(id_), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), keep.alias("kept"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 1], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS i FROM words WHERE len(ws) > 0)
), sizes AS (
  SELECT doc_id, COUNT(*) AS n FROM grams GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT a, y FROM reach JOIN ways ON b = x
)
SELECT d.doc_id, CAST(COALESCE(MAX(n), 0) AS BIGINT) AS n_shingles, CAST(MIN(b) AS BIGINT) AS component_id, d.doc_id = MIN(b) AS kept
FROM documents d JOIN reach ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""
