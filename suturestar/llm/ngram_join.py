"""Near-duplicate join: Jaccard similarity of word-shingle sets, by adaptive multi-match prefixes.

All sets order their shingles alike: rare ones first, by hash, then those counted as frequent, by count.  If two
sets reach the threshold, they share at least o = ceil(threshold * size) shingles of the larger one, and then any
prefixes of length size - o + m share at least m.  Each document picks its own m from LEVELS: a longer prefix costs
postings but asks for m shared ones before a pair is verified, and m minimises the estimated postings read plus
the estimated candidates (shared postings / m, by Markov's bound) times the price of a verification.  A pair needs
the smaller m of its two documents.

Work per step, none of which lists all pairs of a group:

1. one pass hashes all texts into (id, set size, set key) and the frequent shingles' counts.  Equal sets are one
   class from here on.
2. one pass emits prefix postings of one row of each class; those that no other class has are dropped.
3. rounds: each of a share of the shingles names four leaders among its classes; every other class is verified against the leaders it
   shares enough postings with.  Links merge classes into components (connected components by star operations), and
   classes of one component no longer meet.  So thousands of near copies cost a few verifications each.
4. when rounds no longer pay, all that is left across components is verified.  Shingles list their pairs across
   components if those are at most SMALL / 2 per posting.  Shingles of more (near misses by the thousand) compare
   blocks of BLOCK classes by one matrix product; any pair at the threshold shares a shingle of its shortest prefixes, so
   blocks are needed for those only.  A text goes to each block that it meets, which grows with the square of a shingle's
   classes, so blocks take turns: the disk holds about as many texts as there are.  Nothing is capped: every pair at or above the threshold is verified or
   already connected, hence the components are exact (but for 64-bit hash collisions).

Counts of frequent shingles and the bound on their number (FREQUENT, broadcast) change only the order, never results.

Texts move only where they may be compared: a broadcast bit table of the rows or classes asked for (at most MOST_BITS
bits) drops most others before each shuffle of texts; the join after it is exact, whatever the table lets through.

Null and empty texts have no shingles and are linked with nothing.  A null id gets no component and links nothing.
Ids identify documents: rows that repeat an id are answered each.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.components import components
from suturestar.llm.frames import discard, kept, read
from suturestar.llm.shingles import set_key, shingle_sets

PERCENT = 80
FREQUENT = 1 << 18
WINDOW_SHINGLES = 4 << 20
LEAST_LOCAL = 4
LEVELS = (1, 2, 3, 4, 6, 8)
RARE_LOAD = 0.05
VERIFY_PRICE = 50.0
LEADERS = 4
# Leader rounds only have to merge most of what is alike, so each looks at one in SHARE shingles.
SHARE = 4
SLICE_ROWS = 512
KEPT_SETS = 4 << 20
BITS = 4
SKETCH = "kind byte, id long, n int, key long"
POSTING = "token long, class long, n int, m byte, first boolean, frequent boolean"
SMALL = 32
BLOCK = 1024
# The least texts that a turn of blocks sends.
LEAST_SENT = 1 << 16
COLUMNS = 4096
PAYS = 0.7
# Bits of a table for each value it holds, the most bits of one, and those of one value of bitmap_construct_agg.
BITS_EACH = 32
MOST_BITS = 1 << 26
BITMAP = 1 << 15


def least_overlap(n: int) -> int:
    """How many of n shingles any set at the threshold shares at least."""
    return -(-PERCENT * n // 100)


def _texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


class BitTable:
    """Which values may be in the only column of `wanted`, of at most `count` values: all that are, and few others."""

    def __init__(self, wanted: DataFrame, count: int) -> None:
        self.size = min(MOST_BITS, max(BITMAP, 1 << (BITS_EACH * count - 1).bit_length()))
        at = self.place(wanted.columns[0])
        parts = wanted.groupBy(F.floor(at / BITMAP).alias("part")).agg(F.bitmap_construct_agg(at % BITMAP).alias("bits")).collect()
        table = np.zeros(self.size // 8, np.uint8)
        for p in parts:
            table[p.part * BITMAP // 8 :][: BITMAP // 8] = np.frombuffer(p.bits, np.uint8)
        self.sent = wanted.sparkSession.sparkContext.broadcast(table)

    def place(self, column: str | Column) -> Column:
        return F.xxhash64(column).bitwiseAND(F.lit(self.size - 1))

    def test(self):
        """A function that tells of places whether their bits are set."""
        sent = self.sent

        def may(places: pa.Array) -> pa.Array:
            i = places.to_numpy(zero_copy_only=False)
            return pa.array((sent.value[i >> 3] >> (i & 7)) & 1 == 1)

        return may


def maybe_in(values: DataFrame, count: int, value: Column) -> Column:
    """Whether a value may be in the only column of `values`, which are at most `count`; true for null."""
    bits = BitTable(values, count)
    test = bits.test()

    @F.arrow_udf("boolean")
    def may(places: pa.Array) -> pa.Array:
        return test(places)

    return value.isNull() | may(bits.place(value))


def asked_texts(texts: DataFrame, classes: DataFrame, count: int) -> DataFrame:
    """The texts of the classes, and few others; written, so that no task has a second Python worker for the test."""
    return kept(texts.select("class", "text").filter(maybe_in(classes, count, F.col("class"))), "asked")


# ---------------------------------------------------------------- step 1: sizes, keys, frequent shingles


def repeated(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur `least` times or more, ascending, and how often each does.

    Sorts `values` in place and holds little besides: np.unique takes several arrays of the same length.
    """
    values.sort()
    n = max(0, len(values) - least + 1)
    starts = values[:n] == values[least - 1 :]
    starts[1:] &= values[1:n] != values[: max(0, n - 1)]
    at = np.flatnonzero(starts)
    found = values[at]
    return found, np.searchsorted(values, found, "right") - at


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["kind", "id", "n", "key"]
    window: list[np.ndarray] = []
    keys: set[int] = set()
    held = 0

    def frequent() -> pa.RecordBatch:
        values = np.concatenate(window)
        window.clear()
        token, count = repeated(values, LEAST_LOCAL)
        ones = pa.array(np.ones(len(token), np.int8))
        columns = [ones, pa.nulls(len(token), pa.int64()), pa.array(count.astype(np.int32)), pa.array(token.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in _slices(batches):
        sets = shingle_sets(_texts(batch))
        found = [set_key(s) for s in sets]
        sizes = np.fromiter(map(len, sets), np.int32, len(sets))
        zeros = pa.array(np.zeros(len(sets), np.int8))
        yield pa.RecordBatch.from_arrays([zeros, batch.column("id"), pa.array(sizes), pa.array(found, pa.int64())], names=names)
        for key, s in zip(found, sets):
            if key not in keys:
                keys.add(key)
                window.append(s)
                held += len(s)
        if held >= WINDOW_SHINGLES:
            yield frequent()
            keys, held = set(), 0
    if window:
        yield frequent()


# ---------------------------------------------------------------- step 2: prefixes


def prefix(s: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """A set's prefix in the common order, which of it is frequent, and the matches it asks for."""
    n = len(s)
    at = np.minimum(np.searchsorted(tokens, s), max(0, len(tokens) - 1))
    often = tokens[at] == s if len(tokens) else np.zeros(n, bool)
    load = counts[at] if len(tokens) else np.zeros(n)
    order = np.concatenate((np.flatnonzero(~often), np.flatnonzero(often)[np.lexsort((s[often], load[often]))]))
    need = least_overlap(n)
    longest = n - need + min(need, LEVELS[-1])
    order = order[:longest]
    cost = np.cumsum(1 + np.where(often[order], load[order], RARE_LOAD))
    best = min(
        (m for m in LEVELS if m <= need),
        key=lambda m: cost[n - need + m - 1] + VERIFY_PRICE * (cost[n - need + m - 1] - (n - need + m)) / m,
    )
    order = order[: n - need + best]
    return s[order], often[order], best


def _postings(frequent, may, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, counts = frequent
    done: set[int] = set()
    for batch in _slices(batches):
        batch = batch.filter(may(batch.column("place")))
        token, often, key, n, m, first = [], [], [], [], [], []
        for s in shingle_sets(_texts(batch)):
            k = set_key(s)
            if not len(s) or k in done:
                continue
            if len(done) > 1_000_000:
                done.clear()
            done.add(k)
            t, o, level = prefix(s, tokens, counts)
            token.append(t)
            often.append(o)
            key.append(np.full(len(t), k))
            n.append(np.full(len(t), len(s), np.int32))
            m.append(np.full(len(t), level, np.int8))
            first.append(np.arange(len(t)) <= len(s) - least_overlap(len(s)))
        if token:
            columns = [np.concatenate(x) for x in (token, key, n, m, first, often)]
            columns[0] = columns[0].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "class", "n", "m", "first", "frequent"])


def shared_postings(docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """Prefix postings whose shingle more than one class has in its prefix, each once.

    Of a class's rows only those with its smallest id are asked for, so copies cost no postings.
    """
    spark = docs.sparkSession
    worded = sketch.filter("kind = 0 AND n > 0 AND id IS NOT NULL")
    bits = BitTable(worded.groupBy("key").agg(F.min("id").alias("id")).select("id"), worded.count())
    may = bits.test()
    counts = sketch.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "key").limit(FREQUENT).toPandas()
    tokens, loads = top["key"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.float64)
    order = np.argsort(tokens)
    sent = spark.sparkContext.broadcast((tokens[order], loads[order]))
    asked = docs.filter("id IS NOT NULL").select("text", bits.place("id").alias("place"))
    postings = asked.mapInArrow(lambda it: _postings(sent.value, may, it), POSTING)
    # Frequent shingles are known to be shared; spread by class, they load no task.
    where = F.when(F.col("frequent"), F.xxhash64("token", "class")).otherwise(F.col("token"))
    grouped = postings.withColumn("where", where)
    window = F.expr("min(class) OVER (PARTITION BY where) <> max(class) OVER (PARTITION BY where)")
    # The fewest matches that any class of the shingle asks for; those of frequent shingles are not together, so one.
    fewest = F.expr("IF(frequent, 1Y, min(m) OVER (PARTITION BY where))")
    shared = grouped.withColumn("shared", window).withColumn("fewest", fewest).filter("frequent OR shared")
    # Rows that repeat an id, and few others, have brought a class's postings twice.
    shared = shared.repartition("class").dropDuplicates(["class", "token"])
    # A pair asks for the smaller m of its two classes.  A class with fewer shared postings than any class it shares
    # one with asks for, itself included, can meet nobody.
    needed = F.expr("min(fewest) OVER (PARTITION BY class)")
    held = shared.withColumn("held", F.expr("count(1) OVER (PARTITION BY class)")).withColumn("needed", needed)
    possible = held.filter("held >= needed").select("token", "class", "n", "m", "first")
    return kept(possible, "postings")


# ---------------------------------------------------------------- step 3 and 4: candidates and verification


def _fits(a: Column, b: Column) -> Column:
    """Set sizes that still allow the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _enough(a: Column, b: Column) -> Column:
    return F.count(F.lit(1)) >= F.min(F.least(a, b))


def leader_pairs(postings: DataFrame, turn: int) -> DataFrame:
    """Pairs of a class with a leader of another component: a, b and their components ra, rb.

    `postings` are a share of all, so a share of the matches is asked for.
    """

    def pick(j: int) -> Column:
        order = F.xxhash64("class", F.lit(turn * LEADERS + j))
        best = F.min(F.struct(order.alias("o"), "class", "n", "m", "root"))
        return F.struct(*[best[c].alias(c) for c in ("class", "n", "m", "root")])

    leaders = postings.groupBy("token").agg(
        F.array_distinct(F.array(*[pick(j) for j in range(LEADERS)])).alias("leaders"),
        (F.min("root") != F.max("root")).alias("open"),
    )
    met = postings.join(leaders.filter("open").drop("open"), "token").select("class", "n", "m", "root", F.explode("leaders").alias("to"))
    met = met.filter((F.col("to.root") != F.col("root")) & _fits(F.col("to.n"), F.col("n")))
    pairs = met.groupBy(F.col("to.class").alias("a"), F.col("class").alias("b"), F.col("to.root").alias("ra"), F.col("root").alias("rb"))
    enough = F.count(F.lit(1)) * SHARE >= F.min(F.least("to.m", "m"))
    return pairs.agg(enough.alias("enough")).filter("enough").drop("enough")


def open_postings(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings of shingles that still join components, with the component (`top`) that most of a shingle's classes
    are in: those with at most SMALL / 2 pairs across components per posting, and those with more."""
    per_root = postings.groupBy("token", "root").agg(F.count(F.lit(1)).cast("double").alias("c"))
    per_token = per_root.groupBy("token").agg(
        F.sum("c").alias("k"),
        ((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2).alias("across"),
        F.max(F.struct("c", "root"))["root"].alias("top"),
    )
    both = kept(postings.join(per_token.filter("across > 0"), "token"), "open")
    few = F.col("across") <= F.col("k") * SMALL / 2
    return both.filter(few), both.filter(~few)


def pairs_left(few: DataFrame, many: DataFrame) -> DataFrame:
    """Every pair of classes of different components that may reach the threshold by shingles of few such pairs.

    Of the matches a pair needs, as many as either class has postings of the other kind may lie there; one shared
    shingle of the shortest prefixes must be here, or blocks find the pair.  Of two classes of different components
    one is outside the shingle's largest component, so only such classes look for partners.
    """
    elsewhere = many.groupBy("class").agg(F.count(F.lit(1)).cast("int").alias("e"))
    few = few.join(elsewhere, "class", "left").withColumn("m", F.greatest(F.lit(1), F.col("m") - F.coalesce("e", F.lit(0))))
    x, y = (
        df.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("class", "n", "m", "root", "first", "top")])
        for side, df in (("x", few.filter("root <> top")), ("y", few))
    )
    once = (F.col("y_root") == F.col("y_top")) | (F.col("x_class") < F.col("y_class"))
    met = x.join(y, "token").filter((F.col("x_root") != F.col("y_root")) & once & _fits(F.col("x_n"), F.col("y_n")))
    # The class with the smaller key first, so that a pair is one group.
    swap = F.col("x_class") > F.col("y_class")
    a, b, ra, rb = (F.when(swap, F.col(v)).otherwise(F.col(u)) for u, v in (("x_class", "y_class"), ("y_class", "x_class"), ("x_root", "y_root"), ("y_root", "x_root")))
    pairs = met.groupBy(a.alias("a"), b.alias("b"), ra.alias("ra"), rb.alias("rb"))
    possible = _enough(F.col("x_m"), F.col("y_m")) & F.bool_or(F.col("x_first") & F.col("y_first"))
    return pairs.agg(possible.alias("possible")).filter("possible").drop("possible")


def _spanning(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect the same nodes without a cycle."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            x = above[x]
        return x

    out = []
    for u, v in pairs.tolist():
        a, b = top(u), top(v)
        if a != b:
            above[max(a, b)] = min(a, b)
            out.append((a, b))
    return out


def _block(group: pa.Table) -> pa.Table:
    """Links between the classes of two blocks, or within one, from the overlaps of all of them at once."""
    sets = shingle_sets(_texts(group))
    sizes, roots = np.fromiter(map(len, sets), np.int64, len(sets)), group["root"].to_numpy()
    block, low, high = group["block"].to_numpy(), group["low"][0].as_py(), group["high"][0].as_py()
    x, y = np.flatnonzero(block == low), np.flatnonzero(block == high)
    token, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only shingles of two classes add to an overlap.
    number = np.cumsum(count > 1) - 1
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = count[column] > 1
    row, column = row[shared], number[column[shared]]
    overlap = np.zeros((len(x), len(y)), np.float32)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        here = (column >= at) & (column < at + COLUMNS)
        dense = np.zeros((len(sets), COLUMNS), np.float32)
        dense[row[here], column[here] - at] = 1
        overlap += dense[x] @ dense[y].T
    union = sizes[x][:, None] + sizes[y][None, :] - overlap
    linked = (100 * overlap >= PERCENT * union) & (roots[x][:, None] != roots[y][None, :])
    i, j = np.nonzero(linked)
    found = _spanning(np.unique(np.stack((roots[x[i]], roots[y[j]]), 1), axis=0)) if len(i) else []
    return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})


def block_links(many: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges between components that classes of the many-class shingles link, written.

    Pairs of blocks take turns, each of which sends about as many texts as there are.
    """
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    own = many.filter("first").select("token", "class", "root", blocks.alias("blocks"))
    own = own.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    sent = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = sent.select("token", "class", "root", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    held, copies = own.agg(F.count(F.lit(1)), F.sum("blocks")).first()
    asked = asked_texts(texts, own.select("class"), held)
    turns = max(1, -(-(copies or 0) // max(LEAST_SENT, texts.count())))
    turn, edges = F.pmod(F.xxhash64("token", "low", "high"), F.lit(turns)), []
    for t in range(turns):
        rows = sent.filter(turn == t).join(asked, "class").select("token", "low", "high", "block", "root", "text")
        edges.append(kept(rows.groupBy("token", "low", "high").applyInArrow(_block, "u long, v long"), "links"))
    discard(asked)
    return reduce(DataFrame.unionByName, edges)


def _pairs_across(postings: DataFrame) -> float:
    """How many pairs of classes of different components meet in postings."""
    per_root = postings.groupBy("token", "root").agg(F.count(F.lit(1)).cast("double").alias("c"))
    per_token = per_root.groupBy("token").agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("own"))
    return per_token.agg(F.sum((F.col("all") * F.col("all") - F.col("own")) / 2)).first()[0] or 0.0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets reach the threshold."""
    sets: dict[int, np.ndarray] = {}
    held = 0
    for batch in batches:
        for rows in _slices([batch]):
            if held > KEPT_SETS:
                sets, held = {}, 0
            texts = {}
            for key, text in (("a", "text_a"), ("b", "text_b")):
                for k, t in zip(rows.column(key).to_pylist(), _texts(rows, text)):
                    if k not in sets:
                        texts[k] = t
            for k, s in zip(texts, shingle_sets(list(texts.values()))):
                sets[k] = s
                held += len(s)
            a, b = rows.column("a").to_pylist(), rows.column("b").to_pylist()
            keep = []
            for i, j in zip(a, b):
                x, y = sets[i], sets[j]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            found = rows.select(["ra", "rb"]).filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(found.columns, names=["u", "v"])


def bitmap(s: np.ndarray) -> bytes:
    """A set as bits, about BITS per shingle in a power of two, so that a larger one folds onto a smaller one."""
    size = max(64, 1 << (BITS * len(s) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(s & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_overlap(n: int, x: np.ndarray, y: np.ndarray) -> int:
    """No more of n shingles with the bits x can be in a set with the bits y: each bit that only x has stands for one
    at least that is not."""
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(b.reshape(-1, size), axis=0) for b in (x, y))
    return n - int(np.bitwise_count(x & ~y).sum())


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bits leave room for the threshold."""
    for batch in batches:
        keep = []
        for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))):
            x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            most = min(most_overlap(n, x, y), most_overlap(m, y, x))
            keep.append(100 * most >= PERCENT * (n + m - most))
        yield batch.select(["a", "b", "ra", "rb"]).filter(pa.array(keep, pa.bool_()))


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class, whose text has the class's set key: ids may repeat, also with other texts.

    A class has one id, and the rows of an id are in one partition, mostly next to each other.
    """
    last = None
    for batch in _slices(batches):
        keep, sets = [], shingle_sets(_texts(batch))
        for s, c in zip(sets, batch.column("class").to_pylist()):
            keep.append(c != last and set_key(s) == c)
            last = c if keep[-1] else last
        more = [pa.array(map(len, sets), pa.int32()), pa.array(map(bitmap, sets), pa.binary())]
        rows = pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "n", "bits"])
        yield rows.filter(pa.array(keep, pa.bool_()))


def links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges u, v between the components of verified pairs, written: bitmaps refuse most others before texts move."""

    def with_both(pairs: DataFrame, texts: DataFrame, *columns: str) -> DataFrame:
        for side in "ba":
            other = texts.select(F.col("class").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
            pairs = pairs.join(other, side)
        return pairs.select("a", "b", "ra", "rb", *[f"{c}_{side}" for c in columns for side in "ab"])

    near = kept(with_both(pairs, texts, "n", "bits").mapInArrow(_possible, "a long, b long, ra long, rb long"), "near")
    asked = near.select(F.explode(F.array("a", "b")).alias("class"))
    asked = asked_texts(texts, asked, 2 * near.count())
    found = kept(with_both(near, asked, "text").mapInArrow(_verify, "u long, v long"), "links")
    discard(near, asked)
    return found


def _keyed(may, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        batch = batch.filter(may(batch.column("place"))).select(["id", "text"])
        keys = pa.array(map(set_key, shingle_sets(_texts(batch))), pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=["id", "text", "class"])


def class_key(text: Column) -> Column:
    """The key of a text's shingle set, which equal sets share; 0 without words.

    Spark knows it as never null: a join on it would else test that first, by a second evaluation in another Python
    worker of the task.
    """

    @F.arrow_udf("long")
    def key(texts: pa.Array) -> pa.Array:
        rows = pa.RecordBatch.from_arrays([texts], names=["text"])
        return pa.array([set_key(s) for part in _slices([rows]) for s in shingle_sets(_texts(part))], pa.int64())

    return F.coalesce(key(text), F.lit(0))


def _connected(docs: DataFrame, id_: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Every row's id, n and class; and every class with words, its smallest id and its component's root.

    What else is written on the way is removed.
    """
    plain = docs.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text"))
    sketch = kept(plain.mapInArrow(_sketch, SKETCH), "shingles")
    sets = sketch.filter("kind = 0").select("id", "n", F.col("key").alias("class"))
    classes = sets.filter("n > 0 AND id IS NOT NULL").groupBy("class").agg(F.min("id").alias("id"))
    postings = shared_postings(plain, sketch)
    roots = kept(postings.select("class").distinct().withColumn("root", F.col("class")), "roots")
    wanted = classes.join(roots, "class").select("id", "class")
    # By id and class: a repeated id may have many of both.
    bits = BitTable(wanted.select("id"), roots.count())
    may = bits.test()
    own = plain.withColumn("place", bits.place("id")).mapInArrow(lambda it: _keyed(may, it), "id long, text string, class long")
    # Shuffled also where `wanted` could be broadcast: that brings the rows of an id together, and a task that both
    # keys rows and takes each class's own would hold two Python workers.
    own = own.join(wanted.hint("merge"), ["id", "class"])
    texts = kept(own.select("class", "text").mapInArrow(_own_text, "class long, text string, n int, bits binary"), "texts")

    def merge(edges: DataFrame) -> bool:
        """Merge components along the edges; whether there were any."""
        nonlocal roots
        stars = components(edges)
        found = kept(stars, "merged").select(F.col("node").alias("root"), F.col("root").alias("to"))
        discard(stars, edges)
        if found.isEmpty():
            return False
        moved, last = roots.join(found, "root", "left"), roots
        roots = kept(moved.select("class", F.coalesce("to", "root").alias("root")), "roots")
        discard(found, last)
        return True

    def share(turn: int) -> DataFrame:
        """Every SHARE-th shingle's postings, other ones in each round, with the classes' components."""
        return postings.filter(F.pmod(F.xxhash64("token", F.lit(turn)), F.lit(SHARE)) == 0).join(roots, "class")

    total, turn, across = postings.count(), 0, SHARE * _pairs_across(share(0))
    while across > max(total, 10_000):
        pairs = kept(leader_pairs(share(turn), turn), "pairs")
        merged = merge(links(pairs, texts))
        discard(pairs)
        before, across, turn = across, SHARE * _pairs_across(share(turn)), turn + 1
        if not merged or across > PAYS * before:
            break
    few, many = open_postings(postings.join(roots, "class"))
    discard(postings)
    pairs = kept(pairs_left(few, many), "pairs")
    merge(links(pairs, texts).unionByName(block_links(many, texts)))
    discard(few, pairs, texts)

    return sets, classes.join(roots, "class", "left").select("class", "id", F.coalesce("root", "class").alias("root"))


def first_classes(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """For every component the smallest id and, of its classes with that id, the one with the smallest key; and the ids
    that this leaves in doubt: those of several rows with words, or of none that is first.  Both are written.
    """
    sets, reached = _connected(docs, id_, text)
    best = reached.groupBy("root").agg(F.min(F.struct("id", "class")).alias("best"))
    firsts = kept(best.select(F.col("best.id").alias("id"), F.col("best.class").alias("class")), "firsts")
    rows = sets.filter("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    named = firsts.select("id", F.lit(True).alias("first")).distinct()
    doubtful = kept(rows.join(named, "id", "left").filter("rows > 1 OR first IS NULL").select("id"), "doubtful")
    discard(sets, reached)
    return firsts.withColumnRenamed("id", id_), doubtful


def near_duplicates(docs: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: id, n_shingles, component_id (the smallest id reachable by links)."""
    sets, reached = _connected(docs, id_, text)
    least = reached.groupBy("root").agg(F.min("id").alias("component_id"))
    named = reached.join(least, "root").select("class", "component_id")
    out = sets.join(named, "class", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_), F.col("n").cast("long").alias("n_shingles"), component.cast("long").alias("component_id"))


def op3_adaptive_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), places AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM places
), sizes AS (
  SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT a, y FROM reach JOIN ways ON b = x
)
SELECT d.doc_id, CAST(COALESCE(MAX(n), 0) AS BIGINT) AS n_shingles, CAST(MIN(b) AS BIGINT) AS component_id
FROM documents d JOIN reach ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""
