"""Benchmark decontamination: a BM25 index of test items, searched by every training passage with block-max WAND.

Passages are overlapping windows of twice the longest item's words, half a window apart, so that any copy of an item
lies inside one.  A passage's score for an item is the BM25 sum over the words they share, divided by what the item
scores against itself; block-max WAND retrieves every item at or above RETRIEVE.  A hit is a leak if the passage
also holds OVERLAP of the word triples of the item's question and of its answer.

An item's question ends with its last question mark; without one its last sentence is the answer, and of a single
sentence the last quarter of the words.  Items of fewer than SURE_WORDS words must be there in full.

Word statistics cover all items.  Items are indexed in blocks of about BLOCK_BYTES of text, which bounds what is
broadcast; documents are searched where they lie, nothing is shuffled.  Null or empty items cannot leak; null or
empty texts hold none.  Repeated rows are searched each; columns named like an output column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.bpe import gathered
from suturestar.llm.frames import fresh, kept, read

K1, B = 1.2, 0.75
RETRIEVE = 0.6
OVERLAP = 0.7
SURE_WORDS = 8
BLOCK_BYTES = 16 << 20
SLACK = 0.5
EPSILON = 1e-9
POSTINGS_PER_BLOCK = 16
LEAK = "array<struct<item_id:bigint,score:double,question:double,answer:double>>"
WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words of an item's two parts; the second is empty if nothing follows the question."""
    if "?" in text:
        at = text.rindex("?") + 1
        if words(text[:at]):
            return words(text[:at]), words(text[at:])
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if words(s)]
    if len(sentences) > 1:
        return words(" ".join(sentences[:-1])), words(sentences[-1])
    all_ = words(text)
    cut = len(all_) - len(all_) // 4
    return all_[:cut], all_[cut:]


def triples(ws: list[str]) -> set:
    n = min(3, len(ws))
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if ws else set()


def _share(part: list[str], passage: list[str]) -> float:
    """The share of a part's word triples that a passage holds."""
    grams = triples(part)
    if not grams:
        return 1.0
    n = min(3, len(part))
    held = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
    return len(grams & held) / len(grams)


class _Zero(dict):
    def __missing__(self, _word: str) -> int:
        return 0


class Index:
    """Inverted index of a block of items.  Impacts are divided by the item's threshold: 1 is enough."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], n_items: int, mean_length: float):
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        found = [words(t) for _, t in items]
        self.reach = max([8, *map(len, found)])
        self.sure = [len(w) < SURE_WORDS for w in found]
        self.term = _Zero()
        entries: dict[int, list[tuple[int, float]]] = {}
        self.threshold = []
        for number, ws in enumerate(found):
            norm = K1 * (1 - B + B * len(ws) / mean_length)
            impact = {
                w: math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (K1 + 1) / (n + norm)
                for w, n in Counter(ws).items()
            }
            threshold = RETRIEVE * sum(impact.values())
            self.threshold.append(threshold)
            for w, x in impact.items():
                t = self.term.get(w)
                if t is None:
                    t = self.term[w] = len(self.term) + 1
                entries.setdefault(t, []).append((number, x / threshold))
        size = POSTINGS_PER_BLOCK
        self.items = [[]] + [[i for i, _ in entries[t]] for t in range(1, len(entries) + 1)]
        self.impacts = [[]] + [[x for _, x in entries[t]] for t in range(1, len(entries) + 1)]
        self.block_max = [[max(xs[k : k + size]) for k in range(0, len(xs), size)] for xs in self.impacts]
        self.most = np.array([max(xs, default=0.0) for xs in self.impacts])
        self._keep_essential()

    def _keep_essential(self) -> None:
        """By term: the items for which it is not among the weakest words, with the share it gives of what is needed."""
        per_item: list[list[tuple[float, int]]] = [[] for _ in self.ids]
        for t, (items, impacts) in enumerate(zip(self.items, self.impacts)):
            for i, x in zip(items, impacts):
                per_item[i].append((x, t))
        essential: list[list[tuple[int, float]]] = [[] for _ in self.items]
        for i, xs in enumerate(per_item):
            weak = 0.0
            for x, t in sorted(xs):
                if weak + x <= SLACK:
                    weak += x
                else:
                    essential[t].append((i, x))
            for t in {t for _, t in xs}:
                if essential[t] and essential[t][-1][0] == i:
                    essential[t][-1] = (i, essential[t][-1][1] / (1 - weak))
        self.essential = np.concatenate(([0], np.cumsum([len(e) for e in essential])))
        self.essential_item = np.array([i for e in essential for i, _ in e], np.int64)
        self.essential_share = np.array([x for e in essential for _, x in e], np.float64)

    def _open(self, ids: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Numbers of the windows in which some item's essential words may suffice.

        Window w covers the stretches w and w + 1 of `reach` words each; a word counts once per window.
        """
        before = np.full(len(ids), -len(ids) - 1)
        order = known[np.argsort(ids[known], kind="stable")]
        same = ids[order[1:]] == ids[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        at = known[self.essential[ids[known] + 1] > self.essential[ids[known]]]
        stretch = at // self.reach
        last = max(0, -(-len(ids) // self.reach) - 2)
        windows = []
        for w in (stretch, stretch - 1):
            fits = (w >= 0) & (w <= last) & (before[at] < w * self.reach)
            windows.append((w[fits], ids[at[fits]]))
        window, term = (np.concatenate(x) for x in zip(*windows))
        if not len(window):
            return window
        share, ends = gathered(self.essential_share, self.essential, term)
        item, _ = gathered(self.essential_item, self.essential, term)
        key = np.repeat(window, np.diff(ends)) * len(self.ids) + item
        order = np.argsort(key)
        key, share = key[order], share[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        enough = np.add.reduceat(share, first) >= 1 - EPSILON
        return np.unique(key[first[enough]] // len(self.ids))

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items whose score reaches 1, by block-max WAND."""
        end, size = len(self.ids), POSTINGS_PER_BLOCK
        lists = [(self.items[t], self.impacts[t], self.block_max[t], float(self.most[t])) for t in terms]
        at = [0] * len(lists)
        order = sorted(range(len(lists)), key=lambda k: lists[k][0][0])
        out = []

        def here(k: int) -> int:
            items = lists[k][0]
            return items[at[k]] if at[k] < len(items) else end

        def move(k: int, to: int) -> None:
            items, i = lists[k][0], at[k]
            while i < len(items) and items[i] < to:
                # Blocks that end before the target are skipped whole.
                last = min(len(items), (i // size + 1) * size)
                i = last if items[last - 1] < to else i + 1
            at[k] = i

        while True:
            bound, pivot = 0.0, -1
            for n, k in enumerate(order):
                if here(k) >= end:
                    break
                bound += lists[k][3]
                if bound >= 1 - EPSILON:
                    pivot = n
                    break
            if pivot < 0:
                return out
            item = here(order[pivot])
            while pivot + 1 < len(order) and here(order[pivot + 1]) == item:
                pivot += 1
            front = order[: pivot + 1]
            block, until = 0.0, end
            for k in front:
                move_to = at[k]
                items = lists[k][0]
                # The block in which the pivot item would lie.
                while items[min(len(items), (move_to // size + 1) * size) - 1] < item and (move_to // size + 1) * size < len(items):
                    move_to = (move_to // size + 1) * size
                block += lists[k][2][move_to // size]
                until = min(until, items[min(len(items), (move_to // size + 1) * size) - 1] + 1)
            if block >= 1 - EPSILON:
                score = 0.0
                for k in front:
                    move(k, item)
                    if here(k) == item:
                        score += lists[k][1][at[k]]
                        at[k] += 1
                if score >= 1 - EPSILON:
                    out.append((item, score))
            else:
                beyond = here(order[pivot + 1]) if pivot + 1 < len(order) else end
                to = min(max(until, item + 1), max(beyond, item + 1))
                for k in front:
                    move(k, to)
            order.sort(key=here)

    def leaks(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """Items that leak into a text: id, BM25 score relative to the item's own, question and answer overlap."""
        ws = words(text)
        if not ws or not self.ids:
            return []
        ids = np.fromiter(map(self.term.__getitem__, ws), np.int32, len(ws))
        known = np.flatnonzero(ids)
        if not len(known):
            return []
        width = 2 * self.reach
        found: dict[int, tuple[float, float, float]] = {}
        for s in (self._open(ids, known) * self.reach).tolist():
            terms = np.unique(ids[s : s + width])
            for item, score in self.wand(terms[terms > 0].tolist()):
                passage = ws[s : s + width]
                q, a = (_share(part, passage) for part in self.parts[item])
                need = 1.0 if self.sure[item] else OVERLAP
                if q >= need and a >= need:
                    # Relative to the item's score against itself.
                    found[item] = max(found.get(item, (0.0, 0.0, 0.0)), (score * RETRIEVE, q, a))
        return [(self.ids[i], *x) for i, x in sorted(found.items())]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [words(t) for t in batch.column("text").to_pylist()]
        columns = [batch.column("block"), pa.array([sorted(set(w)) for w in found], pa.list_(pa.string())), pa.array(list(map(len, found)), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["block", "words", "length"])


def indexes(benchmark: DataFrame, id_: str = "item_id", text: str = "text") -> list[Index]:
    """One index per block of items."""
    items = benchmark.select(F.col(id_).cast("long").alias("id"), F.col(text).alias("text")).filter(F.length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = size // BLOCK_BYTES + 1
    items = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)).cast("int"))
    per_item = kept(items.select("block", "text").mapInArrow(_item_words, "block int, words array<string>, length long"), "items").filter("length > 0")
    whole = per_item.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).first()
    if not whole.n:
        return []
    frequency = per_item.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    out = []
    for b in range(n_blocks):
        # A block's items and words are at most about BLOCK_BYTES each.
        own = per_item.filter(F.col("block") == b).select(F.explode("words").alias("word")).distinct()
        counts = {r.word: r.n for r in frequency.join(own, "word").toLocalIterator()}
        rows = sorted((r.id, r.text) for r in items.filter((F.col("block") == b) & F.col("id").isNotNull()).toLocalIterator())
        rows = [r for r in rows if words(r[1])]
        if rows:
            out.append(Index(rows, counts, whole.n, whole.mean))
    return out


def leaks(spark: SparkSession, text: Column, blocks: list[Index]) -> Column:
    """The items that leak into a text, over all blocks."""

    def one(index: Index) -> Column:
        sent = spark.sparkContext.broadcast(index)

        @F.arrow_udf(LEAK)
        def search(texts: pa.Array) -> pa.Array:
            rows = [[dict(zip(("item_id", "score", "question", "answer"), x)) for x in sent.value.leaks(t)] for t in texts.to_pylist()]
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))
            return pa.array(rows, kind)

        return search(text)

    return F.concat(*map(one, blocks)) if blocks else F.array().cast(LEAK)


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "leaks") -> DataFrame:
    """All rows with an array of the items that leak into their text."""
    return docs.withColumn(out, leaks(docs.sparkSession, F.col(text), indexes(benchmark)))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows into which no item leaks."""
    found = fresh("leaks")
    return with_leaks(docs, benchmark, text, found).filter(F.size(found) == 0).drop(found)


def op1_wand_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_leaks(docs, read(spark, sf_dir, "benchmark")).select("doc_id", F.explode_outer("leaks").alias("leak"))
    return found.filter(F.col("leak").isNotNull()).select(
        "doc_id",
        "leak.item_id",
        F.round("leak.score", 6).alias("score"),
        F.round("leak.question", 6).alias("question_overlap"),
        F.round("leak.answer", 6).alias("answer_overlap"),
    )
