"""Token counts that follow edits, from a segment tree over each document's pre-tokens.

A document is cut into pre-tokens (the vocabulary's split pattern) and these into leaves of LEAF pre-tokens.  A leaf
knows its text, its pre-tokens' ends and its token count; the tree above holds sums of characters and tokens.  An edit
(replace `n_del` characters at `pos` by `ins`) descends by character sums to the pre-tokens it touches, steps back
far enough for the pattern's look-ahead, and cuts again from there until a cut falls on an old boundary behind the
edit; from that point on the old pre-tokens are what a full cut would give, as the pattern looks at nothing before
its start.  Only the pre-tokens in between are encoded, the touched leaves are refilled and the sums above them
are updated.  Leaves that grow past twice LEAF make the tree anew from its leaves, at a cost spread over the edits that filled them.

Edits of a document apply in ascending `seq`, each to the text the earlier ones left; positions count code points and
are clipped to the text.  Null or negative numbers count as 0, a null insertion as empty.  Edits with a null document
id, or of a document that is not there, are ignored; of rows that repeat an id each gets all edits of that id.  Null
texts count as empty.  Columns of the inputs other than the named ones are ignored.

Documents and their edits meet by one shuffle, sorted by (id, row, seq), and stream through one tree at a time, so a
document with any number of edits needs memory for its own text only (rows that repeat an id are held together).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.frames import read

LEAF = 64
# How far the pattern looks beyond a match: an apostrophe and two letters.
LOOK_AHEAD = 3
KEPT_WORDS = 300_000
COUNTS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens_before", pa.int64()), ("n_tokens", pa.int64()), ("n_edits", pa.int64()), ("n_encoded", pa.int64())]
)
OUT = "doc_id long, n_chars long, n_tokens_before long, n_tokens long, n_edits long, n_encoded long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Counter:
    """Cuts text into pre-tokens and counts the tokens of each."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks
        self.cut = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def tokens(self, words: list[str]) -> int:
        """Tokens of the pre-tokens together."""
        known, total = self.known, 0
        for w in words:
            n = known.get(w)
            if n is None:
                raw = w.encode("utf-8", "replace")
                n = 1 if raw in self.ranks else len(self.encoding._encode_single_piece(raw))
                if len(w) < 64:
                    if len(known) > KEPT_WORDS:
                        known.clear()
                    known[w] = n
            total += n
        return total


@cache
def counter(path: str) -> Counter:
    return Counter(path)


class Leaf:
    __slots__ = ("text", "ends", "tokens")

    def __init__(self, c: Counter, words: list[str]):
        self.text = "".join(words)
        self.ends, at = [], 0
        for w in words:
            at += len(w)
            self.ends.append(at)
        self.tokens = c.tokens(words)

    def words(self) -> list[str]:
        return [self.text[a:b] for a, b in zip([0, *self.ends], self.ends)]


class Tree:
    """A document's pre-tokens below a tree of sums."""

    def __init__(self, c: Counter, text: str):
        self.c = c
        self.encoded = 0
        words = c.cut.findall(text)
        self._build([self._leaf(words[i : i + LEAF]) for i in range(0, len(words), LEAF)])
        self.encoded = 0

    def _leaf(self, words: list[str]) -> Leaf:
        self.encoded += len(words)
        return Leaf(self.c, words)

    def _build(self, leaves: list[Leaf]) -> None:
        self.leaves = leaves or [Leaf(self.c, [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = len(leaf.text), leaf.tokens
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _put(self, at: int, leaf: Leaf) -> None:
        self.leaves[at] = leaf
        i = self.size + at
        self.chars[i], self.tokens[i] = len(leaf.text), leaf.tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def n_chars(self) -> int:
        return self.chars[1]

    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(leaf.text for leaf in self.leaves)

    def _find(self, pos: int) -> tuple[int, int]:
        """The leaf that holds a character, the last one for the end, and the characters before that leaf."""
        i, before = 1, 0
        while i < self.size:
            i *= 2
            if pos - before >= self.chars[i] and self.chars[i + 1]:
                before += self.chars[i]
                i += 1
        return min(i - self.size, len(self.leaves) - 1), before

    def edit(self, pos: int, n_del: int, ins: str) -> None:
        total = self.n_chars()
        pos = min(max(pos, 0), total)
        end = min(pos + max(n_del, 0), total)
        # Back to a boundary before anything whose match looked at the edited place.
        first, before = self._find(max(0, pos - LOOK_AHEAD - 1))
        leaf = self.leaves[first]
        at = bisect_right(leaf.ends, max(0, pos - LOOK_AHEAD - 1) - before)
        start = leaf.ends[at - 1] if at else 0
        head = leaf.words()[:at]
        # Text from there on: as many leaves as the edit covers, then more while the cut has not met an old boundary.
        last, last_before = self._find(max(end - 1, 0)) if end > before + len(leaf.text) else (first, before)
        old = "".join(x.text for x in self.leaves[first : last + 1])
        shift = len(ins) - (end - pos)
        text = old[start : pos - before] + ins + old[end - before :]
        while True:
            words, tail = self._recut(text, first, before, start, last, end, shift)
            if words is not None:
                break
            last += 1
            text += self.leaves[last].text
        words = head + words + tail
        self.encoded += len(words) - len(head) - len(tail)
        if len(words) > 2 * LEAF * (last - first + 1):
            pieces = [Leaf(self.c, words[i : i + LEAF]) for i in range(0, len(words), LEAF)]
            self._build(self.leaves[:first] + pieces + self.leaves[last + 1 :])
            return
        n = last - first + 1
        for k in range(n):
            share = words[k * len(words) // n : (k + 1) * len(words) // n]
            self._put(first + k, Leaf(self.c, share))

    def _recut(self, text: str, first: int, before: int, start: int, last: int, end: int, shift: int):
        """New pre-tokens up to an old boundary behind the edit, and the old ones after it in the touched leaves.

        None if the text at hand ends before such a boundary can be told and more leaves follow.
        """
        bounds: dict[int, tuple[int, int]] = {}
        offset = before
        for k in range(first, last + 1):
            for j, e in enumerate([0, *self.leaves[k].ends[:-1]] if self.leaves[k].ends else []):
                if offset + e >= end:
                    bounds[offset + e + shift - before - start] = (k, j)
            offset += len(self.leaves[k].text)
        more = any(self.chars[self.size + k] for k in range(last + 1, len(self.leaves)))
        words, at = [], 0
        while at < len(text):
            if at in bounds:
                k, j = bounds[at]
                tail = self.leaves[k].words()[j:]
                for x in self.leaves[k + 1 : last + 1]:
                    tail += x.words()
                return words, tail
            m = self.c.cut.match(text, at)
            # Near the end of what is at hand a match could go on or look ahead into the next leaf.
            if more and m.end() + LOOK_AHEAD >= len(text):
                return None, None
            words.append(m.group())
            at = m.end()
        return words, []


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = counter(path)
    rows: list[tuple] = []
    trees: list[Tree] = []
    state = {"id": None, "edits": 0, "before": []}

    def close() -> None:
        for tree, n in zip(trees, state["before"]):
            rows.append((state["id"], tree.n_chars(), n, tree.n_tokens(), state["edits"], tree.encoded))
        trees.clear()
        state["before"], state["edits"] = [], 0

    for batch in batches:
        for id_, kind, text, pos, n_del in zip(*(batch.column(x).to_pylist() for x in ("id", "kind", "text", "pos", "n_del"))):
            if id_ is None or id_ != state["id"] or (kind == 0 and state["edits"]):
                close()
                state["id"] = id_
            if kind == 0:
                trees.append(Tree(c, text or ""))
                state["before"].append(trees[-1].n_tokens())
            else:
                state["edits"] += 1
                for tree in trees:
                    tree.edit(pos or 0, n_del or 0, text or "")
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=COUNTS)
            rows.clear()
    close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], schema=COUNTS)


def counts_after_edits(docs: DataFrame, edits: DataFrame, vocabulary: str | None = None, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its characters and tokens after all edits, its tokens before, the number of edits, and how many
    pre-tokens the edits had encoded.  Edits have the columns doc_id, seq, pos, n_del, ins."""
    path = vocabulary or default_vocabulary()
    none = F.lit(None).cast("int")
    originals = docs.select(
        F.col(id_).cast("long").alias("id"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("seq"), F.col(text).alias("text"), none.alias("pos"), none.alias("n_del")
    )
    changes = edits.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"), F.lit(1).alias("kind"), F.col("seq").cast("long").alias("seq"), F.col("ins").alias("text"), F.col("pos").cast("int"), F.col("n_del").cast("int")
    )
    together = originals.unionByName(changes).repartition("id").sortWithinPartitions("id", "kind", "seq")
    return together.drop("seq").mapInArrow(lambda it: _count(path, it), OUT)


def revision(docs: DataFrame) -> DataFrame:
    """A revision of every document: a passage near the middle rewritten from its own words, a note put in front, the
    last characters cut off, and a line moved in behind the first quarter."""
    n = F.coalesce(F.length("text"), F.lit(0))
    spot = F.pmod(F.xxhash64("doc_id"), F.greatest(n, F.lit(1)).cast("long")).cast("int")
    text = F.coalesce(F.col("text"), F.lit(""))
    edits = F.array(
        F.struct(F.lit(1).alias("seq"), spot.alias("pos"), F.lit(40).alias("n_del"), F.reverse(F.substring(text, spot, F.lit(60))).alias("ins")),
        F.struct(F.lit(2).alias("seq"), F.lit(0).alias("pos"), F.lit(0).alias("n_del"), F.lit("Revised: don't cite. ").alias("ins")),
        F.struct(F.lit(3).alias("seq"), F.greatest(n - 10, F.lit(0)).alias("pos"), F.lit(200).alias("n_del"), F.lit("").alias("ins")),
        F.struct(F.lit(4).alias("seq"), (n / 4).cast("int").alias("pos"), F.lit(1).alias("n_del"), F.concat(F.lit("\n"), F.substring(text, F.lit(1), F.lit(80)), F.lit("\n\n")).alias("ins")),
    )
    return docs.select("doc_id", F.inline(edits))


def op4_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return counts_after_edits(docs, revision(docs))
