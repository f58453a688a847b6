"""Byte-pair encoding by a pair occurrence index.

The words of a slice of a partition (at most SLICE bytes of text) are laid out once each as linked lists of
symbols.  An index maps every adjacent pair that has a merge rank to all its positions.  Ranks that occur are
applied in ascending order, each to all its positions at once; a merge removes two old pairs beside it and enters
two new ones into their lists.  A new pair uses the symbol just made and therefore ranks behind the merge that
made it (every merge of a vocabulary makes a symbol of its own, which `Vocabulary` checks), so the ascending order
equals the merge order within each word.

Text is cut into words as the vocabulary's file says: special tokens first, on the raw text; then NFC, white
space, lower case, and the split pattern.  None of these looks across white space, so a piece between white space
is cut and encoded once per slice, and a bounded table of pieces is kept between slices.

Nulls are encoded as the empty text: no ids.  Every row is encoded for itself; no column but the text is read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from suturestar.llm.frames import read, sliced

SLICE = 8 << 20
KEPT_PIECES = 400_000
SMALL_SLICE = 2 << 20
SMALL_PIECES = 100_000
SMALL_LETTERS = 8 << 20
NAMES = 1 << 18
_ENCODED = [StructField("ids", BinaryType()), StructField("n_tokens", LongType()), StructField("decoded", StringType())]
# White space as the normaliser of the vocabulary has it, as ranges (fixed values).
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
# The last letter whose class all Unicode versions in use agree on.
LATIN = "\u024f"
# Control characters that str.split takes for white space but the normaliser does not.
NO_SPACE = re.compile("[\x1c-\x1f]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def gathered(flat: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[offsets[i]:offsets[i + 1]] for every i of index, joined, and the runs' offsets."""
    starts = offsets[index]
    lengths = offsets[index + 1] - starts
    ends = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(ends[-1]) - np.repeat(ends[:-1] - starts, lengths)
    return flat[at], ends


class Vocabulary:
    """Symbols, merges and splitting rules of one vocabulary file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.normalize = self.library.normalizer.normalize_str
        model = spec["model"]
        names: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        size = 1 + max([*names.values(), *self.special.values()])
        self.token = [""] * size
        for name, i in [*names.items(), *self.special.items()]:
            self.token[i] = name
        self.names = pa.array(self.token, pa.string())
        self.width = max(16, size.bit_length())
        self.letter = self._byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letter)}
        self.inner = np.array([names[c] for c in self.letter], np.int64)
        self.last = np.array([names[c + suffix] for c in self.letter], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = np.array([names[a + b] for a, b in pairs], np.int64)
        if len(np.unique(made)) != len(made):
            raise ValueError("two merges make the same symbol; ranks in ascending order would not be exact")
        self.left = np.array([names[a] for a, _ in pairs], np.int64)
        self.right = np.array([names[b] for _, b in pairs], np.int64)
        self.made = made
        keys = (self.left << self.width) | self.right
        self.rank_of = np.argsort(keys)
        self.keys = keys[self.rank_of]

    @staticmethod
    def _byte_letters() -> list[str]:
        """The printable letter that stands for each byte: itself where it prints, else the next free one from 256."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]

    def ranked(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs have a rank, and the ranks of those."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return hit, self.rank_of[at[hit]]

    def normalized(self, pieces: list[str]) -> list[str]:
        """Pieces without white space, normalised: nothing looks across white space, so one call does all that need it."""
        odd = [p for p in pieces if not p.isascii()]
        done = self.normalize(" ".join(odd)).split(" ") if odd else []
        if len(done) != len(odd):
            done = [self.normalize(p) for p in odd]
        following = iter(done)
        return [p.lower() if p.isascii() else next(following) for p in pieces]

    def cut(self, piece: str) -> list[str]:
        """Words of a piece without white space."""
        return self.words_of(self.normalized([piece])[0])

    def words_of(self, piece: str) -> list[str]:
        """Words of a normalised piece."""
        if not piece.isascii() and max(piece) > LATIN:
            # Letters added in recent Unicode versions: the library's own tables decide.
            return [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(piece)]
        return [piece] if piece.isalpha() else self.words(piece)

    def pieces(self, text: str) -> list[str]:
        """A text cut at white space and special tokens."""
        if self.at_special is None or "<|" not in text:
            return SPACE.split(text) if NO_SPACE.search(text) else text.split()
        return [p for part in self.at_special.split(text) for p in ([part] if part in self.special else SPACE.split(part))]


class PairIndex:
    """All words of a slice as linked symbols, and where each ranked pair occurs."""

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        self.v = vocabulary
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        self.symbol = vocabulary.inner[data]
        self.symbol[self.ends - 1] = vocabulary.last[data[self.ends - 1]]
        self.next = np.arange(1, n + 1)
        self.next[self.ends - 1] = -1
        self.before = np.arange(-1, n - 1)
        self.before[self.ends[:-1]] = -1
        self.mark = np.full(n, -1)
        self.places: dict[int, list[np.ndarray]] = {}
        self.waiting: list[int] = []
        self._enter(np.flatnonzero(self.next >= 0))

    def _enter(self, at: np.ndarray) -> None:
        """Add the pairs that start at these positions to the lists of their ranks."""
        if not len(at):
            return
        hit, rank = self.v.ranked((self.symbol[at] << self.v.width) | self.symbol[self.next[at]])
        at = at[hit]
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, where in zip(rank[np.concatenate(([0], cuts))].tolist() if len(rank) else [], np.split(at, cuts)):
            if r in self.places:
                self.places[r].append(where)
            else:
                self.places[r] = [where]
                heapq.heappush(self.waiting, r)

    def _distinct(self, at: np.ndarray) -> np.ndarray:
        """Each position once: of those that repeat, the one that wrote its place last."""
        turn = np.arange(len(at))
        self.mark[at] = turn
        return at[self.mark[at] == turn]

    def _merge(self, rank: int) -> None:
        where = self.places.pop(rank)
        at = np.concatenate(where) if len(where) > 1 else where[0]
        a, b = self.v.left[rank], self.v.right[rank]
        at = at[self.symbol[at] == a]
        if len(where) > 1:
            at = self._distinct(at)
        mate = self.next[at]
        good = mate >= 0
        at, mate = at[good], mate[good]
        good = self.symbol[mate] == b
        at, mate = at[good], mate[good]
        if a == b and len(at) > 1:
            # In a run of one symbol the leftmost pairs win, and a symbol merges once.
            taken, keep = -1, np.ones(len(at), bool)
            for i in np.argsort(at):
                keep[i] = at[i] != taken
                taken = mate[i] if keep[i] else -1
            at, mate = at[keep], mate[keep]
        if not len(at):
            return
        after = self.next[mate]
        self.symbol[at], self.symbol[mate] = self.v.made[rank], -1
        self.next[at] = after
        more = after >= 0
        self.before[after[more]] = at[more]
        left, right = self.before[at], at[more]
        left = left[left >= 0]
        # Neither repeats a position; one that is in both is entered once.
        self.mark[left] = -2
        once = right[self.mark[right] != -2]
        self.mark[left] = -1
        self._enter(np.concatenate((left, once)))

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, joined, and each word's offsets."""
        while self.waiting:
            self._merge(heapq.heappop(self.waiting))
        alive = self.symbol >= 0
        count = np.concatenate(([0], np.cumsum(alive)))
        return self.symbol[alive].astype(np.uint32), np.concatenate(([0], count[self.ends]))


class _Seen(dict):
    def __missing__(self, piece: str) -> int:
        i = self[piece] = len(self)
        return i


class Encoder:
    """Encodes slices of texts; `by_library` has the library's model merge each word instead of the index.

    Between slices it keeps at most `pieces` pieces of `letters` characters together (None: any).
    """

    def __init__(self, path: str, by_library: bool = False, pieces: int | None = None, letters: int | None = None):
        self.vocabulary, self.by_library = Vocabulary(path), by_library
        self.most_pieces, self.most_letters = KEPT_PIECES if pieces is None else pieces, letters
        self.forget()

    def forget(self) -> None:
        self.letters = 0
        self.seen, self.flat, self.offsets = _Seen(), np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [w.encode() for w in words]
        if not self.by_library:
            return PairIndex(self.vocabulary, raw).run()
        letter, merge = self.vocabulary.letter, self.vocabulary.library.model.tokenize
        ids = [[t.id for t in merge("".join([letter[b] for b in w]))] for w in raw]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64)))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(ends[-1])), ends

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces not met before, and append their ids to the table."""
        words, special = _Seen(), self.vocabulary.special
        index: list[int] = []
        counts = np.empty(len(pieces), np.int64)
        fixed: list[int] = []
        for k, (piece, plain) in enumerate(zip(pieces, self.vocabulary.normalized(pieces))):
            if piece in special:
                fixed.append(k)
                counts[k] = 0
                continue
            cut = self.vocabulary.words_of(plain)
            counts[k] = len(cut)
            index.extend(map(words.__getitem__, cut))
        if words:
            flat, offsets = self._word_ids(list(words))
            flat, ends = gathered(flat, offsets, np.array(index, np.int64))
        else:
            flat, ends = np.empty(0, np.uint32), np.zeros(1, np.int64)
        at = ends[np.concatenate(([0], np.cumsum(counts)))]
        lengths = np.diff(at)
        if fixed:
            flat = np.insert(flat, at[fixed], [special[pieces[k]] for k in fixed])
            lengths[fixed] = 1
        self.flat = np.concatenate((self.flat, flat.astype(np.uint32)))
        self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(lengths)))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text."""
        out: list[np.ndarray] = []
        for part in slices(texts):
            if len(self.seen) > self.most_pieces or (self.most_letters and self.letters > self.most_letters):
                self.forget()
            known, seen = len(self.seen), self.seen
            rows = [np.fromiter(map(seen.__getitem__, self.vocabulary.pieces(t or "")), np.int64) for t in part]
            if len(seen) > known:
                new = list(islice(seen, known, None))
                self.letters += sum(map(len, new))
                self._learn(new)
            for row in rows:
                out.append(gathered(self.flat, self.offsets, row)[0])
        return out


def joined(tokens: pa.Array, ids: list[np.ndarray]) -> pa.Array:
    """The names of every row's ids, joined by spaces; about NAMES at a time are laid out."""
    out, at = [], 0
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    while at < len(ids):
        base = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + NAMES, "right")))
        offsets = np.concatenate(([0], ends[at:end] - base))
        names = tokens.take(pa.array(np.concatenate(ids[at:end]).astype(np.int64)))
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names), " "))
        at = end
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def slices(texts: list[str | None]):
    """Runs of texts of at most SLICE characters, a longer text alone."""
    part, size = [], 0
    for t in texts:
        n = len(t or "")
        if part and size + n > SLICE:
            yield part
            part, size = [], 0
        part.append(t)
        size += n
    if part:
        yield part


@cache
def encoder(path: str, by_library: bool = False) -> Encoder:
    return Encoder(path, by_library)


@cache
def small_encoder(path: str) -> Encoder:
    return Encoder(path, pieces=SMALL_PIECES, letters=SMALL_LETTERS)


def encode(text: Column, path: str | None = None) -> Column:
    """Token ids of a text column, as little-endian unsigned 32-bit integers."""
    path = path or default_vocabulary()

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        return pa.array([x.astype("<u4").tobytes() for x in encoder(path).encode(texts.to_pylist())], pa.binary())

    return ids(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The vocabulary file names no decoder, so the text is the tokens' names, joined by spaces; null ids give none."""
    path = path or default_vocabulary()

    @F.arrow_udf("string")
    def text(rows: pa.Array) -> pa.Array:
        return joined(encoder(path).vocabulary.names, [np.frombuffer(r or b"", "<u4") for r in rows.to_pylist()])

    return text(ids)


def encoded(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """All rows with `ids` (as `encode` gives them), `n_tokens` and `decoded`, in one pass with little memory.

    Rows go through in slices of SMALL_SLICE bytes of text, and what is kept between slices is bounded by bytes, so a task
    needs as much for a partition of any size; one text longer than that is a slice alone.  Columns of the input that are
    named like the three new ones are replaced.  Null and empty texts have no ids and decode to the empty text.
    """
    path = path or default_vocabulary()
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in ("ids", "n_tokens", "decoded")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = small_encoder(path)
        for part in sliced(batches, SMALL_SLICE, text):
            ids = coder.encode(part.column(text).to_pylist())
            new = [
                pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                pa.array([len(x) for x in ids], pa.int64()),
                joined(coder.vocabulary.names, ids),
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "ids", "n_tokens", "decoded"])
            del ids, new
        # The worker lives on and serves other stages, which need the room.
        coder.forget()
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *_ENCODED]))


def op8_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read(spark, sf_dir, "documents").select("doc_id", encode(F.col("text")).alias("ids"))
    return ids.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids")).cast("binary"), 256).alias("decoded_sha256"),
    )
