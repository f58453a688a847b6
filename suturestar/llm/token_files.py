"""Token ids as raw payloads, with a minimal perfect hash index for keyed access.

Layout below one folder, written by Spark's own committer so that retried tasks leave no halves and any store that
Spark writes will do:

* `payload`: one row per shard.  `shard` ascends with the documents' ids (range partition, then place within it);
  `payload` holds the raw ids of its documents one after another, unsigned 16-bit little-endian if the vocabulary
  fits, else 32-bit; `keys`, `nulls` and `ends` hold each document's id and the end of its run; `ids_before` counts
  the ids of earlier shards of the same range.
* `index`: one row per hash bucket of keys.  A minimal perfect hash (levels of bit vectors: a key that alone hits a
  bit on its level takes that bit's rank as its slot, the others go on to the next level) maps each distinct key
  to a slot; `fingerprints[slot]` rejects most unknown keys, `first[slot]` to `first[slot + 1]` are its entries:
  shard, position, and how many copies follow there.  A read checks the shard's stored key as well, so it is exact.

Documents with a null or empty text hold the end id alone.  A null id is a key of its own and sorts first.  Repeated
ids are all stored, next to each other in ascending order of their text, and a lookup returns each of them.  An empty table gives empty files.
Extra columns of the input are not stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.bpe import default_vocabulary, encoder
from suturestar.llm.frames import read
from suturestar.session import scratch

END_ID = 2
SHARD_IDS = 1 << 20
KEYS_PER_BUCKET = 50_000
GAMMA = 1.5
PAYLOAD = "shard long, range int, ids_before long, n_docs long, n_ids long, width int, payload binary, keys binary, nulls binary, ends binary"
INDEX = "bucket int, sizes binary, bits binary, fingerprints binary, first binary, shards binary, positions binary, copies binary"
ENTRY = pa.schema([("key", pa.int64()), ("shard", pa.int64()), ("position", pa.int64()), ("copies", pa.int64())])


# ---------------------------------------------------------------- minimal perfect hash


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    x = h ^ np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (_mixed(h, level + 1) % np.uint64(size)).astype(np.int64)


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (_mixed(h, 0) >> np.uint64(32)).astype("<u4")


def build_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level sizes and the bits of all levels, for distinct 64-bit hashes."""
    sizes, bits, rest = [], [], h
    while len(rest):
        size = max(64, int(GAMMA * len(rest)))
        at = _place(rest, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        rest = rest[~alone[at]]
    return np.array(sizes, "<i8"), np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(h: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slot of each hash; of an unknown one any slot, or -1."""
    out = np.full(len(h), -1, np.int64)
    rank = np.cumsum(bits) - bits
    todo, base = np.arange(len(h)), 0
    for level, size in enumerate(sizes.tolist()):
        at = base + _place(h[todo], level, size)
        hit = bits[at]
        out[todo[hit]] = rank[at[hit]]
        todo, base = todo[~hit], base + size
    return out


# ---------------------------------------------------------------- writing


def _shards(path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encode documents in the order they come and cut them into shards."""
    coder = encoder(path, by_library=True)
    dtype = "<u2" if len(coder.vocabulary.token) <= 1 << 16 else "<u4"
    part = TaskContext.get().partitionId()
    schema = pa.schema(
        [("shard", pa.int64()), ("range", pa.int32()), ("ids_before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())]
        + [(c, pa.binary()) for c in ("payload", "keys", "nulls", "ends")]
    )
    state = {"number": 0, "before": 0}

    def row(runs: list[np.ndarray], keys: list[int | None]) -> pa.RecordBatch:
        ends = np.cumsum([len(r) for r in runs]).astype("<i8")
        values = [
            (part << 32) + state["number"], part, state["before"], len(runs), int(ends[-1]), int(dtype[-1]),
            np.concatenate(runs).astype(dtype).tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(),
            np.array([k is None for k in keys], np.uint8).tobytes(), ends.tobytes(),
        ]
        state["number"] += 1
        state["before"] += int(ends[-1])
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, schema.types)], schema=schema)

    runs, keys, size = [], [], 0
    tail = np.array([end_id], np.uint32)
    for batch in batches:
        names = batch.column("key").to_pylist()
        for key, ids in zip(names, coder.encode(batch.column("text").to_pylist())):
            if size >= SHARD_IDS:
                yield row(runs, keys)
                runs, keys, size = [], [], 0
            runs.append(np.concatenate((ids, tail)))
            keys.append(key)
            size += len(runs[-1])
    if runs:
        yield row(runs, keys)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per shard and key: where its copies begin and how many there are."""
    for batch in batches:
        for shard, keys, nulls in zip(*(batch.column(c).to_pylist() for c in ("shard", "keys", "nulls"))):
            key, null = np.frombuffer(keys, "<i8"), np.frombuffer(nulls, np.uint8)
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (null[1:] != null[:-1])))
            at = np.flatnonzero(new)
            columns = [
                pa.array(key[at], pa.int64(), mask=null[at] == 1),
                pa.array(np.full(len(at), shard)),
                pa.array(at),
                pa.array(np.diff(np.append(at, len(key)))),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=ENTRY)


def _bucket(group: pa.Table) -> pa.Table:
    """The index row of one bucket."""
    group = group.sort_by([("h", "ascending"), ("shard", "ascending"), ("position", "ascending")])
    h = group["h"].to_numpy().astype(np.int64).view(np.uint64)
    # Sorted as signed numbers, equal hashes are neighbours.
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    sizes, bits = build_hash(h[at])
    slot = slots(h[at], sizes, bits)
    order = np.argsort(slot)
    counts = np.diff(np.append(at, len(h)))[order]
    first = np.concatenate(([0], np.cumsum(counts)))
    entry = np.repeat(at[order] - first[:-1], counts) + np.arange(len(h))
    blobs = {
        "sizes": sizes,
        "bits": np.packbits(bits),
        "fingerprints": fingerprint(h[at][order]),
        "first": first.astype("<i8"),
        "shards": group["shard"].to_numpy()[entry].astype("<i8"),
        "positions": group["position"].to_numpy()[entry].astype("<i8"),
        "copies": group["copies"].to_numpy()[entry].astype("<i8"),
    }
    bucket = group["bucket"].slice(0, 1).combine_chunks().cast(pa.int32())
    return pa.table({"bucket": bucket, **{k: pa.array([v.tobytes()], pa.binary()) for k, v in blobs.items()}})


def _hashed(df: DataFrame, buckets: int) -> DataFrame:
    h = F.xxhash64("key")
    return df.withColumn("h", h).withColumn("bucket", F.pmod(F.xxhash64(h), F.lit(buckets)).cast("int"))


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, id_: str = "doc_id", text: str = "text") -> None:
    """Write payload and index below a new folder."""
    spark = docs.sparkSession
    path = vocabulary or default_vocabulary()
    # By id alone, so copies of an id share a range; a range holds any number of shards.
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_).cast("long").alias("key"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(n, "key").sortWithinPartitions("key", F.xxhash64("text"))
    rows.mapInArrow(lambda it: _shards(path, end_id, it), PAYLOAD).write.parquet(f"{folder}/payload")
    build_index(spark, folder)


def build_index(spark: SparkSession, folder: str) -> None:
    payload = spark.read.schema(PAYLOAD).parquet(f"{folder}/payload")
    n_docs = payload.agg(F.sum("n_docs")).first()[0] or 0
    buckets = n_docs // KEYS_PER_BUCKET + 1
    entries = payload.select("shard", "keys", "nulls").mapInArrow(_entries, "key long, shard long, position long, copies long")
    index = _hashed(entries, buckets).groupBy("bucket").applyInArrow(_bucket, INDEX)
    index.write.parquet(f"{folder}/index")


# ---------------------------------------------------------------- reading


def _find(keys: pa.Table, index: pa.Table) -> pa.Table:
    """Entries of the keys of one bucket."""
    if not index.num_rows:
        return ENTRY.empty_table()
    blob = {c: index[c][0].as_py() for c in index.column_names if c != "bucket"}
    sizes = np.frombuffer(blob["sizes"], "<i8")
    bits = np.unpackbits(np.frombuffer(blob["bits"], np.uint8))[: int(sizes.sum())].astype(bool)
    prints, first = np.frombuffer(blob["fingerprints"], "<u4"), np.frombuffer(blob["first"], "<i8")
    h = keys["h"].to_numpy().astype(np.int64).view(np.uint64)
    slot = slots(h, sizes, bits)
    known = slot >= 0
    known[known] = prints[slot[known]] == fingerprint(h[known])
    slot = slot[known]
    counts = first[slot + 1] - first[slot]
    ends = np.concatenate(([0], np.cumsum(counts)))
    at = np.repeat(first[slot] - ends[:-1], counts) + np.arange(ends[-1])
    key = keys["key"].filter(pa.array(known)).take(pa.array(np.repeat(np.arange(len(slot)), counts)))
    found = [np.frombuffer(blob[c], "<i8")[at] for c in ("shards", "positions", "copies")]
    return pa.Table.from_arrays([key, *map(pa.array, found)], schema=ENTRY)


FOUND = pa.schema([("key", pa.int64()), ("range", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())])


def _cut(places: pa.Table, shards: pa.Table) -> pa.Table:
    """The runs of ids at the places of one shard, whose stored keys are the wanted ones."""
    if not shards.num_rows or not places.num_rows:
        return FOUND.empty_table()
    s = {c: shards[c][0].as_py() for c in shards.column_names}
    ids, ends = np.frombuffer(s["payload"], f"<u{s['width']}"), np.frombuffer(s["ends"], "<i8")
    keys, nulls = np.frombuffer(s["keys"], "<i8"), np.frombuffer(s["nulls"], np.uint8)
    copies = places["copies"].to_numpy()
    offsets = np.concatenate(([0], np.cumsum(copies)))
    at = np.repeat(places["position"].to_numpy() - offsets[:-1], copies) + np.arange(offsets[-1])
    asked = places["key"].combine_chunks() if places["key"].num_chunks != 1 else places["key"].chunk(0)
    key = np.repeat(asked.fill_null(0).to_numpy(zero_copy_only=False), copies)
    null = np.repeat(asked.is_null().to_numpy(zero_copy_only=False), copies)
    same = (keys[at] == key) & ((nulls[at] == 1) == null)
    at, key, null = at[same], key[same], null[same]
    starts = np.where(at > 0, ends[at - 1], 0)
    runs = [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends[at])]
    columns = [
        pa.array(key, pa.int64(), mask=null),
        pa.array(np.full(len(runs), s["range"], np.int32)),
        pa.array(s["ids_before"] + starts),
        pa.array(runs, pa.binary()),
    ]
    return pa.Table.from_arrays(columns, schema=FOUND)


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """For each distinct key (column `key`, long) its documents: `start` (ids of all documents before) and `ids`
    (little-endian unsigned 32-bit).  Unknown keys give no row."""
    payload = spark.read.schema(PAYLOAD).parquet(f"{folder}/payload")
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    buckets = (payload.agg(F.sum("n_docs")).first()[0] or 0) // KEYS_PER_BUCKET + 1
    asked = _hashed(keys.select("key").distinct(), buckets)
    places = asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(_find, "key long, shard long, position long, copies long")
    cut = places.groupBy("shard").cogroup(payload.groupBy("shard")).applyInArrow(_cut, "key long, range int, start long, ids binary")
    # One row per range: as many as the write had partitions.
    totals = payload.groupBy("range").agg(F.sum("n_ids").alias("n")).orderBy("range").collect()
    before, bases = 0, []
    for t in totals:
        bases.append((t.range, before))
        before += t.n
    base = spark.createDataFrame(bases, "range int, base long")
    return cut.join(base, "range").select("key", (F.col("base") + F.col("start")).alias("start"), "ids")


def op10_hash_indexed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch(spark, "token-files")
    write(docs, folder)
    found = lookup(spark, folder, docs.select(F.col("doc_id").alias("key")))
    return found.select(
        F.col("key").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
