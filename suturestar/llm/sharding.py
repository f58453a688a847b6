"""Sharding by histogram sort.

Rows are ordered by (hash of the text, document id).  A splitter is the key before which exactly its share of
all bytes lies.  Splitters are found by counting: each round puts probes into the intervals that still hold a
splitter, one aggregation counts the exact bytes and rows between neighbouring probes on all partitions, and the
intervals shrink.  A round sends a few hundred counts to the driver, whatever the input.  When every splitter is
settled, the rows move once, each straight to the partition of its part of the key space, where they are sorted
and numbered; the exact counts below a part give its first slot, so no count follows the exchange.

Law `bytes`: a row belongs to shard `8 * p / total` (rounded down), `p` being the bytes up to its middle in the
order.  Rows of equal text form a group.  A group of at most `tolerance` of a shard's bytes counts as one row and
stays whole; a larger one, such as a text that a third of all rows share, is cut by document id.

Nulls: a null text has size 1 and forms one group; a null id sorts first.  Rows with equal text and id cannot be
told apart, stay together, and take adjacent slots.  An empty table gives an empty result.  A column of the input
that is named like an output column (`size`, `shard`, `slot`) is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from suturestar.llm.frames import fresh, kept, read

SHARDS = 8
TOLERANCE = 0.002
# Few enough for the search among them to stay compiled code.
PROBES_PER_ROUND = 180
LOWEST = -(2**63) + 1
Key = tuple[int, int]


@dataclass
class Splitter:
    """A wanted boundary: `target` bytes lie before it.  `slack` > 0 accepts any probe that near.

    `low` and `high` are the keys between which it lies; with one hash, the document ids count, else they don't.
    """

    target: int
    slack: int
    low: Key
    high: Key
    at: Key | None = None
    bytes_before: int = 0
    rows_before: int = 0


def _before(probe: Key, h: str, d: str) -> str:
    x, y = probe
    return f"{h} < {x}L" if y == LOWEST else f"({h} < {x}L OR ({h} = {x}L AND {d} < {y}L))"


def _search(probes: list[Key], low: int, high: int, h: str = "h", d: str = "d") -> str:
    """SQL of the number of probes that are at or before a row's key, as a binary search."""
    if low == high:
        return str(low)
    mid = (low + high) // 2
    return f"IF({_before(probes[mid], h, d)}, {_search(probes, low, mid, h, d)}, {_search(probes, mid + 1, high, h, d)})"


def _histogram(keys: DataFrame, probes: list[Key]) -> list[dict]:
    """Exact bytes, rows and key range of each interval between neighbouring probes; one row per interval."""
    cells = (
        keys.select("h", "d", "size", F.expr(_search(probes, 0, len(probes))).alias("cell"))
        .groupBy("cell")
        .agg(
            F.sum("size").alias("bytes"),
            F.count(F.lit(1)).alias("rows"),
            F.min("h").alias("h0"),
            F.max("h").alias("h1"),
            F.min("d").alias("d0"),
            F.max("d").alias("d1"),
        )
        .collect()
    )
    out, total_bytes, total_rows = [], 0, 0
    for c in sorted(cells, key=lambda c: c.cell):
        out.append(c.asDict() | {"bytes_before": total_bytes, "rows_before": total_rows})
        total_bytes, total_rows = total_bytes + c.bytes, total_rows + c.rows
    return out


def _spread(low: int, high: int, n: int) -> list[int]:
    """Values evenly apart from the lowest to just behind the highest: what lies between two is inside the interval."""
    width = high + 1 - low
    return sorted({low + width * i // n for i in range(n + 1)})


def _probes(s: Splitter, n: int) -> list[Key]:
    (h0, d0), (h1, d1) = s.low, s.high
    if h0 < h1:
        return [(h, LOWEST) for h in _spread(h0, h1, n)]
    return [(h0, d) for d in _spread(d0, d1, n)]


def _settle(s: Splitter, cells: list[dict], whole: int) -> None:
    """Narrow a splitter to the cell that holds its target, or fix it."""
    if s.slack:
        near = min(cells, key=lambda c: abs(c["bytes_before"] - s.target))
        if abs(near["bytes_before"] - s.target) <= s.slack:
            s.at = (near["h0"], near["d0"] if near["h0"] == near["h1"] else LOWEST)
            s.bytes_before, s.rows_before = near["bytes_before"], near["rows_before"]
            return
    cell = [c for c in cells if c["bytes_before"] < s.target][-1:] or cells[:1]
    c = cell[0]
    # A cell of one hash, seen while the interval held several, is the whole group.
    group_fits = c["h0"] == c["h1"] and s.low[0] != s.high[0] and c["bytes"] <= whole
    if group_fits or (c["h0"], c["d0"]) == (c["h1"], c["d1"]):
        h, d = (c["h0"], LOWEST) if group_fits else (c["h0"], c["d0"])
        s.at, s.bytes_before, s.rows_before = (h, d), c["bytes_before"], c["rows_before"]
        if 2 * c["bytes_before"] + c["bytes"] < 2 * s.target:
            s.at = (h + 1, LOWEST) if group_fits else (h, d + 1)
            s.bytes_before, s.rows_before = s.bytes_before + c["bytes"], s.rows_before + c["rows"]
        return
    s.low, s.high = (c["h0"], c["d0"]), (c["h1"], c["d1"])


def find_splitters(keys: DataFrame, shards: int, parts: int, tolerance: float) -> tuple[list[Splitter], list[int]]:
    """Splitters of all parts in key order, and the shard that each part belongs to."""
    first = _histogram(keys, [])
    if not first:
        return [], [0]
    all_ = first[0]
    total, whole = all_["bytes"], int(all_["bytes"] / shards * tolerance)
    span = ((all_["h0"], all_["d0"]), (all_["h1"], all_["d1"]))
    n = shards * parts
    wanted = [Splitter(total * i // n, 0 if i % parts == 0 else max(1, total // n // 4), *span) for i in range(1, n)]
    while open_ := [s for s in wanted if s.at is None]:
        intervals = dict(list({(s.low, s.high): s for s in open_}.items())[: PROBES_PER_ROUND // 3])
        open_ = [s for s in open_ if (s.low, s.high) in intervals]
        each = max(2, PROBES_PER_ROUND // len(intervals) - 1)
        probes = sorted({p for s in intervals.values() for p in _probes(s, each)})
        cells = _histogram(keys, probes)
        for s in open_:
            _settle(s, cells, whole)
    shard_of = [0]
    for i, _ in enumerate(wanted, 1):
        shard_of.append(i // parts)
    return wanted, shard_of


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with their `size`, `shard` and gapless `slot` within the shard, laid out in key order."""
    spark = docs.sparkSession
    kept_columns = [f"`{c}`" for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    h, d, size, part = (fresh(x) for x in ("h", "d", "size", "part"))
    row = docs.select(
        *kept_columns,
        F.xxhash64(F.col(text)).alias(h),
        F.coalesce(F.col(id_).cast("long"), F.lit(LOWEST + 1)).alias(d),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias(size),
    )
    keys = kept(row.select(F.col(h).alias("h"), F.col(d).alias("d"), F.col(size).alias("size")), "histogram")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    splitters, shard_of = find_splitters(keys, shards, parts, tolerance)
    # Neighbouring splitters can meet on one key; the parts between them are empty.
    bounds = [s.at for s in splitters]
    for i in range(1, len(bounds)):
        bounds[i] = max(bounds[i], bounds[i - 1])
    rows_before = [0] + [s.rows_before for s in splitters]
    for i in range(1, len(rows_before)):
        rows_before[i] = max(rows_before[i], rows_before[i - 1])
    first_part = {s: shard_of.index(s) for s in set(shard_of)}
    offset = [rows_before[p] - rows_before[first_part[s]] for p, s in enumerate(shard_of)]
    place = _search(bounds, 0, len(bounds), h, d)
    moved = row.withColumn(part, F.expr(place)).repartitionById(len(shard_of), F.col(part))
    number = F.row_number().over(Window.partitionBy(part).orderBy(h, d))

    def of_part(values: list[int]) -> Column:
        return F.expr(f"array({','.join(f'{v}L' for v in values)})")[F.col(part)]

    return moved.select(
        *kept_columns,
        F.col(size).alias("size"),
        of_part(shard_of).cast("int").alias("shard"),
        (number - 1 + of_part(offset)).cast("long").alias("slot"),
    )


def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
