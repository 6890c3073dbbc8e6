"""Shards of nearly equal bytes: a minimax contiguous partition of groups of equal texts.

Groups are put in the order of their text's SHA-256. The smallest capacity for which
a greedy walk over that order needs no more than the wanted shards is found by binary
search, and the order is cut where that walk cuts. A group larger than an even share
can't be balanced, so such groups (fewer than there are shards) come first, one to a
shard, and the others are divided among the shards that remain.

The walk asks only for "the last group that ends at or before byte x". Spark holds the
running sums; the driver holds a fixed number of group ends, and asks for closer ones
in the stretches where a cut may still fall, until every cut is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.scratch import materialize

KEY_BUCKETS = 1 << 14  # of running sums; one row each where they are added up
FIRST_ENDS, MORE_ENDS = 1 << 14, 1 << 11  # group ends asked for, at first and for each further stretch
SLOT_BUCKETS = 1 << 10  # of a shard, each numbered by a task of its own


def assign_shards(
    docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, shard, slot.

    ``size`` is the text's UTF-8 bytes plus one; a null text counts as an empty one and
    shares its group. Rows of equal text share a shard. ``slot`` numbers a shard's rows
    from 0 without gaps; repeated rows each get their own. An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group_key"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("group_size"))
    alone = _oversized(groups, n_shards)
    rest = groups
    for key, _ in alone:
        rest = rest.filter(F.col("group_key") != F.lit(bytes(key)))
    ends = materialize(_running_ends(rest), "shard-ends")
    cuts = minimax_cuts(ends, n_shards - len(alone))
    return _numbered(rows.withColumn("shard", _shard(ends, cuts, alone)))


def _oversized(groups: DataFrame, n_shards: int) -> list[tuple[bytes, int]]:
    """Groups above an even share of what the shards still have to hold, largest first."""
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    # n - 1 at most: so many groups above 1/n of the total fill it.
    candidates = (
        groups.filter(F.col("group_size") > total // n_shards)
        .orderBy(F.desc("group_size"), "group_key")
        .limit(n_shards)
        .collect()
    )
    alone = []
    for key, size in candidates:
        if len(alone) < n_shards - 1 and size * (n_shards - len(alone)) > total:
            alone.append((key, size))
            total -= size
    return alone


def _running_ends(groups: DataFrame) -> DataFrame:
    """``upto``: bytes of all groups up to and with this one, in the order of their keys."""
    bucketed = groups.withColumn(
        "bucket", F.shiftright(F.conv(F.hex(F.substring("group_key", 1, 2)), 16, 10).cast("int"), 2)
    )
    before = (
        bucketed.groupBy("bucket")
        .agg(F.sum("group_size").alias("bucket_size"))
        .select(
            "bucket",
            (F.sum("bucket_size").over(Window.orderBy("bucket")) - F.col("bucket_size")).alias("before"),
        )
    )
    running = Window.partitionBy("bucket").orderBy("group_key")
    return (
        bucketed.withColumn("inside", F.sum("group_size").over(running))
        .join(F.broadcast(before), "bucket")  # KEY_BUCKETS rows at most
        .select("group_key", (F.col("before") + F.col("inside")).alias("upto"))
    )


class _Ends:
    """Known ends of groups; ``open`` marks those with unknown ends between them and the one before."""

    def __init__(self, total: int):
        self.total, self.at, self.open = total, [0, total], [False, True]

    def learn(self, low: int, high: int, found: list[tuple[int, int]]) -> None:
        """``found``: last end and number of ends in stretches of low < end <= high, in order."""
        keep = [(a, o) for a, o in zip(self.at, self.open, strict=True) if a <= low or a > high]
        both = sorted(keep + [(end, many > 1) for end, many in found])
        self.at, self.open = [a for a, _ in both], [o for _, o in both]

    def least(self, x: int) -> int:
        return self.at[bisect_right(self.at, x) - 1]

    def most(self, x: int) -> int:
        i = bisect_right(self.at, x)
        return x if i < len(self.at) and self.open[i] else self.at[i - 1]

    def walk(self, capacity: int, n: int, step) -> list[int]:
        path = [0]
        while len(path) <= n and path[-1] < self.total:
            path.append(step(path[-1] + capacity))
        return path[1:]

    def smallest(self, n: int, step) -> int:
        """The smallest capacity whose walk covers everything within n shards."""
        low, high = 0, self.total
        while high - low > 1:
            middle = (low + high) // 2
            path = self.walk(middle, n, step)
            low, high = (low, middle) if path and path[-1] >= self.total else (middle, high)
        return high


def minimax_cuts(ends: DataFrame, n_shards: int) -> list[int]:
    """Ends at which to cut so that the largest of ``n_shards`` contiguous parts is smallest."""
    total = ends.agg(F.max("upto")).first()[0]
    if total is None:
        return []
    known = _Ends(total)
    _look(ends, known, [(0, total)], FIRST_ENDS)
    while True:
        low, high = known.smallest(n_shards, known.most), known.smallest(n_shards, known.least)
        earliest = known.walk(low, n_shards, known.least)
        latest = known.walk(high, n_shards, known.most)
        if low == high and earliest == latest:
            return earliest[:-1]
        latest += [total] * (len(earliest) - len(latest))
        stretches: list[tuple[int, int]] = []
        for a, b in zip(earliest, latest, strict=False):
            a = known.least(a)
            b = known.at[min(bisect_left(known.at, b), len(known.at) - 1)]
            if b < total:
                b = known.at[bisect_right(known.at, b)]
            if stretches and a <= stretches[-1][1]:
                stretches[-1] = (stretches[-1][0], max(b, stretches[-1][1]))
            elif b > a:
                stretches.append((a, b))
        _look(ends, known, stretches, MORE_ENDS)


def _look(ends: DataFrame, known: _Ends, stretches: list[tuple[int, int]], parts: int) -> None:
    """Learn the last end of each of so many equal parts of every stretch."""
    which, part = F.lit(None).cast("int"), F.lit(None).cast("long")
    upto = F.col("upto")
    for i, (a, b) in enumerate(stretches):
        inside = (upto > a) & (upto <= b)
        width = -(-(b - a) // parts)
        which = F.when(inside, i).otherwise(which)
        part = F.when(inside, F.floor((upto - a - 1) / width)).otherwise(part)
    found = (
        ends.select("upto", which.alias("which"), part.alias("part"))
        .filter("which IS NOT NULL")
        .groupBy("which", "part")
        .agg(F.max("upto").alias("end"), F.count("*").alias("many"))
        .collect()  # len(stretches) * parts rows at most
    )
    for i, (a, b) in enumerate(stretches):
        known.learn(a, b, sorted((r["end"], r["many"]) for r in found if r["which"] == i))


def _shard(ends: DataFrame, cuts: list[int], alone: list[tuple[bytes, int]]) -> Column:
    """A key's shard: its own if it stands alone, else by the last keys of the parts."""
    last_keys = sorted(
        bytes(r["group_key"]) for r in ends.filter(F.col("upto").isin(cuts)).select("group_key").collect()
    ) if cuts else []
    key = F.col("group_key")
    shard = F.lit(len(alone))
    for last in last_keys:
        shard = shard + (key > F.lit(last)).cast("int")
    for i, (own, _) in reversed(list(enumerate(alone))):
        shard = F.when(key == F.lit(bytes(own)), i).otherwise(shard)
    return shard.cast("int")


def _numbered(rows: DataFrame) -> DataFrame:
    """Number each shard's rows from 0, every bucket of a shard in its own window."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "group_key"), F.lit(SLOT_BUCKETS)).cast("int"))
    before = (
        rows.groupBy("shard", "part")
        .count()
        .select(
            "shard",
            "part",
            (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("before"),
        )
    )
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "group_key")
    return (
        rows.withColumn("inside", F.row_number().over(inside))
        .join(F.broadcast(before), ["shard", "part"])  # n_shards * SLOT_BUCKETS rows at most
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("before") + F.col("inside") - 1).cast("long").alias("slot"),
        )
    )
