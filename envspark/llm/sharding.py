"""Sharding by minimax contiguous partition of atomic groups.

Documents of equal text form a group, which stays whole. Groups stand in the order of a
hash of their text. The smallest feasible shard capacity is searched: a capacity is
feasible if filling shard after shard as far as it goes uses no more shards than asked. Each
round tests many capacities at once, so a few rounds of small jobs do what a binary search
would, and the shards are cut where the greedy filling of the smallest one ends.

Sizes before a group come from sums per hash bucket (a bounded number, which the driver
adds up) and a running sum within each bucket. A group that fills a fair share by
itself stands first and gets a shard of its own, so that no shard stays empty for it.

Cases: a null text counts as empty; repeated rows are members of
one group; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envspark.llm.common import partitions, ranked, stash

SHARDS = 8
MAX_BUCKETS = 65_536
# capacities that one round tests
TESTED = 48


def alone(largest: list[int], total: int, shards: int) -> int:
    """How many of the largest groups get a shard of their own."""
    count = 0
    while count < min(len(largest), shards - 1) and largest[count] * (shards - count) >= total:
        total -= largest[count]
        count += 1
    return count


class Prefix:
    """Running sums over the ordered groups; looks up where a shard of given capacity ends."""

    def __init__(self, groups: DataFrame, before: list[tuple[int, int]], total: int):
        self.groups, self.total = groups, total
        self.buckets, self.begins = [b for b, _ in before], [s for _, s in before]

    def last_ends(self, limits: list[int]) -> list[int]:
        """For each limit the largest end of a group that does not exceed it."""
        wanted = sorted({x for x in limits if x < self.total})
        if not wanted:
            return [self.total for _ in limits]
        place = {x: bisect_right(self.begins, x) - 1 for x in wanted}
        spark = self.groups.sparkSession
        asked = spark.createDataFrame([(self.buckets[place[x]], x) for x in wanted], "bucket long, most long")
        rows = (self.groups.filter(F.col("bucket").isin(sorted({self.buckets[p] for p in place.values()})))
                .join(F.broadcast(asked), "bucket").filter("end <= most")
                .groupBy("most").agg(F.max("end").alias("end")).collect())
        found = {r.most: r.end for r in rows}
        return [self.total if x >= self.total else found.get(x, self.begins[place[x]]) for x in limits]

    def cuts(self, capacities: list[int], shards: int) -> list[list[int]]:
        """For each capacity the ends of its shards, filled one after another."""
        ends: list[list[int]] = [[] for _ in capacities]
        for _ in range(shards):
            reach = self.last_ends([(e[-1] if e else 0) + c for e, c in zip(ends, capacities)])
            for e, r in zip(ends, reach):
                e.append(r)
        return ends

    def smallest(self, largest: int, shards: int) -> list[int]:
        """Ends of the shards at the smallest feasible capacity."""
        fair = -(-self.total // shards)
        low, high = max(fair, largest), fair + largest  # the latter is always feasible
        best = None
        while best is None or low < high:
            step = max(1, -(-(high - low + 1) // TESTED))
            tested = [*range(low, high, step), high]
            for capacity, ends in zip(tested, self.cuts(tested, shards)):
                if ends[-1] == self.total:
                    high, best = capacity, ends
                    break
                low = capacity + 1
        return best


def sharded(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """`key`, size, text_crc32, law, shard, slot, grown_shard of every row."""
    spark = docs.sparkSession
    body = F.col(f"`{text}`")
    rows = stash(docs.select(
        F.col(f"`{key}`").alias("own_key"), (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        F.md5(F.coalesce(body, F.lit("")).cast("binary")).alias("grp")))
    groups = stash(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("members")))
    totals = groups.agg(F.sum("bytes").alias("bytes")).first()
    total = totals.bytes or 0
    top = groups.orderBy(F.desc("bytes"), "grp").limit(shards).collect()
    single = alone([r["bytes"] for r in top], total, shards)
    own = [r.grp for r in top[:single]]
    rest_total = total - sum(r["bytes"] for r in top[:single])
    largest = max((r["bytes"] for r in top[single:]), default=0)

    buckets = min(MAX_BUCKETS, 16 * partitions(spark))
    number = F.floor(F.conv(F.substring("grp", 1, 8), 16, 10).cast("long") * buckets / 2 ** 32)
    rest = groups.filter(~F.col("grp").isin(own)).withColumn("bucket", number.cast("long"))
    sums = sorted(rest.groupBy("bucket").agg(F.sum("bytes"), F.sum("members")).collect())
    before, at, members = [], 0, 0
    for bucket, size, count in sums:
        before.append((bucket, at, members))
        at, members = at + size, members + count
    begins = spark.createDataFrame(before, "bucket long, bytes_before long, rows_before long")
    running = Window.partitionBy("bucket").orderBy("grp").rowsBetween(Window.unboundedPreceding, 0)
    placed = stash(rest.join(F.broadcast(begins), "bucket").select(
        "grp", "bucket", "bytes",
        (F.col("bytes_before") + F.sum("bytes").over(running)).alias("end"),
        (F.col("rows_before") + F.sum("members").over(running) - F.col("members")).alias("rows_before")))

    ends = Prefix(placed, [(b, s) for b, s, _ in before], rest_total).smallest(largest, shards - single) if before else []
    begin = F.col("end") - F.col("bytes")
    shard = F.lit(single)
    for end in ends[:-1]:
        shard = shard + (begin >= end).cast("int")
    placed = placed.select("grp", shard.alias("shard"), "rows_before")
    firsts = placed.groupBy("shard").agg(F.min("rows_before").alias("first"))
    located = placed.join(F.broadcast(firsts), "shard").select(
        "grp", "shard", (F.col("rows_before") - F.col("first")).alias("slot_before"))
    if own:
        located = located.unionByName(spark.createDataFrame(
            [(g, i, 0) for i, g in enumerate(own)], "grp string, shard int, slot_before long"))
    return (ranked(rows, ["grp"], "inside", [F.col("own_key")]).join(located, "grp")
            .select(F.col("own_key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("slot_before") + F.col("inside")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
