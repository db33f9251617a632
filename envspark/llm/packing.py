"""Best-fit packing of documents into training sequences, planned on the length histogram.

1. Each text becomes token ids and an end id; only documents longer than a sequence are cut,
   and then their first piece is the shorter one.
2. The histogram of piece lengths (one row per length, at most `SEQUENCE` of them) goes to
   the driver, which packs counts instead of pieces: from the longest length down, all
   pieces of a length go into the open sequences with the least room that holds them, runs of
   neighbouring sequences at a time, and into new sequences when none holds them.
3. The plan is a list of runs "the pieces of this length with these ranks take these
   sequences at this offset". It is expanded into slots on the executors, and a piece takes
   the slot of its rank within its length by a join.

Cases: a null text counts as empty and gives one piece, the end id; repeated rows are
packed each, and rows of equal length are ranked by key and start, ties among them in any order;
a very long text needs memory for its own ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.llm.byte_bpe import encoder
from envspark.llm.common import partitions, ranked, stash, texts_of

SEQUENCE = 2048
END_ID = 0
# slots that one row of the plan becomes at once
CHUNK = 1 << 16


def _cut(path: str, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            source, piece, start, size, crc = [], [], [], [], []
            for row, text in enumerate(texts_of(batch.column(1))):
                found = coder.ids(text.decode())
                total = len(found) + 1
                ids = memoryview(struct.pack(f"<{total}I", *found, end_id))
                low, number = 0, 0
                high = total % length or min(length, total)
                while low < total:
                    source.append(row)
                    piece.append(number)
                    start.append(low)
                    size.append(high - low)
                    crc.append(zlib.crc32(ids[4 * low:4 * high]))
                    low, high, number = high, high + length, number + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                names=[batch.schema.names[0], "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = SEQUENCE,
           end_id: int = END_ID) -> DataFrame:
    """`key`, piece, start, length, ids_crc32 of every piece."""
    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(
        _cut(path, length, end_id), f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def plan(histogram: Mapping[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over counts: runs (length, first rank, count, first sequence, offset)."""
    room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # sequences [low, high) by room left
    room[size].append((0, sum(histogram.values())))  # those not opened yet, enough for one piece each
    runs: list[tuple[int, int, int, int, int]] = []
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        least = length
        while left:
            while not room[least]:
                least += 1
            low, high = room[least].pop()
            each = least // length  # one sequence after the other is filled as far as it goes
            whole = min(left // each, high - low)
            parts = [(whole, each)] if whole else []
            if low + whole < high and left - whole * each:
                parts.append((1, left - whole * each) if left - whole * each < each else (0, 0))
            for count, filled in parts:
                for i in range(filled):
                    runs.append((length, rank, count, low, size - least + i * length))
                    rank += count
                if count:
                    room[least - filled * length].append((low, low + count))
                low, left = low + count, left - count * filled
            if low < high:
                room[least].append((low, high))
    return runs


def packed(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", length: int = SEQUENCE,
           end_id: int = END_ID) -> DataFrame:
    """The pieces with sequence_id and offset; offsets have no gaps and sequences hold at most `length` tokens."""
    spark = docs.sparkSession
    cut = stash(pieces(docs, path, key, text, length, end_id))
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = spark.createDataFrame(plan(histogram, length),
                                 "length long, first long, n long, sequence long, offset long")
    chunks = runs.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}"))))
    spread = chunks.repartition(partitions(spark), "length", "first", "chunk")
    inside = F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1))
    slots = spread.withColumn("i", inside).select(
        "length", (F.col("first") + F.col("i")).alias("_rank"),
        (F.col("sequence") + F.col("i")).alias("sequence_id"), "offset")
    order = [F.col(f"`{key}`"), F.col("start")]
    return (ranked(cut, ["length"], "_rank", order).join(slots, ["length", "_rank"])
            .select(F.col(f"`{key}`"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
