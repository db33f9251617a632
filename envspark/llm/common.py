"""Small helpers that the operators of this package share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.sources.storage import written

# bytes of text that one vectorized step handles; bounds the temporaries of a Python worker
STEP_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the library to the executors, which may not have it installed; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parents[1]
        name = str(Path(tempfile.mkdtemp(prefix="ship-"), package.name))
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return spark


def stash(df: DataFrame) -> DataFrame:
    """Write a table into the shared folder and read it back, so that a lost executor costs no recomputation.

    The folder is `spark.checkpoint.dir`; the table is removed when the application ends.
    """
    return written(df, "stash")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; a null has none."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def slices(sizes: Sequence[int], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items of about `limit` together; a larger item stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def ranked(df: DataFrame, keys: Sequence[str], rank: str, order: Iterable[Column], salts: int | None = None) -> DataFrame:
    """Number the rows of each key from 0 without putting a key into one task.

    A key is split by a hash of the row into `salts` parts; counts by (key, part) say
    where each part begins. Keys are not null. Rows equal in every column are interchangeable.
    """
    salts = salts or max(64, 4 * partitions(df.sparkSession))
    salt, before = fresh(df, "_salt"), fresh(df, "_before")
    parts = [*keys, salt]
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    counts = salted.groupBy(*parts).agg(F.count("*").alias(before))
    earlier = Window.partitionBy(*keys).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(*parts).orderBy(*order)) - 1
    numbered = salted.withColumn(rank, inside.cast("long")).join(begins, parts)
    return numbered.withColumn(rank, F.col(rank) + F.col(before)).drop(salt, before)


def mapped(df: DataFrame, function, added: Sequence[T.StructField] = ()) -> DataFrame:
    """df.mapInArrow(function) for a function that returns the columns of `df` and the added ones, under any names."""
    fields = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate([*df.schema.fields, *added])]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(function, T.StructType(fields)).toDF(*df.columns, *[f.name for f in added])


def pow_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        if size > 4 * STEP_BYTES:  # of a very long text: not kept
            return pow_table(_BASE, size), pow_table(_INVERSE, size)
        _powers[size] = pow_table(_BASE, size), pow_table(_INVERSE, size)
    return _powers[size]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, by prefix sums of a polynomial."""
    forward, backward = _tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * forward[:len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * backward[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


#: ASCII white space, which separates words
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(texts: Sequence[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts on end, and where each text's words begin (one more than texts)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    if lower:
        data = LOWER[data]
    gap = SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(data) and not gap[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]  # each text ends with a gap
    bounds = np.concatenate([[0], np.searchsorted(starts, ends_of_text)])
    return span_hashes(data, starts, ends), bounds
