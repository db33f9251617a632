"""Row windows over long series.

A window with few or no partition keys puts each whole group into one task.
Here the series is cut into buckets of neighbouring rows instead, and the few
rows that a frame reaches back over a cut travel along as a halo:

1. `fit_order_buckets` reads only the ordering columns and asks Spark for
   approximate quantiles. A timestamp so frequent that it fills buckets of its
   own is cut further by the tie-breaker, so no timestamp can make a hot bucket.
   The cuts are fixed numbers, so the bucket of a row never changes on a retry. The driver sees
   `COARSE` cuts at most; larger tables cut each of these buckets further by a table of quantiles that Spark
   fits, bucket by bucket, and that rows look their own bucket's cuts up in.
2. `windowed` keeps the last rows of every (group, bucket), which Spark limits
   before the shuffle, finds the rows that precede each bucket among them, adds
   these to the data and runs the window by (group, bucket).

Results are exactly those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.sources.storage import written

# rows that a bucket should not exceed; larger tables get more buckets, not larger ones
BUCKET_ROWS = 1_000_000
# buckets whose cuts the driver holds, and parts that each of them is cut into further at most; together they
# serve 10**12 rows, with a table of cuts of at most 8 MB
COARSE, FINE = 1000, 1000

BUCKET = "_bucket"
OWN = "_own"
_INF = float("inf")
# key of a missing timestamp, below every other key
_NULL_KEY = 1.0 - 2.0 ** 53
_LOWEST_KEY = _NULL_KEY + 1.0


def time_key(df: DataFrame, time: str) -> Column:
    """Microseconds of a timestamp as a double, exact for the years 1685 to 2255; NULL sorts first."""
    column = F.col(time)
    if isinstance(df.schema[time].dataType, T.TimestampNTZType):
        # wall-clock parts: converting to a zoned timestamp would break the order at clock changes
        seconds = (F.unix_date(column.cast("date")).cast("long") * 86400
                   + F.hour(column) * 3600 + F.minute(column) * 60)
        micros = seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("long")
    else:
        micros = F.unix_micros(column)
    return F.when(column.isNull(), F.lit(_NULL_KEY)).otherwise(
        F.greatest(micros.cast("double"), F.lit(_LOWEST_KEY)))


def default_buckets(df: DataFrame) -> int:
    """Twice the shuffle parallelism of the session, so that buckets spread evenly over tasks, or
    more if buckets would exceed `BUCKET_ROWS`."""
    parallelism = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, 2 * parallelism, -(-df.count() // BUCKET_ROWS))


def _quantiles(df: DataFrame, column: Column, buckets: int) -> list[float]:
    if buckets < 2:
        return []
    probabilities = [i / buckets for i in range(1, buckets)]
    return df.select(column.alias("k")).approxQuantile("k", probabilities, 1.0 / (4 * buckets))


@dataclass(frozen=True)
class OrderBuckets:
    """Cuts of the order (time, tie) into buckets; their number is bounded, not the data's.

    `time_cuts` make time buckets. Where `hot` is set, each of these time buckets
    holds a single frequent timestamp, and `fine_cuts` cut the position
    "time bucket + place of the tie-breaker in (`tie_low`, `tie_low + tie_span`)".
    """

    time: str
    tie: str
    time_cuts: tuple[float, ...] = ()
    hot: tuple[int, ...] = ()
    tie_low: float = 0.0
    tie_span: float = 0.0
    fine_cuts: tuple[float, ...] = ()
    #: (bucket, cuts): a sorted array of further cuts per bucket of the above, or None
    table: DataFrame | None = None
    parts: int = 1
    tie_range: tuple[float, float] = (0.0, 0.0)

    @property
    def single(self) -> bool:
        return not self.time_cuts

    def assign(self, df: DataFrame, name: str = BUCKET) -> DataFrame:
        """Add the bucket number, which never decreases along the order."""
        if self.single:
            return df.withColumn(name, F.lit(0).cast("long"))
        if self.table is None:
            return self._outer(df, name)
        key, cuts, of = f"{name}_key", f"{name}_cuts", f"{name}_of"
        side = F.broadcast(self.table.withColumnsRenamed({"bucket": of, "cuts": cuts}))  # a row per coarse bucket
        found = self._outer(df, name, key).join(side, F.col(name) == F.col(of), "left")
        below = _count_below(F.coalesce(F.col(cuts), F.array().cast("array<double>")), F.col(key))
        return found.withColumn(name, F.col(name) * self.parts + below).drop(key, cuts, of)

    def _outer(self, df: DataFrame, name: str, key: str | None = None) -> DataFrame:
        """Add the coarse bucket and, as `key`, what orders the rows within it: the time since the bucket's
        first cut in microseconds, and less than one more along the tie-breaker."""
        found = df.withColumn(name, time_key(df, self.time))
        if key:
            found = found.withColumn(key, F.col(name))
        found = _cut(found, name, self.time_cuts)
        if key:
            first = F.expr(f"array({', '.join(f'{c!r}D' for c in self.time_cuts)})")
            since = F.col(key) - F.get(first, F.greatest(F.col(name) - 1, F.lit(0)).cast("int"))
            found = found.withColumn(key, since + self._along_tie(*self.tie_range))
        return _cut(found.withColumn(name, self.position(name)), name, self.fine_cuts) if self.fine_cuts else found

    def _along_tie(self, low: float, span: float) -> Column:
        """The place of the tie-breaker in a range, from 0 to one half; a missing one comes first."""
        place = (F.col(self.tie).cast("double") - low) / (span or 1.0)
        return F.least(F.greatest(F.coalesce(place, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * 0.5

    def _is_hot(self, time_bucket: str) -> Column:
        return F.expr(f"{time_bucket} IN ({', '.join(map(str, self.hot))})")

    def position(self, time_bucket: str) -> Column:
        """Time bucket, moved on by less than 1 along the tie-breaker if it is a hot one."""
        moved = self._along_tie(self.tie_low, self.tie_span)
        return F.col(time_bucket) + F.when(self._is_hot(time_bucket), moved).otherwise(0.0)


def _cut(df: DataFrame, name: str, cuts: Sequence[float]) -> DataFrame:
    """Replace a double by the number of cuts at or below it (a binary search per row in the JVM)."""
    found = f"{name}_cut"
    cutter = Bucketizer(splits=[-_INF, *cuts, _INF], inputCol=name, outputCol=found)
    return cutter.transform(df).withColumn(name, F.col(found).cast("long")).drop(found)


def _count_below(cuts: Column, value: Column) -> Column:
    """How many of the sorted cuts are at or below a value, by binary search; a missing value is below all."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(FINE.bit_length()))])

    def step(low: Column, size: Column) -> Column:
        return F.when(F.get(cuts, low + size - 1) <= value, low + size).otherwise(low)

    return F.aggregate(steps, F.lit(0), step).cast("long")


def fit_order_buckets(df: DataFrame, time: str = "datetime", tie: str = "reading_id",
                      buckets: int | None = None, coarse: int = COARSE) -> OrderBuckets:
    """Cut the rows of `df`, ordered by (time, tie), into about `buckets` equal buckets.

    Any frame with the same ordering columns will do: cuts taken from a raw
    table stay right, only less even, for a filtered one. Beyond `coarse` buckets, cuts are made in two levels.
    """
    buckets = buckets or default_buckets(df.select(time))
    outer = _fit_cuts(df, time, tie, min(buckets, coarse))
    parts = min(FINE, -(-buckets // coarse))
    if parts < 2 or outer.single:
        return outer
    key = f"{BUCKET}_key"
    limits = df.agg(F.min(tie).cast("double").alias("low"), F.max(tie).cast("double").alias("high")).first()
    outer = replace(outer, tie_range=(limits.low or 0.0, (limits.high or 0.0) - (limits.low or 0.0)))
    placed = outer._outer(df.select(time, tie), BUCKET, key)
    quantiles = F.percentile_approx(key, [i / parts for i in range(1, parts)], 4 * parts)
    cuts = placed.groupBy(F.col(BUCKET).alias("bucket")).agg(F.array_sort(F.array_distinct(quantiles)).alias("cuts"))
    return replace(outer, table=written(cuts, "cuts"), parts=parts + 1)


def _fit_cuts(df: DataFrame, time: str, tie: str, buckets: int) -> OrderBuckets:
    """Cuts of one level, which the driver holds."""
    found = _quantiles(df, time_key(df, time), buckets)
    # A timestamp (or a missing one) that is two quantiles in a row fills at least a
    # whole bucket. It is set apart only where each timestamp has a key of its own.
    hot_times = sorted({a for a, b in zip(found, found[1:])
                        if a == b and (a == _NULL_KEY or _LOWEST_KEY < a < 2.0 ** 53)})
    cuts = tuple(sorted(set(found) | {h + 1.0 for h in hot_times}))
    timed = OrderBuckets(time, tie, cuts)
    if not hot_times:
        return timed

    hot = tuple(cuts.index(h) + 1 for h in hot_times)
    hot_rows = timed.assign(df).filter(f"{BUCKET} IN ({', '.join(map(str, hot))})")
    limits = hot_rows.agg(F.min(tie).cast("double").alias("low"), F.max(tie).cast("double").alias("high")).first()
    if limits.low is None or limits.low == limits.high:
        return timed
    placed = replace(timed, hot=hot, tie_low=limits.low, tie_span=limits.high - limits.low)
    pieces = sum(q in set(hot_times) for q in found) + 1
    inner = _quantiles(hot_rows, placed.position(BUCKET), pieces)
    return replace(placed, fine_cuts=tuple(sorted({float(n) for n in range(1, len(cuts) + 1)} | set(inner))))


def windowed(df: DataFrame, columns: Mapping[str, Callable[[WindowSpec], Column]],
             buckets: OrderBuckets, by: Sequence[str] = (), back: int = 3,
             uses: Sequence[str] = ()) -> DataFrame:
    """Add window columns over the order (time, tie) within each `by` group.

    Each entry of `columns` gets the ordered window and returns a column. It may
    look at the current row and up to `back` rows before it, and may read `uses`.
    """
    time, tie = buckets.time, buckets.tie
    if buckets.single:
        plain = Window.partitionBy(*by, F.lit(0)).orderBy(time, tie)
        return df.withColumns({name: make(plain) for name, make in columns.items()})

    both = with_halo(df, buckets, by, back, uses)
    spec = Window.partitionBy(*by, BUCKET).orderBy(time, tie)
    added = both.withColumns({name: make(spec) for name, make in columns.items()})
    return added.filter(F.col(OWN)).drop(OWN, BUCKET)


def with_halo(df: DataFrame, buckets: OrderBuckets, by: Sequence[str] = (), back: int = 3,
              uses: Sequence[str] = ()) -> DataFrame:
    """The rows with their bucket, and for each (group, bucket) the `back` rows before it once more.

    The latter are marked by `_own` = false and have the columns `uses` only. A window by (group,
    bucket) that reaches back `back` rows at most is right for the other rows.
    """
    time, tie = buckets.time, buckets.tie
    rows = buckets.assign(df)
    if buckets.single:
        return rows.withColumn(OWN, F.lit(True))
    halo = _preceding_rows(rows, by, time, tie, [c for c in uses if c not in (time, tie, *by)], back)
    return rows.withColumn(OWN, F.lit(True)).unionByName(halo.withColumn(OWN, F.lit(False)), allowMissingColumns=True)


def _preceding_rows(rows: DataFrame, by, time, tie, uses, back) -> DataFrame:
    """For every (group, bucket) the `back` rows of the group right before it."""
    rank, before, halo = "_rank", "_before", "_halo"
    latest = Window.partitionBy(*by, BUCKET).orderBy(F.desc(time), F.desc(tie))
    tails = (rows.select(*by, BUCKET, time, tie, *uses)
             .withColumn(rank, F.row_number().over(latest))
             .filter(F.col(rank) <= back))
    # The tails hold at most `back` rows per (group, bucket), so one group of
    # them is bounded by the number of buckets, not by the data.
    sequence = Window.partitionBy(*by, F.lit(0)).orderBy(time, tie)
    return (tails
            .select(*by, BUCKET,
                    F.lag(BUCKET).over(sequence).alias(before),
                    F.collect_list(F.struct(time, tie, *uses))
                    .over(sequence.rowsBetween(-back, -1)).alias(halo))
            .filter(F.col(before) != F.col(BUCKET))
            .select(*by, BUCKET, F.inline(halo)))


def numbered(df: DataFrame, buckets: OrderBuckets, name: str,
             low: int | None = None, high: int | None = None) -> DataFrame:
    """Add the 1-based row number in the order (time, tie); keep rows `low`..`high` if given.

    Rows per bucket are counted first; the counts (one row per bucket) give each
    bucket its first number and tell which buckets a range touches, so that only
    those are sorted.
    """
    time, tie = buckets.time, buckets.tie
    size, start = "_size", "_start"
    rows = buckets.assign(df)
    sizes = rows.groupBy(BUCKET).agg(F.count("*").alias(size))
    running = Window.partitionBy(F.lit(0)).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn(start, F.coalesce(F.sum(size).over(running), F.lit(0)))
    if low is not None:
        starts = starts.filter(F.col(start) + F.col(size) >= low)
    if high is not None:
        starts = starts.filter(F.col(start) < high)
    within = Window.partitionBy(BUCKET).orderBy(time, tie)
    result = (rows.join(F.broadcast(starts.select(BUCKET, start)), BUCKET)
              .withColumn(name, F.row_number().over(within) + F.col(start))
              .drop(BUCKET, start))
    if low is not None:
        result = result.filter(F.col(name) >= low)
    if high is not None:
        result = result.filter(F.col(name) <= high)
    return result


def slice_rows(df: DataFrame, start: int, count: int, buckets: OrderBuckets | None = None,
               time: str = "datetime", tie: str = "reading_id") -> DataFrame:
    """Rows `start`..`start + count - 1` (from 0) in the order (time, tie).

    Rows are counted per bucket and only the buckets of the slice are sorted, so the work of the last step
    depends on the slice alone, not on the tasks before it.
    """
    position = "_position"
    return numbered(df, buckets or fit_order_buckets(df, time, tie), position, start + 1,
                    start + count).drop(position)
