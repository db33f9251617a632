"""Exact quantiles per group without gathering a group.

Spark's `percentile` keeps every distinct value of a group in one buffer. Here
approximate quantiles cut the value range into buckets, rows per (group, bucket)
are counted, and only the buckets that hold a wanted rank are looked at closely.
Equal values are counted together before the shuffle, so a frequent value is one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from envspark.functions import temporal
from envspark.operators.windows import default_buckets

_INF = float("inf")


def exact_quantiles(df: DataFrame, group: str, value: str, probabilities: Sequence[float],
                    buckets: int | None = None) -> DataFrame:
    """(group, probability, quantile, count) of every group, a missing one included, with linear
    interpolation. NULL and NaN values are left out; a group without any other value has no rows.

    The value column is evaluated three times: persist a frame of group and value if it is costly.
    """
    # NULL and NaN are left out by counting, not by a filter: a filter on a computed
    # value would be pushed down and repeat its whole expression for every mention.
    buckets = buckets or default_buckets(df)
    known = df.select(F.struct(group).alias("g"), F.col(value).cast("double").alias("v"))
    usable = F.count(F.when(~F.isnan("v"), F.col("v")))
    cuts = sorted(set(known.approxQuantile("v", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)))
                  ) if buckets > 1 else []
    if cuts:
        cutter = Bucketizer(splits=[-_INF, *cuts, _INF], inputCol="v", outputCol="b", handleInvalid="keep")
        bucketed = cutter.transform(known).withColumn("b", F.coalesce(F.col("b").cast("int"), F.lit(-1)))
    else:
        bucketed = known.withColumn("b", F.lit(0))

    # one row per group and bucket; `g` is a struct, so that a missing group joins like any other
    sizes = bucketed.groupBy("g", "b").agg(usable.alias("n"))
    by_group = Window.partitionBy("g")
    spans = sizes.filter("n > 0").select(
        "g", "b", "n", F.sum("n").over(by_group).alias("total"),
        F.coalesce(F.sum("n").over(by_group.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("start"))
    # ranks count from 0; a quantile lies between the ranks below and above its position
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    position = F.col("probability") * (F.col("total") - 1)
    ranks = (spans.select("*", wanted).withColumn("position", position)
             .withColumn("rank", F.explode(F.array_distinct(F.array(
                 F.floor("position"), F.ceil("position")))))
             .filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("n"))))

    # at most two rows per group and probability; Spark broadcasts them if they are few
    touched = ranks.select("g", "b", "start").distinct()
    candidates = (bucketed.join(touched, ["g", "b"])
                  .groupBy("g", "b", "start", "v").agg(usable.alias("k")))
    running = (Window.partitionBy("g", "b").orderBy("v")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = candidates.withColumn("end", F.col("start") + F.sum("k").over(running))
    hit = (runs.select("g", "b", "v", "k", "end").join(ranks, ["g", "b"])
           .filter((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("k"))))
    weight = F.col("position") - F.floor("position")
    low, high = F.min("v"), F.max("v")
    return (hit.groupBy("g", "probability", "position", "total").agg(low.alias("low"), high.alias("high"))
            .select(F.col("g")[group].alias(group), "probability",
                    (F.col("low") + weight * (F.col("high") - F.col("low"))).alias("quantile"),
                    F.col("total").alias("count")))


def seasonal_quartiles(df: DataFrame, value: str = "aqi", approximate: bool = False) -> DataFrame:
    """Minimum, quartiles and maximum by season. `approximate` trades exactness for a single pass."""
    seasonal = df.select(temporal.season(F.col("month")).alias("season"), F.col(value).alias("v"))
    names = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    if approximate:
        points = F.percentile_approx("v", list(names.values()), 100_000)
        return (seasonal.groupBy("season").agg(F.count("v").alias("count"), points.alias("p"))
                .select("season", "count", *[F.col("p")[i].alias(n) for i, n in enumerate(names)]))
    exact = exact_quantiles(seasonal, "season", "v", list(names.values()))
    return exact.groupBy("season").agg(F.max("count").alias("count"), *[
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(n) for n, p in names.items()])


# --- stored sketches --------------------------------------------------------

#: size of a sketch and the rank error it keeps, also after merging, with 99 % confidence
SKETCH_K = 800
SKETCH_ERROR = 0.0075


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """(by, sketch, n): a few kilobytes per group that stand for the distribution of its values.

    Sketches of days can be stored and merged later into those of any longer span, so a quantile over
    years needs neither the rows nor a new pass. NULL and NaN are left out.
    """
    usable = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(usable, k).alias("sketch"), F.count(usable).alias("n"))


def merged_sketches(sketches: DataFrame, by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones."""
    kept = sketches.filter(F.col("n") > 0)
    return kept.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def sketched_quantiles(sketches: DataFrame, by: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """(by, n, one column per named probability), each within `SKETCH_ERROR` of its rank."""
    return sketches.select(*by, "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name)
                                       for name, p in probabilities.items()])
