"""Mixing sources to target weights by repeating whole documents.

1. Words are counted per document and summed per source: one row per source from then on.
2. Sources in code-point order, null last, take the weights in turn. All targets together are `share`
   times all words. A target ends at `limit` times its source's words; what is cut off is dealt to the
   others by weight, again and again until no target is above its end. Each round is one sum
   over the table of sources.
3. A source is repeated target / words times: each document floor(rate) times, and once more if its
   hash, a number in [0, 1), is below the fraction of the rate. The hash depends on the
   seed, the id and the text alone, so reruns and retried tasks agree.

The table of sources is joined back. Spark broadcasts it while it is small; beyond that
a join on the source splits a hot source over tasks, as the documents' side needs no grouping.

Cases: a null or empty text has no words and is repeated like any other document of its source; a source
without words has target 0 and rate 0; rows equal in id and text are taken equally often; a null id
counts as a value of its own; a null source is a source; a very long text is one row with its share of
chance; an empty table gives no rows; other columns stay as they are, added names get `_` when taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envspark.llm.common import fresh, stash

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2.0
SEED = 42
#: words lie between ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 13  # hexadecimal digits of the hash: 52 bits, exact as a double


def chance(key: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the seed, the id and the text."""
    parts = [F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null")),
             F.coalesce(F.md5(text.cast("binary")), F.lit("null"))]
    digits = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, _DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** _DIGITS))


def with_weights(sources: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Add `weight`: the weights in turn over the sources in code-point order, null last.

    The rows are sorted by ranges and numbered within each range; a range's first number
    comes from the counts of the ranges before it, of which there are as many as shuffle partitions.
    """
    spark = sources.sparkSession
    place = F.monotonically_increasing_id()  # range in the upper bits, row of the range below
    placed = stash(sources.orderBy(F.asc_nulls_last("source")).withColumn("_place", place))
    span, inside = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (placed.groupBy(span.alias("_range")).agg(F.count("*").alias("_n"))
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    number = ((F.col("_first") + inside) % len(weights)).cast("int")
    return (placed.withColumn("_range", span).join(F.broadcast(ranges), "_range")
            .withColumn("weight", F.get(turn, number)).select("source", "source_size", "weight"))


def with_targets(sources: DataFrame, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """Add `target` to (source, source_size, weight): the shares by weight, ended at `limit` times the size.

    With a level L, a target is the smaller of L * weight and its end. L rises from round to
    round, as the words cut off are dealt to the sources that are not at their end, and stops when a round finds no new one.
    """
    end = F.col("source_size") * F.lit(float(limit))
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    wanted = share * (whole.size or 0)
    level, ended = (wanted / whole.weight if whole.weight else 0.0), 0
    while True:
        above = F.lit(level) * F.col("weight") >= end
        state = sources.agg(F.count_if(above).alias("ended"), F.sum(F.when(above, end)).alias("taken"),
                            F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        if not state.open or state.ended == ended:
            break
        level, ended = (wanted - (state.taken or 0.0)) / state.open, state.ended
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), end))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
          seed: int = SEED) -> tuple[DataFrame, list[str]]:
    """The documents with size, source_size, target and copies, and the names of these four columns.

    `copies` is how often the mix takes a document; `limit` is a whole number, so that no document is
    taken more often. Weights are above 0.
    """
    if limit != int(limit) or min(weights) <= 0:
        raise ValueError("the limit is a whole number and weights are above 0")
    taken = docs
    for wanted in ("size", "source_size", "target", "copies", "_source"):
        taken = taken.withColumn(fresh(taken, wanted), F.lit(None).cast("long"))
    *names, group = taken.columns[len(docs.columns):]
    size, source_size, target, copies = names
    counted = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.withColumn(size, counted)
    totals = sized.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).alias("source_size"))
    sources = with_targets(stash(with_weights(totals, weights)), share, limit)
    side = sources.select(F.col("source").alias(group), F.col("source_size").alias(source_size), F.col("target").alias(target))
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    drawn = chance(F.col(f"`{key}`"), F.col(f"`{text}`"), seed) < rate - F.floor(rate)
    found = sized.join(side, F.col(f"`{source}`").eqNullSafe(F.col(group)), "left").drop(group)
    return found.withColumn(copies, F.floor(rate).cast("long") + drawn.cast("long")), names


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of `docs`."""
    found, names = mixed(docs, **options)
    copies = names[-1]
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    turn = fresh(found, "_turn")
    return found.filter(F.col(copies) > 0).withColumn(turn, each).select(*[F.col(f"`{c}`") for c in docs.columns])
