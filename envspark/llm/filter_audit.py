"""How filters interact: what each removes in every order, what it alone removes, and what good text it costs.

1. One scan finds, per document, which of the filters A to D it fails, as bits, and a hash of its text.
2. Filter E, "a smaller id has this very text", is an existential self-join. Texts whose hash occurs once
   cannot match and stay behind. Of the others, each distinct text is one row with its smallest id, and a
   left-semi join on hash and text with that id below the document's own marks E.
3. The failing ids of A to D and those of E are united, and bits are combined per document.
   With the labels joined, one histogram remains: rows per part and combination, of which there are 32.
   Combinations without a failure are what is left of all documents.
4. Every order and step is a sum over the histogram: removed here are the combinations with this filter's bit and none
   of the earlier ones, and so on. Over all orders a filter comes first among the k failed ones in
   one of k, which gives the Shapley sums without going through the orders.

A hash that more than one of `HEAVY` rows has is cut: its documents are dealt to `SALTS` salts, and its
few texts are sent to each of them. There are at most `HEAVY` such hashes, so the list of them may be broadcast.

Cases: a null text is an empty one, and equal to it; an empty text has no words (fails A; not B and C, as 0 is
not below or above 0); ids smaller than a null do not exist, nor has a null id smaller ones; rows equal in id
and text are judged alike and all counted; a null part is the empty string; labels that repeat an id count
as good or toxic if one of them says so, labels without an id are ignored; a very long text is one row, with its words in one array; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envspark.llm.common import stash

FILTERS = "ABCDE"
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
MARKS = r"[#$%&*|]"
WORD = r"[^\x20\x09-\x0D]+"
HEAVY = 1000
SALTS = 64


def failed_bits(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; the filters look at nothing but the text."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    counts = F.struct(F.size(words).alias("words"), F.size(F.array_distinct(words)).alias("distinct"))
    few = lambda c: c["words"] < MIN_WORDS
    repeated = lambda c: 100 * c["distinct"] < MIN_DISTINCT_PERCENT * c["words"]
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    loud = 100 * capitals > MAX_CAPITAL_PERCENT * F.length(text)
    marked = F.regexp_like(text, F.lit(MARKS))
    bit = lambda name, failed: F.when(failed, F.lit(BIT[name])).otherwise(F.lit(0))
    of_words = F.transform(F.array(counts), lambda c: bit("A", few(c)) + bit("B", repeated(c)))  # counted once
    return (of_words[0] + bit("C", loud) + bit("D", marked)).cast("int")


def _later_copies(rows: DataFrame, narrow: DataFrame) -> DataFrame:
    """(id, hash, part) of the rows of `rows` whose text some smaller id has."""
    repeated = stash(narrow.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > 1))
    total = narrow.count()
    heavy = F.broadcast(repeated.filter(F.col("n") * HEAVY > total).select("hash", F.lit(SALTS).alias("salts")))

    def salted(df, salt):
        """Rows of heavy hashes get the salt, others 0."""
        return (df.join(heavy, "hash", "left")
                .withColumn("salt", F.when(F.col("salts").isNotNull(), salt(F.col("salts"))).otherwise(F.lit(0)))
                .drop("salts"))

    def to_all(df):
        every = F.when(F.col("salts").isNotNull(), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.lit(0)))
        return df.join(heavy, "hash", "left").withColumn("salt", F.explode(every)).drop("salts")

    own = salted(rows, lambda n: F.pmod(F.xxhash64("id"), n).cast("int"))
    candidates = stash(own.join(to_all(repeated.select("hash")), ["hash", "salt"], "left_semi"))
    # each distinct text once, with its smallest id; tasks combine copies before they are sent
    firsts = to_all(candidates.groupBy("hash", "text").agg(F.min("id").alias("first")))
    left, right = candidates.alias("l"), firsts.alias("r")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("hash", "salt", "text")]
    return left.join(right, [*same, F.col("r.first") < F.col("l.id")], "left_semi").select("id", "hash", "part")


def combinations(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                 part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, as bits in the order of `FILTERS`.

    Parts without a document that fails nothing have no row of mask 0.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
                       F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part")).withColumn("hash", F.xxhash64("text"))
    narrow = stash(rows.select("id", "hash", "part", failed_bits(F.col("text")).alias("bits")))
    copies = _later_copies(rows, narrow).withColumn("bits", F.lit(BIT["E"]))
    # a document is here once for A to D, once for E, or both
    times = lambda is_copy: F.count(F.when((F.col("bits") == BIT["E"]) == F.lit(is_copy), 1))
    failing = (narrow.filter(F.col("bits") != 0).unionByName(copies).groupBy("id", "hash", "part")
               .agg(F.bit_or("bits").alias("mask"), F.greatest(times(False), times(True)).alias("n")))

    said = (labels.filter(F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").alias("id"))
            .agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")))
    named = failing.filter(F.col("id").isNotNull()).join(said, "id", "left")
    nameless = failing.filter(F.col("id").isNull()).select("part", "mask", "n", F.lit(None).cast("boolean").alias("good"),
                                                          F.lit(None).cast("boolean").alias("toxic"))
    weigh = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(F.lit(0))).alias(flag)
    lost = stash(named.select(*nameless.columns).unionByName(nameless)
                 .groupBy("part", "mask").agg(F.sum("n").alias("n"), weigh("good"), weigh("toxic")))
    every = narrow.groupBy("part").agg(F.count("*").alias("n"))
    clean = (every.unionByName(lost.select("part", (-F.col("n")).alias("n")))
             .groupBy("part").agg(F.sum("n").alias("n")))
    nothing = F.lit(0).cast("long")  # labels of documents that stay are not asked for
    return lost.unionByName(clean.select("part", F.lit(0).alias("mask"), "n", nothing.alias("good"), nothing.alias("toxic")))


def _steps() -> Column:
    """Every order and step as a literal array: the order, the step, the filter's bit and the bits before it."""
    made = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            made.append(f"named_struct('filter_order', '{order}', 'step', {step}, 'own', {BIT[name]}, 'before', {before})")
            before |= BIT[name]
    return F.expr(f"array({', '.join(made)})")


def audited(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step, zeros included."""
    found = combinations(docs, labels, key, text, part)
    columns = F.collect_list(F.struct("mask", "n", "good", "toxic"))  # at most 33 entries
    by_part = found.groupBy("part").agg(columns.alias("cells"))
    stepped = by_part.select("part", "cells", F.explode(_steps()).alias("s")).select("part", "cells", "s.*")

    def total(condition, value):
        cell = lambda sum_, c: sum_ + F.when(condition(c["mask"]), value(c)).otherwise(F.lit(0).cast("long"))
        return F.aggregate("cells", F.lit(0).cast("long"), cell)

    own, before = F.col("own"), F.col("before")
    fails, passed = lambda m: m.bitwiseAND(own) != 0, lambda m: m.bitwiseAND(before) == 0
    here = lambda m: fails(m) & passed(m)
    orders = factorial(len(FILTERS))
    return stepped.select(
        "part", "filter_order", "step",
        total(lambda m: m.bitwiseAND(before.bitwiseOR(own)) == 0, lambda c: c["n"]).alias("kept"),
        total(here, lambda c: c["n"]).alias("removed"),
        total(lambda m: fails(m) & ~passed(m), lambda c: c["n"]).alias("redundant"),
        total(lambda m: m == own, lambda c: c["n"]).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"),
        total(here, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, lambda c: c["n"] * (F.lit(orders) / F.greatest(F.bit_count(c["mask"]), F.lit(1))).cast("long")).alias("shapley"))
