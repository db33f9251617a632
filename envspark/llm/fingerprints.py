"""Document fingerprints by one-permutation MinHash, in SQL functions only.

Each word shingle is hashed once; the top bits of the hash choose one of `BINS` bins and the
least hash of a bin is its value. An empty bin takes the value of a filled one: by optimal
densification it tries bins that a hash of (bin, attempt) names, and after `ATTEMPTS` misses takes
the filled bin of least hash of (bin, filled bin), which depends on nothing but the set of
filled bins. The low `BITS` bits of each value are packed, 16 bins to a long. The likeness of two
fingerprints is the share of equal bins, corrected for bins that agree by chance.

Next documents: the table is cut into buckets along (id, hash of the text) by approximate
quantiles; the first row of each bucket travels to the bucket before as well, so that a window
over a bucket sees every successor.

Cases: a text without words has an empty fingerprint, whose likeness is 1 to another empty one and
else 0; fewer words than a shingle make one shingle; a null text counts as empty; null
ids stand first; rows of one id follow each other by hash of the text, and equal rows are
interchangeable; a single row is its own next; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envspark.llm.common import partitions

SHINGLE_WORDS = 5
BIN_BITS, BITS = 8, 4
BINS, PER_LONG = 1 << BIN_BITS, 64 // BITS
ATTEMPTS = 8
MAX_BUCKETS = 65_536

_VALUE_BITS = 64 - BIN_BITS
_VALUES = (1 << _VALUE_BITS) - 1
_LOW = (1 << BITS) - 1
_NIBBLES = sum(1 << (BITS * i) for i in range(PER_LONG))


def let(value: Column, body) -> Column:
    """body(value) with `value` computed once."""
    return F.transform(F.array(value), body)[0]


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, _VALUE_BITS)


def _empty(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_VALUES)) == F.lit(_VALUES)


def _low(x: Column, place: Column) -> Column:
    """Low bits of a value as bin `place` stores it; hashed with the bin, so that borrowed values agree
    by chance in each bin for itself."""
    return F.xxhash64(x, place).bitwiseAND(F.lit(_LOW))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def packed(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as longs; no elements for a text without words."""
    # one mark per bin, above all other hashes of the bin: after sorting, the first of each bin is its least
    marks = F.array(*[F.lit(_signed((b << _VALUE_BITS) | _VALUES)) for b in range(BINS)])

    def of_words(words: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - shingle, F.lit(0))),
                             lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(shingle)]))
        filled = let(F.sort_array(F.concat(hashes, marks)),
                     lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(let(filled, dense))

    def dense(filled: Column) -> Column:
        def borrowed(x: Column, place: Column) -> Column:
            tries = [let(F.get(filled, F.pmod(F.xxhash64(place, F.lit(t)), F.lit(BINS)).cast("int")),
                         lambda y: F.when(~_empty(y), _low(y, place))) for t in range(ATTEMPTS)]
            last = F.array_min(F.transform(
                F.filter(filled, lambda y: ~_empty(y)),
                lambda y: F.xxhash64(place, _bin(y)).bitwiseAND(F.lit(~_LOW)).bitwiseOR(_low(y, place))))
            return F.coalesce(*tries, last.bitwiseAND(F.lit(_LOW)))

        values = F.transform(filled, lambda x, place: F.when(_empty(x), borrowed(x, place)).otherwise(_low(x, place)))
        return let(values, lambda v: F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), lambda j: F.aggregate(
            F.slice(v, j * PER_LONG + 1, PER_LONG), F.lit(0).cast("long"),
            lambda a, b: F.shiftleft(a, BITS).bitwiseOR(b))))

    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return let(words, of_words)


def as_text(longs: Column) -> Column:
    """A packed fingerprint as hexadecimal digits, one per bin."""
    return F.concat_ws("", F.transform(longs, lambda x: F.lpad(F.lower(F.hex(x)), PER_LONG * BITS // 4, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two packed fingerprints, 0 to 1."""
    def unequal(d: Column) -> Column:
        pairs = let(d.bitwiseOR(F.shiftrightunsigned(d, 1)), lambda x: x.bitwiseOR(F.shiftrightunsigned(x, 2)))
        return F.bit_count(pairs.bitwiseAND(F.lit(_NIBBLES)))

    off = F.aggregate(F.zip_with(a, b, lambda x, y: unequal(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    known = F.greatest(F.lit(0.0), (1 - off / F.lit(float(BINS)) - chance) / (1 - chance))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(known))


def _with_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """Add `bucket`, which never decreases along (id, turn), by quantiles of the id; an id that fills
    several buckets is cut further along `turn`, the place of its text's hash in [0, 1)."""
    number = rows.withColumn("at", F.coalesce(F.col("id").cast("double"), F.lit(-math.inf)))
    found = number.filter("id IS NOT NULL").approxQuantile(
        "at", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)) if buckets > 1 else []
    hot = {x: found.count(x) for x in found if found.count(x) > 1 and abs(x) < 2 ** 53}
    nulls, total = rows.agg(F.count_if(F.col("id").isNull()), F.count("*")).first()
    cuts = sorted({*found, *(math.nextafter(x, math.inf) for x in hot)})
    placed = number.withColumn("place", F.lit(0.0))
    if cuts:
        placed = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="at", outputCol="place").transform(number)
    parts = F.lit(1)
    for x, times in hot.items():
        parts = F.when(F.col("at") == x, F.lit(times)).otherwise(parts)
    share = max(1, nulls * buckets // max(1, total))
    parts = F.when(F.col("id").isNull(), F.lit(share)).otherwise(parts)
    # nulls come before the ids of the first bucket
    base = F.when(F.col("id").isNull(), F.lit(-1)).otherwise(F.col("place")).cast("long")
    return placed.withColumn("bucket", base * MAX_BUCKETS + F.floor(F.col("turn") * parts)).drop("at", "place")


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                  buckets: int | None = None) -> DataFrame:
    """`key`, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text whose last n_chars // 2 code points are replaced by the first as many (or
    all) of the next document.
    """
    spark = docs.sparkSession
    buckets = min(MAX_BUCKETS, buckets or 4 * partitions(spark))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(body).alias("body"), body.alias("text"))
    rows = rows.withColumn("turn", F.shiftrightunsigned("body", 11) / F.lit(float(1 << 53)))
    placed = _with_buckets(rows, buckets)
    firsts = sorted(placed.groupBy("bucket").agg(F.min(F.struct("id", "turn", "body")).alias("row")).collect(),
                    key=lambda r: r.bucket)
    # the first row of each bucket also goes to the bucket before it, that of the first one to the last
    goes = [(firsts[i].row["id"], firsts[i].row["body"], firsts[i].bucket, firsts[i - 1].bucket) for i in range(len(firsts))]
    kind = dict(rows.dtypes)["id"]
    ahead = spark.createDataFrame(goes, f"f_id {kind}, f_body long, bucket long, before long")
    marked = placed.withColumn("fp", packed(F.col("text"), shingle)).join(
        F.broadcast(ahead), (F.col("id").eqNullSafe(F.col("f_id"))) & (F.col("body") == F.col("f_body"))
        & (placed["bucket"] == ahead["bucket"]), "left").drop(ahead["bucket"])
    copies = marked.withColumn("to", F.explode(F.array_compact(F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("halo")),
        F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("bucket"), F.lit(True).alias("halo")))))))
    along = Window.partitionBy("b").orderBy("halo", "id", "turn", "body")
    seen = (copies.select(F.col("to.bucket").alias("b"), F.col("to.halo").alias("halo"), "id", "turn", "body", "text", "fp")
            .withColumn("next", F.lead(F.struct("text", "fp")).over(along)).filter("NOT halo"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    both = (seen.select("id", "fp", n.cast("long").alias("n_chars"), edited.alias("edited"), F.col("next.fp").alias("next_fp"))
            .withColumn("edited_fp", packed(F.col("edited"), shingle)))
    return both.select(
        F.col("id").alias(key), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
