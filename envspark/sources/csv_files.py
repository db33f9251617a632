"""CSV files of readings whose bad rows are told apart instead of turning into NULLs.

The files may name their columns in different orders: each file is read by its own header. One scan
types the rows and routes them: `ingest` writes accepted and rejected rows in the same job.

A row is rejected if Spark's CSV parser calls it malformed (a number that is none, too few or too many
fields) or if its datetime is text that is no timestamp. Empty fields are missing values, not bad ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.sources.readings import KEYED_CSV_SCHEMA, typed

#: different headers among the files of one read
MAX_HEADERS = 100
STATUS, REASON, RECORD, FILE, FIELDS = "_status", "_reason", "_record", "_file", "_fields"
ACCEPTED, REJECTED = "accepted", "rejected"


def headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(header line, files) of every different header below `path`; the files are listed, their rows are not."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place")).filter("start = 0")
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    rows = found.limit(MAX_HEADERS + 1).collect()
    if len(rows) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers below {path}")
    return [(r.header, r.files) for r in rows]


def _reason(record: Column, columns: list[T.StructField]) -> Column:
    """What is wrong with a malformed record: its number of fields or the first one that is of another type."""
    plain = ", ".join(f"c{i} string" for i in range(len(columns)))
    texts = F.from_csv(record, F.lit(plain))
    n_fields = F.length(F.regexp_replace(F.regexp_replace(record, '"[^"]*"', ""), "[^,]", "")) + 1
    bad = [F.when(texts[f"c{i}"].isNotNull() & texts[f"c{i}"].try_cast(f.dataType).isNull(),
                  F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
           for i, f in enumerate(columns) if not isinstance(f.dataType, T.StringType)]
    wrong = F.concat(n_fields.cast("string"), F.lit(f" fields instead of {len(columns)}"))
    return F.when(n_fields != len(columns), wrong).otherwise(F.coalesce(*bad, F.lit("malformed")))


def _read(spark: SparkSession, header: str, files: list[str]) -> DataFrame:
    """The typed rows of files with one header, with status, reason, record, file and fields."""
    names = [n.strip().strip('"') for n in header.split(",")]
    known = {f.name: f for f in KEYED_CSV_SCHEMA.fields}
    columns = [known.get(n, T.StructField(n, T.StringType())) for n in names]
    raw = (spark.read.schema(T.StructType([*columns, T.StructField(RECORD, T.StringType())]))
           .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
           .csv(files).withColumn(FILE, F.col("_metadata.file_path")))
    plain = [F.col(f"`{n}`") for n in names]
    # Spark converts, and so checks, only fields that the plan reads: this, always true, reads them all
    checked = F.pmod(F.xxhash64(*plain), F.lit(2)) >= 0
    undated = F.col("datetime").isNotNull() & F.col("datetime").try_cast("timestamp_ntz").isNull()
    found = raw.withColumns({
        REASON: F.when(F.col(RECORD).isNotNull(), _reason(F.col(RECORD), columns))
                .when(undated, F.lit("datetime is no timestamp")),
        RECORD: F.when(undated & F.col(RECORD).isNull(), F.to_csv(F.struct(*plain))).otherwise(F.col(RECORD))})
    texts = F.from_csv(F.col(RECORD), F.lit(", ".join(f"c{i} string" for i in range(len(names)))))
    values = F.array(*[texts[f"c{i}"] for i in range(len(names))])
    found = found.withColumns({
        STATUS: F.when(checked & F.col(REASON).isNull(), F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)),
        FIELDS: F.when(F.col(REASON).isNotNull(), F.map_from_arrays(F.array(*[F.lit(n) for n in names]), values))})
    if "reading_id" not in names:  # the same hash whatever the order of the columns
        content = F.xxhash64(*[F.col(f"`{n}`") for n in sorted(names)])
        found = found.withColumn("reading_id", F.shiftrightunsigned(content, 12))
    return typed(found)


def routed(spark: SparkSession, path: str) -> DataFrame:
    """All rows below `path`, typed, with where they go (`_status`) and, if rejected, the reason, the text of the
    record, its file, and its fields by name. Spark parses again for each action on it; `ingest` does so once."""
    found = None
    for header, files in headers(spark, path):
        rows = _read(spark, header, files)
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    if found is None:
        raise ValueError(f"no file with a header below {path}")
    return found


def split(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted readings, and rejected records as (reason, record, file, fields)."""
    accepted = found.filter(F.col(STATUS) == ACCEPTED).drop(STATUS, REASON, RECORD, FILE, FIELDS)
    rejected = found.filter(F.col(STATUS) == REJECTED).select(*[F.col(c).alias(c[1:]) for c in (REASON, RECORD, FILE, FIELDS)])
    return accepted, rejected


def ingest(spark: SparkSession, path: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Read the files once, write accepted and rejected rows below `target` in one job, and return both as read from there."""
    found = routed(spark, path)
    found.write.partitionBy(STATUS).mode("overwrite").parquet(target)
    stored = spark.read.schema(found.schema).parquet(target)
    return split(stored)
