"""The random-forest pipeline on Spark ML: encode, assemble, scale, fit, score, explain."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.profiles import Profile, profile_of

ZONE_SLOT = "zone"

#: training rows up to which the parts of the frame are left alone
FEW_ROWS = 100_000
#: rows that a part should not exceed
PART_ROWS = 1_000_000


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that several jobs read; it spills to disk and is released afterwards."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def zone_indexer() -> StringIndexer:
    """Most frequent zone first; zones unseen in training share one extra index."""
    return StringIndexer(inputCol="zone", outputCol="zone_index", handleInvalid="keep")


def zone_encoder() -> OneHotEncoder:
    return OneHotEncoder(inputCols=["zone_index"], outputCols=["zone_encoded"])


def numeric_assembler(profile: str | Profile) -> VectorAssembler:
    return VectorAssembler(inputCols=list(profile_of(profile).features), outputCol="numeric_features",
                           handleInvalid="skip")


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="numeric_features", outputCol="scaled_features",
                          withMean=True, withStd=True)


def final_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=["scaled_features", "zone_encoded"], outputCol="features",
                           handleInvalid="skip")


def forest_pipeline(profile: str | Profile) -> Pipeline:
    p = profile_of(profile)
    # the fit remembers the node of every row in every tree, or each level would walk all rows down from the roots
    # again; the trees stay the same. Ten levels need no checkpoint, which would write these nodes out
    forest = RandomForestRegressor(labelCol="aqi", featuresCol="features", cacheNodeIds=True, checkpointInterval=-1,
                                   **p.forest)
    return Pipeline(stages=[zone_indexer(), zone_encoder(), numeric_assembler(p), scaler(),
                            final_assembler(), forest])


def fit_forest(train: DataFrame, profile: str | Profile) -> PipelineModel:
    """Fit on `train`, which several stages read: only the columns they need are kept meanwhile."""
    p = profile_of(profile)
    with persisted(train.select(*p.features, "zone", "aqi")) as rows:
        return forest_pipeline(p).fit(in_parts(rows))


def in_parts(rows: DataFrame) -> DataFrame:
    """The rows in as many parts as the cores need, or more if parts would exceed `PART_ROWS`.

    For each level of the trees every task builds and sends statistics of all nodes, a few kilobytes each and
    100 to 200 MB for 50 trees of depth 10, however few rows it has. So the work of a fit grows with the number of
    parts, and shuffles leave hundreds of them.
    """
    count = rows.count()
    if count <= FEW_ROWS:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(cores * -(-count // (cores * PART_ROWS)))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `prediction` and drop the intermediate vectors."""
    return model.transform(df).drop("zone_index", "zone_encoded", "numeric_features",
                                    "scaled_features", "features", "rawPrediction")


def feature_importance(model: PipelineModel, df: DataFrame, profile: str | Profile,
                       top: int | None = None) -> DataFrame:
    """(feature, importance, importance_pct, relative) by importance.

    Positions follow the final vector: scaled numeric inputs, then the one-hot
    slots, which add up to the zone. The rows come from the model, not from `df`,
    which only names the session.
    """
    names = list(profile_of(profile).features)
    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = [*zip(names, weights), (ZONE_SLOT, float(sum(weights[len(names):])))]
    frame = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    highest = max(w for _, w in rows)
    ranked = frame.select("feature", "importance", F.round(F.col("importance") * 100, 2).alias("importance_pct"),
                          (F.col("importance") / F.lit(highest or 1.0)).alias("relative")
                          ).orderBy(F.desc("importance"), "feature")
    return ranked if top is None else ranked.limit(top)
