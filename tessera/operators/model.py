"""Random-forest model on the wide feature table (Spark ML).

* labelled rows only (``crash_count`` not null);
* features: every numeric column except the key and the label, in table
  order, assembled with ``VectorAssembler``;
* an 80/20 split that depends only on the key: the first 32 bits of
  ``md5(key)`` as a fraction of 2^32 (``randomSplit`` changes with the input
  partitioning; this does not);
* ``RandomForestRegressor`` with 100 trees and an explicit seed;
* RMSE on the held-out rows as a one-row DataFrame;
* every row scored, training rows included, and the predictions joined
  back onto the full grid (cells without features get null).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "grid_id"
LABEL = "crash_count"
TRAIN_FRACTION = 0.8
#: Partitions of the training rows, at least, and rows of a partition. Both are parameters of the result, so the
#: partitions follow the number of rows and not the cluster's size.
TRAIN_PARTITIONS = 32
TRAIN_ROWS = 100_000
NUM_TREES = 100
SEED = 42

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def feature_columns(df: DataFrame, key: str = KEY, label: str = LABEL) -> list[str]:
    """Numeric columns other than key and label, in table order."""
    return [f.name for f in df.schema.fields
            if f.name not in (key, label) and isinstance(f.dataType, _NUMERIC)]


def split_fraction(key: str = KEY) -> DataFrame | F.Column:
    """md5-based number in [0, 1) from the key's text."""
    h = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return h / F.lit(float(2 ** 32))


def assign_split(df: DataFrame, key: str = KEY, train_fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Add boolean ``is_train``."""
    return df.withColumn("is_train", split_fraction(key) < F.lit(train_fraction))


def assemble(df: DataFrame, key: str = KEY, label: str = LABEL) -> DataFrame:
    """Labelled rows with ``(key, label, features)``."""
    data = df.where(F.col(label).isNotNull())
    cols = feature_columns(data, key, label)
    va = VectorAssembler(inputCols=cols, outputCol="features")
    return va.transform(data).select(key, F.col(label).cast("double").alias(label), "features")


@dataclass
class FitResult:
    model: RandomForestRegressionModel
    assembled: DataFrame
    test_predictions: DataFrame


def fit_forest(features: DataFrame, key: str = KEY, label: str = LABEL,
               num_trees: int = NUM_TREES, seed: int = SEED,
               train_fraction: float = TRAIN_FRACTION) -> FitResult:
    assembled = assign_split(assemble(features, key, label), key, train_fraction)
    # Trees draw their samples by partition and row: hash partitions whose number follows from
    # the rows, sorted by key, make the forest the same whatever the input's partitioning.
    train = assembled.where("is_train")
    partitions = max(TRAIN_PARTITIONS, -(-train.count() // TRAIN_ROWS))
    train = train.repartition(partitions, key).sortWithinPartitions(key)
    test = assembled.where(~F.col("is_train"))
    rf = RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=num_trees, seed=seed)
    model = rf.fit(train)
    return FitResult(model, assembled, model.transform(test))


def rmse(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: rmse, n (held-out rows)."""
    err = F.col(label) - F.col("prediction")
    return predictions.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def score_all(fit: FitResult, key: str = KEY, label: str = LABEL) -> DataFrame:
    """``(key, label, prediction, is_train)`` for every labelled row."""
    return fit.model.transform(fit.assembled).select(key, label, "prediction", "is_train")


def scored_grid(grid: DataFrame, scored: DataFrame, id_col: str = "id", key: str = KEY) -> DataFrame:
    """Every grid row with its prediction (null where the cell had no features)."""
    pred = scored.select(F.col(key).alias("_k"), "prediction")
    return grid.join(pred, grid[id_col] == pred["_k"], "left").drop("_k")
