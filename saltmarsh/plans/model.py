"""Random-forest regression with a held-out part."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_forest(df: DataFrame, features: list[str], label: str, trees: int = 100, seed: int = 42) -> DataFrame:
    """(metric, value) on a fifth of the rows, chosen by a hash of the row so that reruns agree; rows with nulls go."""
    rows = df.na.drop(subset=[*features, label])
    part = F.pmod(F.xxhash64(F.lit(seed), *features, label), F.lit(5))
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(rows.withColumn("_part", part))
    model = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, seed=seed).fit(vectors.where("_part > 0"))
    scored = model.transform(vectors.where("_part = 0"))
    score = lambda m: RegressionEvaluator(labelCol=label, metricName=m).evaluate(scored)
    return df.sparkSession.createDataFrame([("mae", score("mae")), ("r2", score("r2"))], "metric string, value double")
