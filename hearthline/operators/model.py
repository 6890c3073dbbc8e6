"""Price model: fit on the training part, predict every row, score the hold-out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.operators.features import feature_stages, require_bounded_categories
from hearthline.schemas import CATEGORY_COLUMNS, NUMERIC_COLUMNS


def price_pipeline(
    categories: Sequence[str] = CATEGORY_COLUMNS,
    numerics: Sequence[str] = NUMERIC_COLUMNS,
    price: str = "price",
    trees: int = 20,
    depth: int = 10,
    seed: int = 42,
    bootstrap: bool = True,
    feature_subset: str = "auto",
) -> Pipeline:
    """Index, encode, assemble, random forest.

    Without ``bootstrap`` and with ``feature_subset`` "all" every tree sees the same data.
    """
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=price,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        bootstrap=bootstrap,
        featureSubsetStrategy=feature_subset,
    )
    return Pipeline(stages=[*feature_stages(categories, numerics), forest])


def fit_model(
    train: DataFrame,
    categories: Sequence[str] = CATEGORY_COLUMNS,
    numerics: Sequence[str] = NUMERIC_COLUMNS,
    price: str = "price",
    max_categories: int | None = None,
    **forest: int | bool | str,
) -> PipelineModel:
    """Fit; ``max_categories`` refuses wider category columns first, at the cost of a pass."""
    if max_categories is not None:
        require_bounded_categories(train, categories, max_categories)
    return price_pipeline(categories, numerics, price, **forest).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction`` to every row, without the feature columns the model works on."""
    return model.transform(df).select(*df.columns, "prediction")


def regression_metrics(
    df: DataFrame, actual: str = "price", predicted: str = "prediction"
) -> DataFrame:
    """``rows``, ``rmse``, ``mae`` and ``r2`` (null where all prices are equal) in one pass, one row."""
    error = F.col(actual) - F.col(predicted)
    squared = F.avg(error * error)
    return df.agg(
        F.count("*").alias("rows"),
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(squared, F.var_pop(actual))).alias("r2"),
    )
