"""Keyed table to model, predictions and reports."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.split import split_at_random, split_by_key
from hearthline.operators.clean import clean_listings
from hearthline.operators.model import fit_model, predict, regression_metrics
from hearthline.operators.reports import (
    SAMPLE_COLUMNS,
    overall_statistics,
    prediction_sample,
    report_by_city,
    report_by_home_type,
)
from hearthline.schemas import KEY
from hearthline.scratch import materialize


class NoListingsError(RuntimeError):
    """No row is left to train on."""


class PriceReports(NamedTuple):
    rows: int
    cleaned: int
    model: PipelineModel
    predictions: DataFrame
    sample: DataFrame
    overall: DataFrame
    by_city: DataFrame
    by_home_type: DataFrame
    holdout: DataFrame


# How a row gets into the training part: by its key, or at random.
SPLITS = {"key": lambda df: split_by_key(df, KEY), "random": split_at_random}


def _split(cleaned: DataFrame, split: str) -> DataFrame:
    train, held_out = SPLITS[split](cleaned)
    return train.withColumn("in_train", F.lit(True)).union(held_out.withColumn("in_train", F.lit(False)))


def predict_prices(
    listings: DataFrame,
    output: str | None = None,
    split: str = "key",
    max_categories: int | None = None,
) -> PriceReports:
    """Clean, fit on the training part, predict every row, report.

    The cleaned rows are written once: training passes over them several times, a
    concurrent upsert may drop the snapshot they came from, and a random split must
    not be drawn anew by a task that runs twice. Predictions are written too (to
    ``output`` if given), so the forest runs once per row and each report reads two
    or three columns.
    """
    cleaned = materialize(_split(materialize(clean_listings(listings), "priced"), split), "cleaned")
    rows, train_rows = cleaned.agg(F.count("*"), F.count_if("in_train")).first()
    if not train_rows:
        raise NoListingsError(f"{rows} rows have a price, none of them to train on")
    model = fit_model(cleaned.filter("in_train"), max_categories=max_categories)
    scored = predict(model, cleaned)
    scored = scored.select(*SAMPLE_COLUMNS, "price", "prediction", "in_train")
    predictions = materialize(scored, "predictions", output)
    return PriceReports(
        rows=listings.count(),
        cleaned=rows,
        model=model,
        predictions=predictions,
        sample=prediction_sample(predictions),
        overall=overall_statistics(predictions),
        by_city=report_by_city(predictions),
        by_home_type=report_by_home_type(predictions),
        holdout=regression_metrics(predictions.filter(~F.col("in_train"))),
    )
