import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hearthline.functions.split import hash_bucket, split_at_random, split_by_key
from hearthline.operators.features import feature_stages, require_bounded_categories
from hearthline.operators.model import fit_model, predict, regression_metrics
from hearthline.plans.train import NoListingsError, predict_prices
from hearthline.schemas import curated_schema


@pytest.fixture(scope="module")
def listings(spark):
    n = F.col("id")
    return spark.range(600).select(
        n.cast("string").alias("zpid"),
        F.concat(F.lit("city "), n % 7).alias("city"),
        F.when(n % 5 != 0, F.concat(F.lit("type "), n % 3)).alias("hometype"),
        F.when(n % 100 != 0, n * 1000).alias("price"),
        (n / 7).alias("lotareavalue"),
        (n % 4).cast("int").alias("bathrooms"),
        F.when(n % 9 != 0, n % 6).cast("int").alias("bedrooms"),
        n.cast("int").alias("livingarea"),
        (n % 2 == 0).alias("isfeatured"),
        (n % 3 == 0).alias("isshowcaselisting"),
        F.when(n % 4 == 0, "BUILDER_SPEC").alias("newconstructiontype"),
        F.when(n % 6 != 0, n % 5 == 0).alias("listingsubtype_is_newhome"),
    )


def test_unseen_category_gets_its_own_index(spark):
    seen = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("c", 1)], "c string, n int")
    other = spark.createDataFrame([("b", 1), ("zzz", 2), (None, 3)], "c string, n int")
    out = Pipeline(stages=feature_stages(["c"], ["n"])).fit(seen).transform(other)
    got = [(r.c_index, r.v) for r in out.select("c_index", vector_to_array("features").alias("v")).collect()]
    assert got == [(0.0, [1, 0, 0, 0, 1]), (3.0, [0, 0, 0, 1, 2]), (3.0, [0, 0, 0, 1, 3])]


def test_flags_become_numbers(spark):
    df = spark.createDataFrame([("a", True), ("a", False)], "c string, f boolean")
    out = Pipeline(stages=feature_stages(["c"], ["f"])).fit(df).transform(df)
    assert [r.v[-1] for r in out.select(vector_to_array("features").alias("v")).collect()] == [1, 0]


def test_wide_categories_are_refused_on_request_only(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("c"))
    require_bounded_categories(df, ["c"], 2000)
    with pytest.raises(ValueError, match="too many"):
        require_bounded_categories(df, ["c"], 100)
    wide = spark.range(20_000).select(F.col("id").cast("string").alias("c"), "id", F.col("id").alias("price"))
    with pytest.raises(ValueError, match="too many"):
        fit_model(wide, ["c"], ["id"], max_categories=10_000)
    model = fit_model(wide, ["c"], ["id"], trees=1, depth=2)
    assert predict(model, wide.limit(5)).count() == 5


def test_nothing_to_train_on(spark, listings):
    for rows in (listings.limit(0), listings.withColumn("price", F.lit(None).cast("long"))):
        with pytest.raises(NoListingsError):
            predict_prices(rows)


def test_metrics_of_equal_prices_have_no_r2(spark):
    for rows in (spark.range(3), spark.range(1)):
        got = regression_metrics(rows.select(F.lit(5.0).alias("price"), F.lit(4.0).alias("prediction"))).first()
        assert got["r2"] is None and got["rmse"] == 1
    assert regression_metrics(spark.range(0).selectExpr("1D AS price", "1D AS prediction")).first()["rows"] == 0


def test_trees_that_see_the_same_data_give_the_means(listings):
    clean = listings.fillna("none").fillna(0)
    model = fit_model(clean, ["city"], ["bathrooms"], bootstrap=False, feature_subset="all")
    means = clean.groupBy("city", "bathrooms").agg(F.avg("price").alias("mean"))
    for row in predict(model, clean).join(means, ["city", "bathrooms"]).limit(50).collect():
        assert row.prediction == pytest.approx(row.mean)


def test_key_split_ignores_partitioning(listings):
    one, many = (split_by_key(listings.repartition(n), "zpid")[0] for n in (1, 7))
    members = [sorted(r.zpid for r in part.collect()) for part in (one, many)]
    assert members[0] == members[1] and 0.7 < len(members[0]) / 600 < 0.9
    assert listings.filter(hash_bucket(F.col("zpid")) > 9).isEmpty()


def test_splits_lose_nothing(spark, listings):
    with_null = listings.unionByName(spark.createDataFrame([(None,) * 12], curated_schema()))
    assert sum(part.count() for part in split_by_key(with_null, "zpid")) == 601
    left, right = split_at_random(listings)
    assert left.count() + right.count() == 600
    assert left.intersect(right).isEmpty()


def test_metrics_equal_the_evaluator(spark):
    df = spark.range(50).select(
        (F.col("id") * 3.0).alias("price"), (F.col("id") * 2.5 + 7).alias("prediction")
    )
    got = regression_metrics(df).first()
    for name in ("rmse", "mae", "r2"):
        expected = RegressionEvaluator(labelCol="price", metricName=name).evaluate(df)
        assert got[name] == pytest.approx(expected)
    assert got["rows"] == 50


def test_same_input_same_predictions(listings):
    clean = listings.fillna("none").fillna(0).fillna(False).cache()
    runs = [
        sorted(map(tuple, predict(fit_model(clean), clean).select("zpid", "prediction").collect()))
        for _ in range(2)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 600


def test_prediction_is_the_mean_of_the_trees(listings):
    clean = listings.fillna("none").fillna(0).fillna(False)
    model = fit_model(clean)
    assert model.stages[-1].getNumTrees == 20
    for row in model.transform(clean).orderBy("zpid").limit(5).collect():
        votes = [tree.predict(row.features) for tree in model.stages[-1].trees]
        assert row.prediction == pytest.approx(sum(votes) / len(votes))


@pytest.mark.parametrize("split", ["key", "random"])
def test_reports_cover_every_priced_row(spark, listings, tmp_path, split):
    reports = predict_prices(listings, str(tmp_path / "predictions"), split)
    overall = reports.overall.first()
    assert overall["total"] == reports.predictions.count() == 594
    assert overall["min_predicted"] <= overall["avg_predicted"] <= overall["max_predicted"]
    assert [r.zpid for r in reports.sample.limit(2).collect()] == ["1", "10"]
    assert reports.sample.columns[-2:] == ["actual_price", "predicted_price"]
    cities = reports.by_city.collect()
    assert sum(r["count"] for r in cities) == 594
    averages = [r.avg_predicted for r in cities]
    assert averages == sorted(averages, reverse=True)
    assert {r.hometype for r in reports.by_home_type.collect()} == {"UNKNOWN", "type 0", "type 1", "type 2"}
    assert reports.holdout.first()["r2"] > 0.5
