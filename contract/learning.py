"""Feature and model queries."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from contract import standins as s
from contract.registry import query
from contract.standins import rounded, with_standins
from strata.functions.numeric import stable_round
from strata.plans import training


@query("time_features", with_standins(f"""
SELECT pickup_datetime, CAST(dayofweek(pickup_datetime) + 1 AS DOUBLE) AS day_of_week, CAST(month(pickup_datetime) AS DOUBLE) AS month,
       CAST(hour(pickup_datetime) AS DOUBLE) AS hour_of_day,
       CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN CAST(1 AS DOUBLE) ELSE 0 END AS is_weekend,
       {rounded('sin(2 * pi() * hour(pickup_datetime) / 24)', 6)} AS sin_hour,
       {rounded('cos(2 * pi() * hour(pickup_datetime) / 24)', 6)} AS cos_hour, fare_amount AS label
FROM trips"""))
def time_features(spark, sf):
    out = training.time_features(s.silver_trips(spark, sf).select("pickup_datetime", "fare_amount"))
    out = out.withColumns({c: stable_round(c, 6) for c in ("sin_hour", "cos_hour")})
    return s.wall_clock(out.drop("fare_amount"))


@query("median_imputation")
def median_imputation(spark, sf):
    df = s.integrated(spark, sf, evolved=False)
    return s.wall_clock(training.median_imputer().fit(df).transform(df).select(
        "pickup_datetime", *training.NUMERIC_FEATURES, *[f"{c}_imputed" for c in training.NUMERIC_FEATURES]
    ))


@query("median_imputation_fills", with_standins("""
SELECT COUNT(*) AS row_count, CAST(0 AS BIGINT) AS nulls_left, TRUE AS known_kept, TRUE AS middle_value FROM integrated"""))
def median_imputation_fills(spark, sf):
    """No nulls are left, known values stay, and the filled one lies between the quartiles of its column."""
    df = s.integrated(spark, sf, evolved=False)
    filled = training.median_imputer().fit(df).transform(df)
    names = training.NUMERIC_FEATURES
    nulls = sum((F.count_if(F.col(f"{c}_imputed").isNull()) for c in names), F.lit(0))
    kept = [F.bool_and(F.coalesce(F.col(c) == F.col(f"{c}_imputed"), F.lit(True))) for c in names]
    middle = [
        F.coalesce(
            F.max(F.when(F.col(c).isNull(), F.col(f"{c}_imputed"))).between(F.percentile(c, 0.25), F.percentile(c, 0.75)), F.lit(True)
        ) for c in names
    ]
    return filled.agg(
        F.count("*").alias("row_count"), nulls.alias("nulls_left"), reduce(Column.__and__, kept).alias("known_kept"),
        reduce(Column.__and__, middle).alias("middle_value"),
    )


@query("category_index", with_standins("""
SELECT t.pickup_borough, t.pickup_location_id, CAST(i.rank - 1 AS DOUBLE) AS pickup_borough_indexed
FROM integrated t JOIN (SELECT pickup_borough, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, pickup_borough) AS rank
                        FROM integrated GROUP BY 1) i ON t.pickup_borough = i.pickup_borough"""))
def category_index(spark, sf):
    df = s.add_zone(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup")
    indexed = training.category_index(["pickup_borough"]).fit(df).transform(df)
    return indexed.select("pickup_borough", "pickup_location_id", "pickup_borough_indexed")


@query("category_vectors", with_standins("""
SELECT t.pickup_borough, t.pickup_location_id, CAST(i.rank - 1 AS BIGINT) AS hot_position, CAST(n.categories AS BIGINT) AS width
FROM integrated t JOIN (SELECT pickup_borough, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, pickup_borough) AS rank
                        FROM integrated GROUP BY 1) i ON t.pickup_borough = i.pickup_borough,
     (SELECT COUNT(DISTINCT pickup_borough) AS categories FROM integrated) n"""))
def category_vectors(spark, sf):
    """One slot per known category: the slot of unseen values is the dropped last one."""
    df = s.add_zone(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup")
    indexed = training.category_index(["pickup_borough"]).fit(df).transform(df)
    encoded = training.category_vectors(["pickup_borough"]).fit(indexed).transform(indexed)
    slots = vector_to_array("pickup_borough_vec")
    return encoded.select(
        "pickup_borough", "pickup_location_id",
        (F.array_position(slots, 1.0) - 1).cast("bigint").alias("hot_position"),
        F.size(slots).cast("bigint").alias("width"),
    )


@query("standardised_features", with_standins(f"""
SELECT pickup_datetime, {rounded('(trip_distance - m.dm) / m.ds', 5)} AS distance_z, {rounded('(total_amount - m.tm) / m.ts', 5)} AS total_z
FROM trips, (SELECT AVG(trip_distance) AS dm, STDDEV_SAMP(trip_distance) AS ds, AVG(total_amount) AS tm,
             STDDEV_SAMP(total_amount) AS ts FROM trips) m"""))
def standardised_features(spark, sf):
    from pyspark.ml.feature import VectorAssembler

    df = s.silver_trips(spark, sf).select("pickup_datetime", "trip_distance", "total_amount")
    assembled = VectorAssembler(
        inputCols=["trip_distance", "total_amount"], outputCol="unscaled_features", handleInvalid="skip"
    ).transform(df)
    scaled = training.standardise().fit(assembled).transform(assembled)
    values = vector_to_array("features")
    return s.wall_clock(scaled.select(
        "pickup_datetime", stable_round(values[0], 5).alias("distance_z"), stable_round(values[1], 5).alias("total_z")
    ))


@query("feature_vectors")
def feature_vectors(spark, sf):
    df = training.time_features(training.training_filter(s.integrated(spark, sf, evolved=False)))
    out = training.feature_pipeline().fit(df).transform(df)
    return s.wall_clock(out.select("pickup_datetime", "label", vector_to_array("features").alias("features")))


@query("fare_predictions")
def fare_predictions(spark, sf):
    """The model with its full parameters, fitted on a tenth of the trips and applied to all of them."""
    df = training.training_filter(s.integrated(spark, sf, evolved=False))
    model = training.train(df)
    return s.wall_clock(training.predict(model, df).select("pickup_datetime", "pickup_borough", "label", "prediction"))


TRAINING_ROWS = """
FROM integrated WHERE fare_amount > 0 AND trip_distance > 0.05 AND pickup_borough NOT IN ('Unknown', 'EWR')"""


@query("feature_vectors_are_standardised", with_standins(f"""
SELECT COUNT(*) AS row_count, TRUE AS one_length, TRUE AS centred, TRUE AS scaled {TRAINING_ROWS}"""))
def feature_vectors_are_standardised(spark, sf):
    """Every slot has mean 0 and deviation 1, or 0 where the feature is constant."""
    slots = feature_vectors(spark, sf).select(F.monotonically_increasing_id().alias("row"), F.posexplode("features").alias("slot", "value"))
    by_slot = slots.groupBy("slot").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    near = lambda value, to: F.abs(value - to) < 1e-6
    return by_slot.agg(
        F.max("n").alias("row_count"), (F.max("n") == F.min("n")).alias("one_length"), F.bool_and(near(F.col("mean"), 0)).alias("centred"),
        F.bool_and(near(F.col("sd"), 1) | near(F.col("sd"), 0)).alias("scaled"),
    )


@query("fare_predictions_beat_the_mean", with_standins(f"""
SELECT COUNT(*) AS row_count, TRUE AS better_than_mean, TRUE AS all_predicted {TRAINING_ROWS}"""))
def fare_predictions_beat_the_mean(spark, sf):
    """One prediction per row, with a smaller squared error than the constant model's."""
    out = fare_predictions(spark, sf)
    error = F.avg((F.col("label") - F.col("prediction")) ** 2)
    return out.agg(
        F.count("*").alias("row_count"), (error < F.var_pop("label")).alias("better_than_mean"),
        F.bool_and(F.col("prediction").isNotNull()).alias("all_predicted"),
    )


PREDICTION_CTE = """predictions AS (
  SELECT pickup_borough, fare_amount AS label, tip_amount * 10 + 3 AS prediction FROM integrated)"""


def _predictions(spark, sf):
    """A prediction that is known in both engines: the fare rebuilt from the tip."""
    trips = s.add_zone(s.silver_trips(spark, sf), s.silver_zones(spark, sf), "pickup")
    return trips.select("pickup_borough", F.col("fare_amount").alias("label"), (F.col("tip_amount") * 10 + 3).alias("prediction"))


@query("regression_metrics", with_standins(f"""
SELECT {rounded('sqrt(AVG((label - prediction) * (label - prediction)))', 4)} AS rmse, {rounded('AVG(abs(label - prediction))', 4)} AS mae,
       {rounded('1 - AVG((label - prediction) * (label - prediction)) / VAR_POP(label)', 4)} AS r2 FROM predictions""", PREDICTION_CTE))
def regression_metrics(spark, sf):
    return training.regression_metrics(_predictions(spark, sf))


@query("error_by_borough", with_standins(f"""
SELECT pickup_borough, COUNT(*) AS trip_count, {rounded('AVG(abs(label - prediction))')} AS mae,
       {rounded('sqrt(AVG((label - prediction) * (label - prediction)))')} AS rmse FROM predictions GROUP BY 1""", PREDICTION_CTE))
def error_by_borough(spark, sf):
    return training.error_by_group(_predictions(spark, sf))
