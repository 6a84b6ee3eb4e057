"""Model runs with rows that SQL can tell: exact preparation, sizes and metrics, and floors on a
target made by a rule, which every model has to learn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.metrics import PER_CLASS, PREDICTED, predictions
from bindings.models import DIMENSIONS, WEAK_CORES, vectors
from bindings.registry import fraction_sql, near, near_all, near_sql, query, table
from windrow.ml import importance, scaling, training
from windrow.operators import splits

USED = 16               # coordinates that the models see
FLOOR = 0.85            # accuracy that every tuned model has to reach on the target
FRACTIONS = (0.25, 0.5, 0.75, 1.0)
SIDE_SQL = "CASE WHEN embedding[1] > 0 THEN 'high' ELSE 'low' END"


def sides(spark, folder):
    """Coordinates, and as target whether the first one is positive."""
    e = table(spark, folder, "embeddings")
    columns = [f"x{i:02d}" for i in range(USED)]
    return e.select("vec_id", F.when(F.col("embedding")[0] > 0, "high").otherwise("low").alias("side"), *[
        F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(columns)]), columns


def _index_sql(source: str, label: str) -> str:
    """Labels numbered from the most frequent on, equally frequent ones by their text."""
    return (f"SELECT s, row_number() OVER (ORDER BY count(*) DESC, s) - 1 AS i FROM (SELECT "
            f"CAST({label} AS VARCHAR) AS s FROM {source}) WHERE s IS NOT NULL GROUP BY s")


@query(f"""WITH l AS ({_index_sql('embeddings', 'label')}),
x AS (SELECT vec_id, label, unnest(range(1, {DIMENSIONS + 1})) AS d, unnest(embedding)::DOUBLE AS v
      FROM embeddings)
SELECT vec_id, CAST(coalesce(i, (SELECT count(*) FROM l)) AS INTEGER) AS label_index,
       CAST(d AS INTEGER) AS dimension,
       {near_sql('(v - avg(v) OVER (PARTITION BY d)) / stddev_samp(v) OVER (PARTITION BY d)')} AS z
FROM x LEFT JOIN l ON s = CAST(label AS VARCHAR)""")
def prepared_vectors(spark, folder):
    """Label index and standardised vectors as the models get them."""
    df, columns = vectors(spark, folder)
    made = Pipeline(stages=training.preparation(columns, "label")).fit(df).transform(df)
    long = made.select("vec_id", F.col(training.LABEL).cast("int").alias("label_index"),
                       F.posexplode(vector_to_array(training.FEATURES)).alias("at", "z"))
    return long.select("vec_id", "label_index", (F.col("at") + 1).alias("dimension"),
                       near("z").alias("z"))


@query(f"""WITH {PREDICTED}, {PER_CLASS}, t AS (SELECT sum(support)::DOUBLE AS n FROM r)
SELECT {near_sql('sum(hits) / max(n)')} AS accuracy, {near_sql('sum(f1_score * support / n)')} AS f1,
       {near_sql('sum(precision * support / n)')} AS "weightedPrecision",
       {near_sql('sum(recall * support / n)')} AS "weightedRecall" FROM r, t""")
def evaluator_values(spark, folder):
    """The evaluators' four metrics of a prediction table."""
    values = training.evaluator_metrics(predictions(spark, folder).select(
        F.col("label").cast("double").alias(training.LABEL), F.col("prediction").cast("double")))
    names = list(values)
    made = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} double" for n in names))
    return near_all(made, names)


@query(f"""WITH e AS (SELECT vec_id, {SIDE_SQL} AS side, {fraction_sql('vec_id')} AS h FROM embeddings),
l AS ({_index_sql('e WHERE h < 0.8', 'side')})
SELECT vec_id, CAST(coalesce(i, (SELECT count(*) FROM l)) AS INTEGER) AS label, 2 AS n_scores,
       true AS is_largest, true AS sums_to_one FROM e LEFT JOIN l ON s = side WHERE h >= 0.8""")
def predict_lr_scores(spark, folder):
    """Of every scored row: its label index, and whether the prediction is the largest score."""
    df, columns = sides(spark, folder)
    train, test = splits.split(df, ["vec_id"])
    train = training.with_folds(train, ["vec_id"])
    model = training.cross_validator(training.logistic_regression(), columns, "side", 2,
                                     parallelism=4).fit(train)
    made = training.trim_scores(training.prediction_table(model.transform(test), ["vec_id"]), 2)
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    return made.select(
        "vec_id", "label", F.size("scores").alias("n_scores"),
        (F.element_at("scores", F.col("prediction") + 1) == F.array_max("scores")).alias("is_largest"),
        (F.abs(total - 1) < 1e-3).alias("sums_to_one"))


@query("SELECT * FROM (VALUES " + ", ".join(
    f"('{m.name}', true, true)" for m in training.standard_models())
    + ") AS t(model, accuracy_reached, f1_reached)")
def suite_floor(spark, folder):
    """All standard models, tuned on three folds: each reaches the floor on rows not trained on."""
    df, columns = sides(spark, folder)
    train, test = splits.split(df, ["vec_id"])
    board = training.run_suite(training.standard_models(), train, test, columns, "side", ["vec_id"],
                               parallelism=4).leaderboard
    return board.select("model", (F.col("accuracy") >= FLOOR).alias("accuracy_reached"),
                        (F.col("f1_weighted") >= FLOOR).alias("f1_reached"))


@query(f"SELECT 'x00' AS first_feature, {USED}::BIGINT AS n_features, true AS sums_to_one")
def importance_of_rule(spark, folder):
    """The coordinate that the rule reads has the largest importance."""
    df, columns = sides(spark, folder)
    made = importance.forest_importances(df, columns, "side")
    return importance.top_features(made, USED).agg(
        F.max_by("feature", "importance").alias("first_feature"),
        F.count(F.lit(1)).alias("n_features"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))


def _sizes_sql(fraction: float) -> str:
    return (f"SELECT {fraction}::DOUBLE AS fraction, count(*) FILTER (h < {fraction}) AS rows, "
            f"count(*) FILTER (h < {fraction} AND g < 0.8) AS train_rows, true AS above_half FROM "
            f"(SELECT {fraction_sql('vec_id')} AS h, {fraction_sql('vec_id', seed=43)} AS g "
            "FROM embeddings)")


def _sizes(runs: DataFrame) -> DataFrame:
    return runs.select("fraction", "rows", "train_rows", (F.col("accuracy") > 0.5).alias("above_half"))


@query(" UNION ALL ".join(_sizes_sql(f) for f in FRACTIONS))
def scaling_run_sizes(spark, folder):
    """Rows and training rows of each run on a growing share of the data."""
    df, columns = sides(spark, folder)
    return _sizes(scaling.time_fractions(df, columns, "side", ["vec_id"], FRACTIONS))


@query(" UNION ALL ".join(_sizes_sql(0.25 * c) for c in WEAK_CORES))
def weak_scaling_sizes(spark, folder):
    """The same for runs with a quarter of the rows per core."""
    df, columns = sides(spark, folder)
    return _sizes(reduce(DataFrame.unionByName, [
        scaling.time_weak(df, columns, "side", ["vec_id"], cores=c) for c in WEAK_CORES]))


@query(" UNION ALL ".join(
    f"SELECT {run} AS run, {s} AS seed, count(*) FILTER (h < 0.8) AS train_rows, count(*) FILTER "
    f"(h >= 0.8) AS test_rows, true AS recall_is_accuracy, true AS above_half FROM "
    f"(SELECT {fraction_sql('vec_id', seed=s)} AS h FROM embeddings)"
    for run, s in enumerate(scaling.SEEDS, start=1)))
def seed_stability_sizes(spark, folder):
    """Side sizes per seed; the recall weighted by class is the accuracy."""
    df, columns = sides(spark, folder)
    made = scaling.seed_stability(df, columns, "side", ["vec_id"],
                                  training.perceptron(iterations=(100,)))
    return made.select(
        "run", "seed", "train_rows", "test_rows",
        (F.abs(F.col("recall_weighted") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"),
        (F.col("accuracy") > 0.5).alias("above_half"))
