from __future__ import annotations

from pyspark.sql import functions as F

from bindings.metrics import PER_CLASS, argmax_sql, predictions
from bindings.registry import fraction_sql, near, near_all, near_sql, query, table
from windrow.operators import cleaning, evaluation, reports, splits

SEEDS = (42, 123, 256, 789, 1024)


def run_results(spark, folder):
    """Accuracy of the arg-max rule on the test side of several splits: one row per seed."""
    p = predictions(spark, folder)
    whole = None
    for run, seed in enumerate(SEEDS, start=1):
        _, test = splits.split(p, ["vec_id"], seed=seed)
        one = test.agg(
            F.lit(run).alias("run"), F.lit(seed).alias("seed"),
            F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
            F.count(F.lit(1)).cast("double").alias("test_rows"))
        whole = one if whole is None else whole.unionByName(one)
    return whole


_RUNS = " UNION ALL ".join(
    f"SELECT avg(CASE WHEN label = {argmax_sql(1)} THEN 1.0 ELSE 0.0 END) AS accuracy, "
    f"count(*)::DOUBLE AS test_rows FROM embeddings WHERE {fraction_sql('vec_id', seed=s)} >= 0.8"
    for s in SEEDS)


@query(f"WITH r AS ({_RUNS}) " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, count({m}) AS n_runs, {near_sql(f'avg({m})')} AS mean, "
    f"{near_sql(f'stddev_samp({m})')} AS std, {near_sql(f'min({m})')} AS min, "
    f"{near_sql(f'max({m})')} AS max, {near_sql(f'max({m}) - min({m})')} AS range FROM r"
    for m in ("accuracy", "test_rows")))
def seed_stability_summary(spark, folder):
    made = reports.run_statistics(run_results(spark, folder), ["accuracy", "test_rows"])
    return near_all(made, ["mean", "std", "min", "max", "range"])


def priority_runs(spark, folder):
    """Orders by priority and status as runs by core count and share of the data.

    The priority's first digit stands for the cores, the status for the fraction, and the mean
    price for the seconds. One time is zero, and one share has no run on one core.
    """
    o = table(spark, folder, "orders")
    cores = F.substring("o_orderpriority", 1, 1)
    grouped = o.groupBy(cores.alias("c"), F.col("o_orderstatus").alias("s")).agg(
        F.avg("o_totalprice").alias("train_sec"), F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("o_custkey") % 5 != 0, 1)).alias("train_rows"),
        F.avg((F.col("o_custkey") % 2).cast("double")).alias("accuracy"),
        F.avg((F.col("o_custkey") % 3 == 0).cast("double")).alias("f1_weighted"))
    return grouped.filter(~((F.col("c") == "1") & (F.col("s") == "P"))).select(
        F.concat(F.lit("local["), "c", F.lit("]")).alias("cores"),
        F.when(F.col("s") == "F", 0.25).when(F.col("s") == "O", 0.5).otherwise(1.0).alias("fraction"),
        "rows", "train_rows",
        F.when((F.col("c") == "3") & (F.col("s") == "F"), 0.0).otherwise(F.col("train_sec"))
        .alias("train_sec"), "accuracy", "f1_weighted")


RUNS = """
g AS (SELECT substr(o_orderpriority, 1, 1) AS c, o_orderstatus AS s, avg(o_totalprice) AS t,
             count(*) AS rows, count(*) FILTER (o_custkey % 5 <> 0) AS train_rows,
             avg((o_custkey % 2)::DOUBLE) AS accuracy,
             avg(CASE WHEN o_custkey % 3 = 0 THEN 1.0 ELSE 0.0 END) AS f1_weighted
      FROM orders GROUP BY 1, 2),
runs AS (SELECT 'local[' || c || ']' AS cores, CAST(c AS INTEGER) AS n_cores,
                CASE s WHEN 'F' THEN 0.25::DOUBLE WHEN 'O' THEN 0.5 ELSE 1.0 END AS fraction,
                rows, train_rows, CASE WHEN c = '3' AND s = 'F' THEN 0.0 ELSE t END AS train_sec,
                accuracy, f1_weighted
         FROM g WHERE NOT (c = '1' AND s = 'P')),
strong AS (SELECT *, CASE WHEN train_sec > 0 THEN round(coalesce(max(train_sec) FILTER (n_cores = 1)
                    OVER (PARTITION BY fraction), train_sec) / train_sec, 2) ELSE 0.0 END AS speedup
           FROM runs),
weak AS (SELECT *, CASE WHEN train_sec > 0 THEN round((SELECT min(train_sec) FROM runs WHERE n_cores =
                    (SELECT min(n_cores) FROM runs)) / train_sec, 2) ELSE 0.0 END AS efficiency
         FROM runs)"""


@query(f"WITH {RUNS} SELECT cores, n_cores, fraction, speedup FROM strong")
def scaling_speedup(spark, folder):
    return reports.strong_speedup(priority_runs(spark, folder)).select(
        "cores", "n_cores", "fraction", "speedup")


@query(f"WITH {RUNS} SELECT cores, n_cores, fraction, efficiency FROM weak")
def weak_efficiency(spark, folder):
    return reports.weak_efficiency(priority_runs(spark, folder)).select(
        "cores", "n_cores", "fraction", "efficiency")


@query(f"""WITH {RUNS}
SELECT 'strong' AS scaling_type, cores, n_cores, fraction, rows, train_rows,
       {near_sql('train_sec', 4)} AS train_sec, {near_sql('accuracy', 4)} AS accuracy,
       {near_sql('f1_weighted', 4)} AS f1_weighted, speedup FROM strong
UNION ALL
SELECT 'weak', cores, n_cores, fraction, rows, train_rows, {near_sql('train_sec', 4)},
       {near_sql('accuracy', 4)}, {near_sql('f1_weighted', 4)}, efficiency FROM weak""")
def scaling_table(spark, folder):
    runs = priority_runs(spark, folder)
    return near_all(reports.scaling_table(runs, runs), ["train_sec", "accuracy", "f1_weighted"], 4)


def rule_results(spark, folder, first, name, **constants):
    made = evaluation.overall_metrics(
        evaluation.confusion_cells(predictions(spark, folder, first)))
    return cleaning.tag(made.select("accuracy", "f1_weighted", "f1_macro"), model=name, **constants)


def rule_sql(first: int, name: str) -> str:
    predicted = f"p AS (SELECT vec_id, label, {argmax_sql(first)} AS prediction FROM embeddings)"
    return f"""(WITH {predicted}, {PER_CLASS}
SELECT '{name}' AS model, sum(hits) / sum(support)::DOUBLE AS accuracy,
       sum(f1_score * support) / sum(support)::DOUBLE AS f1_weighted, avg(f1_score) AS f1_macro FROM r)"""


MODELS = {"first ten": 1, "second ten": 11, "third ten": 21}
LEADERBOARD_SQL = " UNION ALL ".join(f"SELECT * FROM {rule_sql(f, n)}" for n, f in MODELS.items())


def leaderboard(spark, folder):
    whole = None
    for name, first in MODELS.items():
        one = rule_results(spark, folder, first, name)
        whole = one if whole is None else whole.unionByName(one)
    return whole


@query(f"SELECT model, {near_sql('f1_weighted')} AS f1_weighted FROM ({LEADERBOARD_SQL}) "
       "ORDER BY f1_weighted DESC, model LIMIT 1")
def best_model(spark, folder):
    made = reports.best_row(leaderboard(spark, folder), "f1_weighted", "model")
    return made.select("model", near("f1_weighted").alias("f1_weighted"))


@query("""SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1
          ORDER BY 2 DESC, 1 LIMIT 20""")
def top_rows(spark, folder):
    sums = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"))
    return reports.top_rows(sums, "quantity", "l_partkey", 20)


_COMPARED = ", ".join(f"{near_sql(m, 4)} AS {m}" for m in ("accuracy", "f1_weighted"))


@query(f"""
WITH d AS (SELECT CASE WHEN n_regionkey = 0 THEN 'cuda' ELSE 'cpu' END AS device,
                  max(n_nationkey)::DOUBLE AS gpu_memory_mb FROM nation GROUP BY 1)
SELECT model, 'CPU' AS hardware, {_COMPARED}, NULL::DOUBLE AS f1_macro, NULL::DOUBLE AS gpu_memory_mb,
       'tables' AS source FROM {rule_sql(1, 'first ten')}
UNION ALL
SELECT model, 'CUDA device', {_COMPARED}, {near_sql('f1_macro', 4)}, (SELECT gpu_memory_mb FROM d
       WHERE device = 'cuda'), 'sequences' FROM {rule_sql(11, 'second ten')}
UNION ALL
SELECT model, 'CPU', {_COMPARED}, {near_sql('f1_macro', 4)}, (SELECT gpu_memory_mb FROM d
       WHERE device = 'cpu'), 'sequences' FROM {rule_sql(21, 'third ten')}
""")
def unified_comparison(spark, folder):
    tables = rule_results(spark, folder, 1, "first ten", hardware="CPU").drop("f1_macro")
    sequences = rule_results(spark, folder, 11, "second ten", hardware="CUDA device").unionByName(
        rule_results(spark, folder, 21, "third ten", hardware="CPU"))
    device = F.when(F.col("n_regionkey") == 0, "cuda").otherwise("cpu")
    devices = table(spark, folder, "nation").groupBy(device.alias("device")).agg(
        F.max("n_nationkey").cast("double").alias("gpu_memory_mb"))
    made = reports.unified_comparison({
        "tables": reports.scored(tables),
        "sequences": reports.scored(reports.add_device_memory(sequences, devices),
                                    name_contains="ten")})
    return near_all(made, ["accuracy", "f1_weighted", "f1_macro"], 4)


@query(f"""SELECT 'Spark' AS framework, model AS model_name, {_COMPARED} FROM {rule_sql(1, 'first ten')}
UNION ALL SELECT 'Other', model, {_COMPARED} FROM {rule_sql(11, 'second ten')}""")
def framework_comparison(spark, folder):
    """The same metrics of two sources, each row naming its framework."""
    def of(framework, first, name):
        made = rule_results(spark, folder, first, name, framework=framework)
        return made.withColumnRenamed("model", "model_name").drop("f1_macro")

    made = of("Spark", 1, "first ten").unionByName(of("Other", 11, "second ten"))
    aligned = cleaning.align(made, ["framework", "model_name", "missing", "accuracy", "f1_weighted"])
    return near_all(aligned, ["accuracy", "f1_weighted"], 4)
