from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import fraction_sql, query, table
from windrow.ml.scaling import SEEDS
from windrow.ml.training import with_folds
from windrow.operators import splits


def events(spark, folder):
    return table(spark, folder, "events").select("event_id", "user_id", "event_type")


@query(f"SELECT event_id, event_type FROM events WHERE {fraction_sql('event_id')} < 0.25")
def stable_sample(spark, folder):
    return splits.stable_sample(events(spark, folder), ["event_id"], 0.25).select(
        "event_id", "event_type")


@query(f"SELECT event_id, {fraction_sql('event_id')} < 0.8 AS in_train FROM events")
def stable_split(spark, folder):
    return splits.mark_split(events(spark, folder), ["event_id"]).select("event_id", "in_train")


@query(f"SELECT event_id, user_id, {fraction_sql('user_id')} < 0.8 AS in_train FROM events")
def group_split(spark, folder):
    """All events of a user on the same side."""
    return splits.mark_split(events(spark, folder), ["user_id"]).select(
        "event_id", "user_id", "in_train")


@query(f"""
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY h, event_id)
       <= round(count(*) OVER (PARTITION BY event_type) * 0.8) AS in_train
FROM (SELECT event_id, event_type, {fraction_sql('event_id')} AS h FROM events)""")
def stratified_split(spark, folder):
    return splits.mark_stratified(events(spark, folder), "event_type", "event_id").select(
        "event_id", "event_type", "in_train")


@query(" UNION ALL ".join(
    f"SELECT {s} AS seed, count(*) FILTER (h < 0.8) AS train_rows, count(*) FILTER (h >= 0.8) AS "
    f"test_rows FROM (SELECT {fraction_sql('event_id', seed=s)} AS h FROM events)" for s in SEEDS))
def repeated_splits(spark, folder):
    """Side sizes for several seeds."""
    df = events(spark, folder)
    whole = None
    for seed in SEEDS:
        one = splits.mark_split(df, ["event_id"], seed=seed).agg(
            F.lit(seed).alias("seed"), F.count(F.when(F.col("in_train"), 1)).alias("train_rows"),
            F.count(F.when(~F.col("in_train"), 1)).alias("test_rows"))
        whole = one if whole is None else whole.unionByName(one)
    return whole


@query(f"""SELECT event_id, CAST(least(floor({fraction_sql('event_id', "'fold'")} * 3), 2) AS INTEGER)
           AS fold FROM events""")
def stable_folds(spark, folder):
    return with_folds(events(spark, folder), ["event_id"]).select("event_id", "fold")
