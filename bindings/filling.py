from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import SLICE_ROWS, near, near_all, near_sql, query, table
from windrow.operators import imputation, joins, scaling, splits
from windrow.series import SeriesKey

SERIES = SeriesKey(("user_id", "session"), "ts", "event_id")


def sparse_events(spark, folder):
    """Three of four readings missing; two sessions per user with interleaved clocks."""
    return table(spark, folder, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.floor(F.col("event_id") / 7) % 2 == 0, "protocol").otherwise("optional")
        .alias("session"),
        F.when(F.col("event_id") % 4 == 0, F.col("value")).alias("value"))


SPARSE = ("(SELECT event_id, ts, user_id, event_type, CASE WHEN (event_id // 7) % 2 = 0 THEN "
          "'protocol' ELSE 'optional' END AS session, CASE WHEN event_id % 4 = 0 THEN value END "
          "AS value FROM events)")


def fill_sql(direction: str, keys: str, limit: int) -> str:
    function, frame = {
        "forward": ("last_value", f"{limit} PRECEDING AND CURRENT ROW"),
        "backward": ("first_value", f"CURRENT ROW AND {limit} FOLLOWING")}[direction]
    return (f"coalesce(value, {function}(value IGNORE NULLS) OVER (PARTITION BY {keys} "
            f"ORDER BY ts, event_id ROWS BETWEEN {frame}))")


@query(f"SELECT event_id, {fill_sql('forward', 'user_id, session', 3)} AS value FROM {SPARSE}")
def ffill_bounded(spark, folder):
    return imputation.bounded_fill(sparse_events(spark, folder), SERIES, ["value"], 3, ["forward"],
                                   SLICE_ROWS).select("event_id", "value")


@query(f"SELECT event_id, {fill_sql('backward', 'user_id, session', 3)} AS value FROM {SPARSE}")
def bfill_bounded(spark, folder):
    return imputation.bounded_fill(sparse_events(spark, folder), SERIES, ["value"], 3, ["backward"],
                                   SLICE_ROWS).select("event_id", "value")


@query(f"SELECT event_id, value FROM (SELECT event_id, ts, event_type, "
       f"{fill_sql('forward', 'event_type', 2)} AS value FROM {SPARSE})")
def ffill_long_series(spark, folder):
    """Few, long series: every one of them is cut into pieces and stitched together."""
    series = SeriesKey("event_type", "ts", "event_id")
    return imputation.bounded_fill(sparse_events(spark, folder), series, ["value"], 2, ["forward"],
                                   SLICE_ROWS // 10).select("event_id", "value")


_ITEM = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(f"""
WITH i AS (SELECT {_ITEM}, l_returnflag, date_trunc('year', l_shipdate) AS t,
                  CASE WHEN l_orderkey % 5 = 0 THEN l_quantity END AS q FROM lineitem)
SELECT {_ITEM}, coalesce(
         q, last_value(q IGNORE NULLS) OVER (PARTITION BY l_returnflag ORDER BY t, {_ITEM}
              ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         first_value(q IGNORE NULLS) OVER (PARTITION BY l_returnflag ORDER BY t, {_ITEM}
              ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) AS q FROM i""")
def fill_ties(spark, folder):
    """Few instants with thousands of rows each: series are cut between rows of one instant."""
    item = _ITEM.split(", ")
    items = table(spark, folder, "lineitem").select(
        *item, "l_returnflag", F.date_trunc("year", "l_shipdate").alias("t"),
        F.when(F.col("l_orderkey") % 5 == 0, F.col("l_quantity")).alias("q"),
        F.struct(*item).alias("tie"))
    return imputation.bounded_fill(items, SeriesKey("l_returnflag", "t", "tie"), ["q"], 4,
                                   rows_per_slice=SLICE_ROWS // 4).select(*item, "q")


@query("SELECT event_id, event_type, n_events, last_value FROM (SELECT event_type, count(*) AS n_events, "
       "max_by(value, event_id) AS last_value FROM events GROUP BY 1) JOIN events USING (event_type)")
def spread_statistic_join(spark, folder):
    """A statistic per event type joined by shuffle, each of the few types spread over pieces."""
    events = table(spark, folder, "events")
    facts = events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max_by("value", "event_id").alias("last_value"))
    return joins.spread_join(events.select("event_id", "event_type"), facts, ["event_type"],
                             "inner", ["event_id"], parts=64).select(
        "event_id", "event_type", "n_events", "last_value")


IMPUTED = f"""
f AS (SELECT *, {fill_sql('forward', 'user_id, session', 2)} AS v1 FROM {SPARSE}),
b AS (SELECT * EXCLUDE (value, v1), v1 AS value FROM f),
c AS (SELECT *, {fill_sql('backward', 'user_id, session', 2)} AS v2 FROM b),
m AS (SELECT user_id, avg(v2) AS mu FROM c GROUP BY 1),
imputed AS (SELECT event_id, ts, user_id, event_type, session, coalesce(v2, mu) AS value
            FROM c LEFT JOIN m USING (user_id))"""


def imputed_events(spark, folder):
    return imputation.impute(sparse_events(spark, folder), SERIES, ["value"], 2, ["user_id"],
                             rows_per_slice=SLICE_ROWS)


@query(f"WITH {IMPUTED} SELECT event_id, {near_sql('value')} AS value FROM imputed")
def impute_three_step(spark, folder):
    return imputed_events(spark, folder).select("event_id", near("value").alias("value"))


@query(f"SELECT user_id, {near_sql('avg(value)')} AS value_mean FROM {SPARSE} GROUP BY 1")
def group_mean(spark, folder):
    return near_all(imputation.group_means(sparse_events(spark, folder), ["user_id"], ["value"]),
                    ["value_mean"])


@query(f"SELECT event_id, {near_sql('avg(value) OVER (PARTITION BY user_id)')} AS value_mean "
       f"FROM {SPARSE}")
def group_mean_per_row(spark, folder):
    made = imputation.with_group_means(sparse_events(spark, folder), ["user_id"], ["value"],
                                       spread=["event_id"])
    return made.select("event_id", near("value_mean").alias("value_mean"))


MEASURES = ("l_discount", "l_extendedprice", "l_quantity", "l_tax")


def scaled_items(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", *MEASURES, F.lit(7.0).alias("flat"),
        F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("holed"))


ITEMS = ("(SELECT l_orderkey, l_linenumber, l_discount, l_extendedprice, l_quantity, l_tax, "
         "7.0::DOUBLE AS flat, CASE WHEN l_linenumber <> 2 THEN l_quantity END AS holed FROM lineitem)")
SCALED = [*MEASURES, "flat", "holed"]


def _minmax_sql(fit_filter: str = "") -> str:
    stats = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in SCALED)
    out = ", ".join(
        f"CASE WHEN lo_{c} IS NULL OR lo_{c} = hi_{c} THEN {near_sql('0.0')} ELSE "
        f"{near_sql(f'({c} - lo_{c}) / (hi_{c} - lo_{c})')} END AS {c}" for c in SCALED)
    return (f"WITH i AS {ITEMS}, s AS (SELECT {stats} FROM i {fit_filter}) "
            f"SELECT l_orderkey, l_linenumber, {out} FROM i, s")


@query(_minmax_sql())
def minmax_scale(spark, folder):
    return near_all(scaling.minmax(scaled_items(spark, folder), SCALED), SCALED)


def _train_filter() -> str:
    from bindings.registry import fraction_sql
    return f"WHERE {fraction_sql('l_orderkey')} < 0.8"


@query(_minmax_sql(_train_filter()))
def minmax_fit_on_train(spark, folder):
    """Fitted on the training orders, applied to all."""
    items = scaled_items(spark, folder)
    train, _ = splits.split(items, ["l_orderkey"])
    return near_all(scaling.apply_minmax(items, scaling.fit_minmax(train, SCALED), SCALED), SCALED)


def _zscore_sql() -> str:
    columns = [*MEASURES, "flat"]
    stats = ", ".join(f"avg({c}) AS mu_{c}, CASE WHEN stddev_pop({c}) < 1e-8 THEN 1.0 ELSE "
                      f"stddev_pop({c}) END AS sd_{c}" for c in columns)
    out = ", ".join(near_sql(f"({c} - mu_{c}) / sd_{c}") + f" AS {c}" for c in columns)
    return (f"WITH i AS {ITEMS}, s AS (SELECT {stats} FROM i) "
            f"SELECT l_orderkey, l_linenumber, {out} FROM i, s")


@query(_zscore_sql())
def zscore_scale(spark, folder):
    columns = [*MEASURES, "flat"]
    return near_all(scaling.zscore(scaled_items(spark, folder).drop("holed"), columns), columns)


@query("SELECT min(l_quantity) AS l_quantity_lo, max(l_quantity) AS l_quantity_hi, "
       "min(l_tax) AS l_tax_lo, max(l_tax) AS l_tax_hi FROM lineitem")
def minmax_statistics(spark, folder):
    made = scaling.fit_minmax(table(spark, folder, "lineitem"), ["l_quantity", "l_tax"])
    return made.select("l_quantity_lo", "l_quantity_hi", "l_tax_lo", "l_tax_hi")
