from __future__ import annotations

from pyspark.sql import functions as F

from bindings.registry import SLICE_ROWS, near, near_all, near_sql, query, table
from windrow.operators import quantiles, quality
from windrow.operators.quality import Expectation


def gappy_events(spark, folder):
    """Events whose value has NaNs and nulls by rule; the table itself has neither."""
    return table(spark, folder, "events").withColumn(
        "value", F.when(F.col("event_id") % 10 == 3, F.lit(float("nan")))
        .when(F.col("event_id") % 4 == 0, F.col("value")))


GAPPY = ("(SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 10 = 3 THEN "
         "'nan'::DOUBLE WHEN event_id % 4 = 0 THEN value END AS value, props FROM events)")


def _audit_sql() -> str:
    parts = []
    for c in ("event_id", "ts", "user_id", "event_type", "value", "props"):
        nan = "count(*) FILTER (isnan(value))" if c == "value" else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{c}' AS column_name, count(*) AS n_rows, "
                     f"count(*) FILTER ({c} IS NULL) AS n_null, {nan} AS n_nan FROM g")
    return (f"WITH g AS {GAPPY}, a AS ({' UNION ALL '.join(parts)}) SELECT *, "
            f"{near_sql('(n_null + n_nan) / n_rows::DOUBLE')} AS missing_fraction FROM a")


@query(_audit_sql())
def null_audit(spark, folder):
    return near_all(quality.missing_audit(gappy_events(spark, folder)), ["missing_fraction"])


@query("""
SELECT *, observed IS NOT NULL AND (lowest IS NULL OR observed >= lowest)
          AND (highest IS NULL OR observed <= highest) AS passed
FROM (
  SELECT 'row_count' AS check_name, count(*)::DOUBLE AS observed, 100::DOUBLE AS lowest,
         NULL::DOUBLE AS highest FROM events
  UNION ALL SELECT 'column_count', 6::DOUBLE, 6, NULL
  UNION ALL SELECT 'nulls_user_id', count(*) FILTER (user_id IS NULL), 0, 0 FROM events
  UNION ALL SELECT 'null_fraction_value',
         round(avg(CASE WHEN event_id % 4 <> 0 THEN 1.0 ELSE 0.0 END), 6), 0.8, 0.95 FROM events
  UNION ALL SELECT 'distinct_user_id', count(DISTINCT user_id), 9, NULL FROM events)
""")
def expectations(spark, folder):
    df = table(spark, folder, "events").withColumn(
        "value", F.when(F.col("event_id") % 4 == 0, F.col("value")))
    report = quality.expectations(df, [
        Expectation.row_count(100), Expectation.column_count(df, 6),
        Expectation.no_nulls("user_id"), Expectation.null_fraction("value", 0.8, 0.95),
        Expectation.distinct("user_id", 9)])
    return report.withColumn("observed", F.round("observed", 6))


@query("SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, folder):
    return quality.group_counts(table(spark, folder, "lineitem"), [])


@query("SELECT event_type, count(*) AS n_rows FROM events GROUP BY 1")
def class_histogram(spark, folder):
    return quality.group_counts(table(spark, folder, "events"), ["event_type"]).orderBy(
        "event_type")


@query("""SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'protocol' ELSE 'optional' END AS session,
          count(*) AS n_rows FROM events GROUP BY 1, 2""")
def subject_session_counts(spark, folder):
    df = table(spark, folder, "events").withColumn(
        "session", F.when(F.col("user_id") % 2 == 0, "protocol").otherwise("optional"))
    return quality.group_counts(df, ["user_id", "session"]).orderBy("user_id", "session")


@query("SELECT count(*) AS n_distinct FROM (SELECT DISTINCT user_id, event_type FROM events)")
def distinct_keys(spark, folder):
    return quality.distinct_count(table(spark, folder, "events"), ["user_id", "event_type"])


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark, folder):
    return table(spark, folder, "events").select("user_id", "event_type").distinct()


def _percentile_sql() -> str:
    parts = [f"SELECT '{m}' AS measure, {s}::DOUBLE AS share, "
             + near_sql(f"quantile_cont({m}, {s})", 5) + " AS value FROM lineitem"
             for m in ("l_quantity", "l_extendedprice") for s in (0.0, 0.25, 0.5, 0.75, 1.0)]
    return " UNION ALL ".join(parts)


@query(_percentile_sql())
def summary_percentiles(spark, folder):
    made = quality.exact_percentiles(
        table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"],
        [0.0, 0.25, 0.5, 0.75, 1.0], gathered=SLICE_ROWS)
    return near_all(made, ["value"], 5)


@query("""
SELECT 'min' AS summary, min(l_quantity) AS l_quantity, min(l_tax) AS l_tax FROM lineitem
UNION ALL SELECT 'max', max(l_quantity), max(l_tax) FROM lineitem
UNION ALL SELECT 'count', count(l_quantity), count(l_tax) FROM lineitem
""")
def summary_ranges(spark, folder):
    made = quality.summary(table(spark, folder, "lineitem"), ["l_quantity", "l_tax"],
                           ["min", "max", "count"])
    return made.select("summary", *[F.col(c).cast("double").alias(c)
                                    for c in ("l_quantity", "l_tax")])


@query()
def summary_approximate(spark, folder):
    """Spark's approximate percentiles; near, not equal to, the exact ones."""
    return quality.summary(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"])


_SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS measure, {s}::DOUBLE AS share, count({c}) AS n, min({c})::DOUBLE AS least, "
    f"max({c})::DOUBLE AS greatest, true AS near_rank FROM lineitem"
    for c in ("l_quantity", "l_extendedprice") for s in _SHARES))
def summary_sketch(spark, folder):
    """Sketches per month, merged to the whole; each value's true rank is within 2 % of its share."""
    items = table(spark, folder, "lineitem")
    columns = ["l_quantity", "l_extendedprice"]
    monthly = quantiles.sketches(items.withColumn("month", F.date_trunc("month", "l_shipdate")),
                                 columns, ["month"])
    made = quantiles.sketched_percentiles(quantiles.merged(monthly), _SHARES)
    wanted = F.broadcast(made)             # one row per measure and share
    long = items.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in columns])))
    below, upto = F.count(F.when(F.col("v") < F.col("value"), 1)), F.count(
        F.when(F.col("v") <= F.col("value"), 1))
    near_rank = ((below <= (F.col("share") + 0.02) * F.col("n"))
                 & (upto >= (F.col("share") - 0.02) * F.col("n")))
    return long.join(wanted, "measure").groupBy(
        "measure", "share", "n", "least", "greatest").agg(near_rank.alias("near_rank"))


@query("""
SELECT metric, value FROM (
  SELECT count(*)::DOUBLE AS rows, 6::DOUBLE AS columns,
         count(DISTINCT user_id)::DOUBLE AS distinct_user_id,
         count(DISTINCT event_type)::DOUBLE AS distinct_event_type,
         min(value) AS min_value, max(value) AS max_value FROM events)
UNPIVOT (value FOR metric IN (rows, columns, distinct_user_id, distinct_event_type, min_value,
                              max_value))
""")
def dataset_summary(spark, folder):
    return quality.series_summary(table(spark, folder, "events"), ["user_id", "event_type"],
                                  ["value"])


@query(f"SELECT {near_sql('avg(CASE WHEN value IS NULL OR isnan(value) THEN 1.0 ELSE 0.0 END)')} "
       f"AS missing_share FROM {GAPPY}")
def missing_fraction(spark, folder):
    audit = quality.missing_audit(gappy_events(spark, folder), ["value"])
    return audit.select(near("missing_fraction").alias("missing_share"))
