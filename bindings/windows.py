from __future__ import annotations

from pyspark.sql import functions as F

from bindings.filling import IMPUTED, imputed_events
from bindings.registry import near_all, near_sql, query, table
from windrow.ml.stage import WindowFeatures
from windrow.operators import scaling, sequences, windows
from windrow.operators.windows import WindowSpec
from windrow.session import durable

DAY = 86_400
EVENTS = WindowSpec(("user_id", "event_type"), "ts", 5 * DAY, spread=("event_id",))
ITEMS = WindowSpec(("l_suppkey", "l_returnflag"), "l_shipdate", 90 * DAY)

EVENT_WINDOWS = """
w AS (SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id, event_type))
             // 432000000000 AS window_id FROM events)"""
ITEM_WINDOWS = """
w AS (SELECT *, (epoch_us(l_shipdate) - min(epoch_us(l_shipdate)) OVER (
             PARTITION BY l_suppkey, l_returnflag)) // 7776000000000 AS window_id FROM lineitem)"""


def events(spark, folder):
    return table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")


def items(spark, folder):
    return table(spark, folder, "lineitem")


def statistics_sql(*columns: str, digits: int = 6) -> str:
    return ", ".join(
        f"{near_sql(f'avg({c})', digits)} AS {c}_mean, "
        f"{near_sql(f'stddev_samp({c})', digits)} AS {c}_std, "
        f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in columns)


def rounded_features(df, digits: int = 6):
    return near_all(df, [c for c in df.columns if c.endswith(("_mean", "_std", "_sma"))], digits)


@query("SELECT user_id, event_type, min(epoch_us(ts)) AS origin_us FROM events GROUP BY 1, 2")
def segment_origin(spark, folder):
    return windows.segment_origin(events(spark, folder), EVENTS)


@query(f"WITH {EVENT_WINDOWS} SELECT event_id, window_id FROM w")
def window_assign(spark, folder):
    return windows.assign_windows(events(spark, folder), EVENTS).select("event_id", "window_id")


@query(f"""WITH {EVENT_WINDOWS} SELECT user_id, event_type, window_id, count(*) AS sample_count,
           {statistics_sql('value')} FROM w GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def window_features(spark, folder):
    made = windows.window_features(events(spark, folder), EVENTS, ["value"], least=2,
                                   keep_helpers=True)
    return rounded_features(made)


@query(f"""WITH {EVENT_WINDOWS.replace('PARTITION BY user_id, event_type',
                                       'PARTITION BY user_id, event_type, event_id % 2')}
           SELECT user_id, event_type, event_id % 2 AS session, window_id,
                  count(*) AS sample_count, {statistics_sql('value')} FROM w GROUP BY 1, 2, 3, 4""")
def window_features_by_session(spark, folder):
    """Sessions as part of the segment: their clocks no longer share windows."""
    spec = WindowSpec(("user_id", "event_type", "session"), "ts", 5 * DAY)
    df = events(spark, folder).withColumn("session", F.col("event_id") % 2)
    return rounded_features(windows.window_features(df, spec, ["value"], keep_helpers=True))


ITEM_MEASURES = ("l_discount", "l_extendedprice", "l_quantity", "l_tax")


@query(f"""WITH {ITEM_WINDOWS} SELECT l_suppkey, l_returnflag, window_id, count(*) AS sample_count,
           {statistics_sql(*ITEM_MEASURES)},
           {near_sql('avg(abs(l_quantity) + abs(l_discount) + abs(l_tax))')} AS item_sma
           FROM w GROUP BY 1, 2, 3 HAVING count(*) >= 3""")
def window_features_multi(spark, folder):
    made = windows.window_features(
        items(spark, folder), ITEMS, ITEM_MEASURES,
        {"item": ("l_quantity", "l_discount", "l_tax")}, least=3, keep_helpers=True)
    return rounded_features(made)


WIDE = {f"m{i:02d}": (ITEM_MEASURES[i % 4], 1 + i // 4) for i in range(40)}
AXES = {f"g{i:02d}": (f"m{3 * i:02d}", f"m{3 * i + 1:02d}", f"m{3 * i + 2:02d}") for i in range(12)}


def _wide_sql() -> str:
    measures = ", ".join(f"{c} * {f} AS {m}" for m, (c, f) in WIDE.items())
    areas = ", ".join(f"{near_sql(' + '.join(f'abs({a})' for a in axes).join(('avg(', ')')), 3)} AS {g}_sma"
                      for g, axes in AXES.items())
    return (f"WITH {ITEM_WINDOWS}, x AS (SELECT l_suppkey, l_returnflag, window_id, {measures} FROM w) "
            f"SELECT l_suppkey, l_returnflag, {statistics_sql(*WIDE, digits=3)}, {areas} FROM x "
            "GROUP BY l_suppkey, l_returnflag, window_id HAVING count(*) >= 3")


@query(_wide_sql())
def window_features_wide(spark, folder):
    """Forty measures and twelve magnitude areas: 172 features in one pass."""
    df = items(spark, folder).select("l_suppkey", "l_returnflag", "l_shipdate", *ITEM_MEASURES)
    return rounded_features(windows.window_features(
        df, ITEMS, list(WIDE), AXES, least=3,
        derived={m: F.col(c) * f for m, (c, f) in WIDE.items()}), 3)


@query(f"""WITH {EVENT_WINDOWS} SELECT user_id, event_type, window_id, count(*) AS sample_count
           FROM w GROUP BY 1, 2, 3 HAVING count(*) >= {windows.least_rows(5 * DAY, 1e-5, 0.75)}""")
def window_quality_gate(spark, folder):
    counted = windows.aggregate_windows(
        windows.assign_windows(events(spark, folder), EVENTS), EVENTS, [])
    return windows.gate(counted, windows.least_rows(5 * DAY, 1e-5, 0.75))


@query(f"""WITH {EVENT_WINDOWS} SELECT event_type, count(*) AS n_rows, max(window_id) AS max_window
           FROM w GROUP BY 1""")
def window_population(spark, folder):
    windowed = windows.assign_windows(events(spark, folder), EVENTS)
    return windows.window_population(windowed, EVENTS, ["event_type"])


COMPLETE = f"""{EVENT_WINDOWS},
c AS (SELECT user_id, event_type, window_id FROM w GROUP BY 1, 2, 3 HAVING count(*) = 3),
k AS (SELECT w.* FROM w JOIN c USING (user_id, event_type, window_id))"""


@query(f"WITH {COMPLETE} SELECT event_id, window_id FROM k")
def complete_windows_semi(spark, folder):
    windowed = windows.assign_windows(events(spark, folder), EVENTS)
    return windows.keep_complete(windowed, EVENTS, 3).select("event_id", "window_id")


def _sequences(spark, folder, layout):
    df = events(spark, folder).withColumn("slot", (F.col("event_id") % 10).cast("double"))
    rows = sequences.complete_rows(df, EVENTS, ["value", "slot"], 3, extra=["event_id"])
    return sequences.assemble(rows, EVENTS, ["value", "slot"], 3, "event_id", layout)


def _steps_sql(prefix: str) -> str:
    cells = [("value", i) for i in range(3)] + [("event_id % 10", i) for i in range(3)]
    return ", ".join(
        f"CAST(CAST(list({c} ORDER BY ts, event_id)[{i + 1}] AS FLOAT) AS DOUBLE) AS "
        f"{prefix}{'value' if c == 'value' else 'slot'}_{i}" for c, i in cells)


@query(f"WITH {COMPLETE} SELECT user_id, event_type, window_id, {_steps_sql('step_')} FROM k "
       "GROUP BY 1, 2, 3")
def sequence_assemble(spark, folder):
    made = _sequences(spark, folder, sequences.STEPS_FIRST)
    return made.select(*EVENTS.keys, *[
        F.col("sequence")[i][j].cast("double").alias(f"step_{name}_{i}")
        for i in range(3) for j, name in enumerate(("value", "slot"))])


@query(f"WITH {COMPLETE} SELECT user_id, event_type, window_id, {_steps_sql('channel_')} FROM k "
       "GROUP BY 1, 2, 3")
def sequence_channels_first(spark, folder):
    made = _sequences(spark, folder, sequences.CHANNELS_FIRST)
    return made.select(*EVENTS.keys, *[
        F.col("sequence")[j][i].cast("double").alias(f"channel_{name}_{i}")
        for i in range(3) for j, name in enumerate(("value", "slot"))])


@query(f"""WITH {COMPLETE} SELECT user_id, event_type, window_id,
           row_number() OVER (ORDER BY user_id, event_type, window_id) - 1 AS sequence_id FROM c""")
def sequence_metadata(spark, folder):
    windowed = windows.assign_windows(events(spark, folder), EVENTS)
    return sequences.number_windows(windows.complete_windows(windowed, EVENTS, 3), EVENTS)


@query(f"""WITH {COMPLETE} SELECT event_type, count(*) AS n_windows FROM c GROUP BY 1""")
def sequence_class_histogram(spark, folder):
    windowed = windows.assign_windows(events(spark, folder), EVENTS)
    return windows.complete_windows(windowed, EVENTS, 3).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_windows"))


@query(f"""WITH {EVENT_WINDOWS} SELECT user_id, event_type, {statistics_sql('value')}
           FROM w GROUP BY user_id, event_type, window_id HAVING count(*) >= 2""")
def transformer_stage(spark, folder):
    stage = WindowFeatures(windowSeconds=5.0 * DAY, sampleRate=1e-5, minFill=0.5, timeCol="ts",
                           segmentCols=["user_id", "event_type"])
    return rounded_features(stage.transform(events(spark, folder)))


@query(f"""
WITH {IMPUTED},
s AS (SELECT min(value) AS lo, max(value) AS hi FROM imputed),
z AS (SELECT user_id, event_type, ts, (value - lo) / (hi - lo) AS value FROM imputed, s),
w AS (SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id, event_type))
             // 432000000000 AS window_id FROM z)
SELECT user_id, event_type, window_id, count(*) AS sample_count,
       {near_sql('avg(value)')} AS value_mean, {near_sql('stddev_samp(value)')} AS value_std,
       {near_sql('min(value)')} AS value_min, {near_sql('max(value)')} AS value_max
FROM w GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def silver_to_gold(spark, folder):
    """Filled, scaled, cut into windows; the filled layer is materialised, as the layered job does."""
    filled = durable(imputed_events(spark, folder))
    scaled = scaling.minmax(filled, ["value"])
    made = windows.window_features(scaled, EVENTS, ["value"], least=2, keep_helpers=True)
    return near_all(made, ["value_mean", "value_std", "value_min", "value_max"])
