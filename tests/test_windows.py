import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.operators import joins, sequences, windows
from windrow.operators.ordering import dense_index
from windrow.operators.windows import WindowSpec

SPEC = WindowSpec(("subject", "label"), "t", 5.0)


def test_segments_span_sessions_and_bouts(samples):
    got = windows.assign_windows(samples, SPEC).filter("subject = 1 AND label = 1")
    assert sorted(rows_of(got.select("session", "t", "window_id"))) == [
        ("optional", 0.5, 0), ("optional", 100.0, 20), ("protocol", 0.0, 0), ("protocol", 1.0, 0),
        ("protocol", 4.99, 0), ("protocol", 5.0, 1)]
    by_session = WindowSpec(("subject", "label", "session"), "t", 5.0)
    apart = windows.assign_windows(samples, by_session).filter("session = 'optional'")
    assert sorted(r.window_id for r in apart.collect()) == [0, 19]


def test_a_null_segment_key_is_a_segment(spark):
    df = spark.createDataFrame([(None, 1, 3.0), (None, 1, 9.0), (1, 1, 0.0)],
                               "subject int, label int, t double")
    assert sorted(r.window_id for r in windows.assign_windows(df, SPEC).collect()) == [0, 0, 1]


def test_features_of_one_row_and_of_a_constant(samples):
    got = {tuple(r[:3]): r for r in windows.window_features(
        samples.filter("label = 1"), SPEC, ["m2", "m3"], keep_helpers=True).collect()}
    first, single = got[1, 1, 0], got[1, 1, 1]
    assert first.sample_count == 4 and first.m2_std == 0.0 and first.m3_mean == pytest.approx(7 / 3)
    assert single.m2_std is None and single.m2_mean == 5.0


def test_gate_and_helpers(samples):
    made = windows.window_features(samples.filter("label = 1"), SPEC, ["m2"], least=2)
    assert made.columns == ["subject", "label", "m2_mean", "m2_std", "m2_min", "m2_max"]
    assert made.count() == 1
    assert windows.least_rows(5.0, 100, 0.5) == 250


def test_magnitude_area_skips_rows_lacking_an_axis(spark):
    df = spark.createDataFrame([(1.0, -2.0, 3.0), (4.0, None, 1.0)], "x double, y double, z double")
    assert df.agg(*windows.magnitude_areas({"g": ("x", "y", "z")})).first()[0] == 6.0


def test_window_rows_add_up(spark, tiny):
    df = spark.read.parquet(f"{tiny}/events.parquet")
    spec = WindowSpec(("user_id",), "ts", 86_400.0)
    made = windows.window_features(df, spec, ["value"], keep_helpers=True)
    assert made.agg(F.sum("sample_count")).first()[0] == df.count()


def test_shuffle_path_gives_the_same_windows(spark, tiny, monkeypatch):
    df = spark.read.parquet(f"{tiny}/events.parquet").select("event_id", "ts", "user_id", "value")
    hot = df.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("user_id")))
    spec = WindowSpec(("user_id",), "ts", 86_400.0, spread=("event_id",))
    small = windows.assign_windows(hot, spec)
    want = sorted(rows_of(small.select("event_id", "window_id")))
    monkeypatch.setattr(joins, "is_small", lambda *a, **k: False)
    large = windows.assign_windows(hot, spec)
    assert sorted(rows_of(large.select("event_id", "window_id"))) == want


def test_spread_join_matches_a_plain_join(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(
            F.col("id")).alias("k"))
    table = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(
        spark.createDataFrame([(7, 77)], "k long, v long"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = sorted(rows_of(rows.join(table, "k", how).select("id", "k")), key=str)
        got = joins.spread_join(rows, table, ["k"], how, ["id"])
        assert sorted(rows_of(got.select("id", "k")), key=str) == want
    assert sorted(joins.hot_keys(rows, ["k"]).values()) == [3, 3]      # null and 7: a third of 8 parts
    assert sorted(joins.hot_keys(rows, ["k"], parts=30).values()) == [10, 10]
    assert joins.hot_keys(rows.limit(0), ["k"]) == {}


def test_small_is_measured_in_rows_and_bytes(spark):
    assert joins.is_small(spark.range(10))
    assert not joins.is_small(spark.range(11), rows=10)
    wide = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert not joins.is_small(wide, size=500)


def complete_input(spark):
    """Windows of 3, 2 and 4 rows; only the first is complete."""
    times = [0.0, 1.0, 2.0, 5.0, 6.0, 10.0, 11.0, 12.0, 13.0]
    rows = [(1, 1, t, i, t * 10, None if t == 1.0 else t) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "subject int, label int, t double, tie int, a double, b double")


@pytest.mark.parametrize("small", [True, False])
def test_complete_windows(spark, monkeypatch, small):
    windowed = windows.assign_windows(complete_input(spark), SPEC)
    monkeypatch.setattr(windows, "is_small", lambda *a, **k: small)
    assert sorted(r.tie for r in windows.keep_complete(windowed, SPEC, 3).collect()) == [0, 1, 2]


def test_sequences_in_both_layouts(spark):
    rows = sequences.complete_rows(complete_input(spark), SPEC, ["a", "b"], 3, extra=["tie"])
    steps = sequences.assemble(rows, SPEC, ["a", "b"], 3, "tie")
    assert steps.first().sequence == [[0.0, 0.0], [10.0, 0.0], [20.0, 2.0]]
    channels = sequences.assemble(rows, SPEC, ["a", "b"], 3, "tie", sequences.CHANNELS_FIRST, pad=-1.0)
    assert channels.first().sequence == [[0.0, 10.0, 20.0], [0.0, -1.0, 2.0]]
    assert steps.schema["sequence"].dataType.simpleString() == "array<array<float>>"


def test_dense_index_without_a_single_task(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    want = [(a, b, i) for i, (a, b) in enumerate(sorted(rows_of(df)))]
    assert sorted(rows_of(dense_index(df.repartition(6), ["a", "b"], "n"))) == want
    assert sorted(rows_of(dense_index(df, ["a", "b"], "n"))) == want
    assert dense_index(df.limit(0), ["a", "b"], "n").count() == 0


def test_many_columns_shuffle_the_rows_once(spark):
    """Forty derived columns: the narrow rows are shuffled once, not four sets of wide partials."""
    spec = WindowSpec(("key",), "t", 10.0)
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 200)).alias("key"),
        F.when(F.col("id") % 3 == 1, F.lit(5.0)).otherwise((F.col("id") / 5)).alias("t"),
        F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("a"),
        (F.col("id") % 11).cast("double").alias("b"))
    derived = {f"c{i:02d}": F.col("ab"[i % 2]) * (1 + i) for i in range(40)}
    areas = {f"g{i}": (f"c{3 * i:02d}", f"c{3 * i + 1:02d}") for i in range(9)}
    names = list(derived)
    made = windows.window_features(rows, spec, names, areas, least=2, derived=derived, keep_helpers=True)
    assert made.columns[:7] == ["key", "window_id", "sample_count", "c00_mean", "c00_std", "c00_min",
                                "c00_max"]
    got = {(r.key, r.window_id): r for r in made.collect()}
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the other sets read the same shuffle; the hot window is combined on the map side
    assert "ReusedExchange" in plan and max(r.sample_count for r in got.values()) > 1_000
    wide, found = rows.withColumns(derived), {}
    for i in range(0, 40, 10):          # few columns at a time are aggregated directly
        for r in windows.window_features(wide, spec, names[i:i + 10], {
                n: a for n, a in areas.items() if a[0] in names[i:i + 10]}, least=2,
                keep_helpers=True).collect():
            found.setdefault((r.key, r.window_id), {}).update(r.asDict())
    assert got.keys() == found.keys()
    for at, r in got.items():
        assert all(r[c] == v or abs(r[c] - v) <= 1e-9 * abs(v) for c, v in found[at].items())
