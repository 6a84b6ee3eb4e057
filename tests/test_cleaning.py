from conftest import rows_of
from pyspark.sql import functions as F

from windrow.operators import cleaning
from windrow.series import measure_columns, triaxial_groups

FIELDS = {"user": "int", "activity": "string", "timestamp": "bigint", "x": "double", "y": "double",
          "z": "double"}


def test_measures_are_doubles_sorted_without_metadata(samples):
    assert measure_columns(samples, ["t", "m2"]) == ["m1", "m3"]
    assert triaxial_groups(["hand"], ["acc", "mag"])["hand_mag"] == (
        "hand_mag_x", "hand_mag_y", "hand_mag_z")


def test_filler_rows_and_rows_without_readings_go(samples):
    labelled = cleaning.drop_label(samples, "label", 0)
    assert labelled.count() == 8
    kept = cleaning.drop_all_missing(samples, ["m1", "m2", "m3"])
    assert kept.count() == 9
    assert cleaning.drop_all_missing(samples, ["m1"]).count() == 8  # NaN is missing, too


def test_column_families(samples):
    assert cleaning.drop_family(samples, "m").columns == ["subject", "session", "t", "label"]
    assert cleaning.keep_family(samples, "m", ["t"]).columns == ["t", "m1", "m2", "m3"]
    assert cleaning.align(samples, ["m2", "no", "t"]).columns == ["m2", "t"]


def test_nan_to_zero_leaves_null_for_the_next_step(samples):
    zeroed = cleaning.nan_to_zero(samples, ["m1"])
    assert zeroed.filter("m1 = 0").count() == 1
    assert zeroed.filter("m1 IS NULL").count() == 1
    assert cleaning.drop_incomplete(zeroed, ["m1", "m3"]).count() == 7
    assert cleaning.fill_missing(samples, ["m1"], -1.0).filter("m1 = -1").count() == 2


def test_lines_with_wrong_fields_or_numbers_are_dropped(spark):
    lines = spark.createDataFrame([(v,) for v in (
        "33,Jogging,49105962326000,-0.69,12.68,0.50;", "33,Jogging,1,2,3", "33,Walk,1,2,3,4;,5",
        "x,Walk,1,2,3,4;", "33,Walk,1,2,3,;", "17,Sit,5,1,2,3")], "value string")
    assert rows_of(cleaning.split_fields(lines, FIELDS)) == [
        (33, "Jogging", 49105962326000, -0.69, 12.68, 0.5), (17, "Sit", 5, 1.0, 2.0, 3.0)]


def test_lookup_decode_and_encode(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "row int, label int")
    names = spark.createDataFrame([(10, "walk")], "label int, name string")
    assert sorted(rows_of(cleaning.lookup(df, names, "label"))) == [
        (1, 10, "walk"), (2, 20, None), (3, None, None)]
    assert sorted(rows_of(cleaning.decode_label(df, names, "label", "name"))) == [
        (1, 10, "walk"), (2, 20, "20"), (3, None, None)]
    assert sorted(rows_of(cleaning.encode_label(df, "label", "code"))) == [
        (1, 10, 0), (2, 20, 1), (3, None, None)]


def test_override_replaces_only_named_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "model string, x double, y double")
    fix = spark.createDataFrame([("b", 9.0, None)], "model string, x double, y double")
    assert sorted(rows_of(cleaning.override(df, fix, ["model"]))) == [("a", 1.0, 2.0), ("b", 9.0, 4.0)]


def test_union_tags_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, i int")
    assert sorted(rows_of(cleaning.union_sessions({"p": a, "o": b}, "part"))) == [
        (1, "x", "p"), (2, "y", "o")]


def test_replace_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert rows_of(cleaning.replace_missing(df, "x", F.lit(5.0))) == [(1.0,), (5.0,)]
