import glob
import json
import os
import shutil

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.operators.quality import ExpectationError
from windrow.plans import layers
from windrow.sources import readers, writers


def sample_line(t, label, heart, base):
    readings = " ".join(str(base + i) for i in range(51))
    return f"{t} {label} {heart} {readings}"


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    """Raw files of two sessions: 12 s at 100 rows per 5 s, heart rate every tenth row."""
    root = tmp_path_factory.mktemp("raw")
    out = {}
    for session in ("protocol", "optional"):
        folder = root / session
        folder.mkdir()
        for subject in (101, 102):
            lines = []
            for i in range(240):
                heart = 100 + i / 10 if i % 10 == 0 else "NaN"
                label = 0 if i < 20 else 4
                lines.append(sample_line(round(5.12 + i * 0.05, 2), label, heart, i * 0.5))
            lines.append("99.0 4 NaN " + " ".join(["NaN"] * 51))
            (folder / f"subject{subject}.dat").write_text("\n".join(lines) + "\n")
        (folder / "notes.txt").write_text("not a sample file")
        out[session] = str(folder)
    return out


def test_schema_has_54_columns_and_two_more_are_added(spark, folders):
    assert len(readers.sample_schema()) == 54
    raw = layers.raw_layer(spark, folders)
    assert len(raw.columns) == 56 and raw.count() == 4 * 241
    assert sorted(rows_of(raw.select("subject_id", "session_type").distinct())) == [
        (101, "optional"), (101, "protocol"), (102, "optional"), (102, "protocol")]


def test_missing_token_becomes_null_unless_kept(spark, folders):
    null = readers.read_samples(spark, folders["protocol"])
    keep = readers.read_samples(spark, folders["protocol"], nan_policy="keep")
    assert null.filter("heart_rate IS NULL").count() == keep.filter(F.isnan("heart_rate")).count() > 0
    with pytest.raises(ValueError):
        readers.read_samples(spark, folders["protocol"], nan_policy="drop")


def test_file_without_a_number_has_no_key(spark, tmp_path):
    (tmp_path / "plain.dat").write_text(sample_line(1.0, 1, 60, 0) + "\n")
    assert readers.read_samples(spark, str(tmp_path)).select("subject_id").first()[0] is None


def test_layers_end_to_end(spark, folders, tmp_path):
    names = readers.literal_table(spark, [(4, "walking")], "activity_id int, activity_name string")
    layout = layers.Layout(rate=20.0, rows_per_slice=100)
    report = layers.build(spark, folders, str(tmp_path), names, layout)
    assert report.count() == 15 and report.filter("NOT passed").count() == 0
    clean = spark.read.parquet(f"{tmp_path}/clean")
    assert len(clean.columns) == 45 and clean.count() == 4 * 220
    filled = spark.read.parquet(f"{tmp_path}/filled")
    assert filled.filter("heart_rate IS NULL").count() == 0
    features = spark.read.parquet(f"{tmp_path}/features")
    # 220 rows of each session, 11 s long, in shared windows of 200 rows
    assert features.count() == 2 * 2
    rows, columns = layers.training_rows(features, layout)
    assert len(columns) == 172 and rows.count() == 4
    scaled = spark.read.parquet(f"{tmp_path}/scaled")
    lowest, highest = scaled.agg(F.min("hand_gyro_x"), F.max("hand_gyro_x")).first()
    assert (lowest, highest) == (0.0, 1.0)


def test_failed_expectation_stops_the_job(spark, folders, tmp_path):
    with pytest.raises(ExpectationError):
        raw = layers.raw_layer(spark, folders)
        layers.build(spark, folders, str(tmp_path), checks=layers.raw_checks(raw, rows=(10**6, None)))
    assert not os.path.exists(f"{tmp_path}/raw")


def test_sorted_files_are_sorted_and_split_by_key(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 5).alias("k"), F.xxhash64("id").alias("w"))
    path = f"{tmp_path}/out"
    writers.write_sorted(df, path, ["k"], ["w"], rows_per_file=400)
    files = glob.glob(f"{path}/k=*/*.parquet")
    assert len(files) >= 15
    for f in files:
        values = [r.w for r in spark.read.parquet(f).collect()]
        assert values == sorted(values) and len(values) <= 400
    assert spark.read.parquet(path).count() == 5000


def test_verify_finds_a_difference(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("k"))
    path = f"{tmp_path}/out"
    writers.write_partitioned(df, path, ["k"])
    assert all(r.passed for r in writers.verify_written(spark, path, df, ["k"]).collect())
    wrong = {r.fact: r.passed for r in writers.verify_written(
        spark, path, df.filter("id < 9"), ["k"]).collect()}
    assert wrong == {"n_rows": False, "n_columns": True, "distinct_k": True}


def test_reports_and_results(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.5), ("b", None)], "model string, accuracy double")
    paths = writers.export_reports({"one": df, "two": df.limit(1)}, str(tmp_path / "reports"))
    assert [os.path.basename(p) for p in paths] == ["one", "two"]
    assert len(glob.glob(f"{paths[0]}/*.csv")) == 1
    back = readers.read_report(spark, paths[0], "model string, accuracy double")
    assert sorted(rows_of(back)) == [("a", 0.5), ("b", None)]
    with pytest.raises(ValueError):
        writers.export_reports({"../x": df}, str(tmp_path))
    writers.write_results(df, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    (tmp_path / "list.json").write_text(json.dumps([{"model": "a", "accuracy": 0.5}], indent=2))
    assert rows_of(readers.read_results(spark, f"{tmp_path}/list.json", df.schema)) == [("a", 0.5)]


def test_lines_and_tables(spark, tmp_path):
    (tmp_path / "x.txt").write_text("1,2\n3,4\n")
    assert rows_of(readers.read_lines(spark, f"{tmp_path}/x.txt")) == [("1,2",), ("3,4",)]
    writers.write_table(spark.range(3), f"{tmp_path}/t")
    assert readers.read_table(spark, f"{tmp_path}/t").count() == 3


def test_read_back_is_enforced_in_one_pass(spark, tmp_path):
    """What is damaged between writing and reading raises; the input is computed once."""
    calls = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([(i, f"k{i % 3}", None if i % 5 else float(i)) for i in range(200)],
                               "i int, k string, x double")

    def good(rows, path):
        calls.add(1)
        writers.write_partitioned(rows, path, ["k"])
    back, facts = writers.write_verified(df, str(tmp_path / "good"), good)
    assert back.count() == 200 and calls.value == 1 and all(f[3] for f in facts)
    assert [f[0] for f in facts] == ["n_rows", "n_columns", "checksum"]

    def lossy(rows, path):
        good(rows, path)
        shutil.rmtree(f"{path}/k=k1")
    with pytest.raises(writers.WriteError, match="n_rows 133 instead of 200"):
        writers.write_verified(df, str(tmp_path / "lossy"), lossy)

    def altered(rows, path):
        good(rows.withColumn("x", F.coalesce("x", F.lit(0.0))), path)
    with pytest.raises(writers.WriteError, match="checksum"):
        writers.write_verified(df, str(tmp_path / "altered"), altered)
    empty, facts = writers.write_verified(df.limit(0), str(tmp_path / "none"), writers.write_table)
    assert empty.count() == 0 and facts[0][1] == 0
