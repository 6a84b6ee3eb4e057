import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from windrow.operators import splits


def labelled(spark):
    return spark.range(1000).select("id", (F.col("id") % 7 == 0).cast("int").alias("label"),
                                    (F.col("id") % 20).alias("subject"))


def test_split_is_disjoint_complete_and_layout_free(spark):
    df = labelled(spark)
    sides = []
    for parts in (1, 2, 7):
        train, test = splits.split(df.repartition(parts), ["id"])
        a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
        assert not a & b and len(a | b) == 1000
        sides.append(a)
    assert sides[0] == sides[1] == sides[2] and 750 < len(sides[0]) < 850


def test_subjects_stay_together(spark):
    marked = splits.mark_split(labelled(spark), ["subject"], 0.5)
    assert marked.groupBy("subject").agg(F.count_distinct("in_train").alias("n")).filter("n > 1").count() == 0


@pytest.mark.parametrize("bins", [None, 3, 1])
@pytest.mark.parametrize("train", [0.8, 0.0, 1.0])
def test_stratified_sizes_are_exact(spark, bins, train):
    marked = splits.mark_stratified(labelled(spark), "label", "id", train, bins=bins)
    got = dict(rows_of(marked.groupBy("label").agg(F.sum(F.col("in_train").cast("int")))))
    assert got == {1: round(143 * train), 0: round(857 * train)}
    assert marked.count() == 1000


def test_stratified_does_not_depend_on_bins(spark):
    one = {r.id for r in splits.mark_stratified(labelled(spark), "label", "id").filter("in_train").collect()}
    two = {r.id for r in splits.mark_stratified(labelled(spark), "label", "id", bins=5).filter("in_train").collect()}
    assert one == two


def test_samples_grow_with_the_share(spark):
    small = {r.id for r in splits.stable_sample(labelled(spark), ["id"], 0.25).collect()}
    large = {r.id for r in splits.stable_sample(labelled(spark), ["id"], 0.5).collect()}
    assert small < large


def test_repeated_splits_differ_by_seed(spark):
    made = splits.repeated_splits(labelled(spark), ["id"], [1, 2])
    assert [s for s, _, _ in made] == [1, 2]
    assert rows_of(made[0][1].orderBy("id")) != rows_of(made[1][1].orderBy("id"))
