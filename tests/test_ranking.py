"""Distributed order against pandas, also with one value holding a third of all rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import ranking
from ledgerline.session import freeze


@pytest.fixture(scope="module")
def skewed(spark):
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919 % 1000)
    return freeze(spark.range(12_000).select("id", value.alias("v"), (F.col("id") % 5 > 0).cast("int").alias("g")))


@pytest.fixture(scope="module")
def local(skewed):
    return skewed.toPandas()


def test_row_numbers(skewed, local):
    got = ranking.global_row_number(skewed, ["v", "id"]).toPandas().sort_values(["v", "id"])
    assert (got["row_number"].to_numpy() == np.arange(1, len(local) + 1)).all()


def test_row_numbers_descending(skewed, local):
    got = ranking.global_row_number(skewed, [F.desc("v"), "id"]).toPandas().sort_values("row_number")
    expected = local.sort_values(["v", "id"], ascending=[False, True])
    assert got["id"].tolist() == expected["id"].tolist()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles(skewed, local, by):
    ps = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = ranking.quantiles(skewed, "v", ps, by=by).toPandas()
    for _, row in got.iterrows():
        part = local[local["g"] == row["g"]] if by else local
        assert np.allclose([row[f"q{i}"] for i in range(len(ps))], part["v"].quantile(list(ps)).to_numpy())


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([(1, 3), (5, 1), (9, 2)], "v int, n long")
    assert ranking.quantiles(df, "v", (0.5,), weight="n").first()["q0"] == 3.0


def test_running_totals_within_groups(skewed, local):
    counted = skewed.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = ranking.running_totals(counted, ["v"], {"upto": "n"}, within=["g"]).toPandas().sort_values(["g", "v"])
    expected = local.groupby(["g", "v"]).size().groupby(level=0).cumsum()
    assert got["upto"].tolist() == expected.tolist()


def test_quartiles_follow_the_equal_width_rule(spark):
    for n in (2, 3, 4, 5, 6, 7, 11, 40):
        base = freeze(spark.range(n).withColumn("v", F.lit(1)))
        got = ranking.quartile_scores(base, "id", {"up": ("v", True), "down": ("v", False)}).orderBy("id").toPandas()
        expected = pd.qcut(np.arange(1, n + 1), 4, labels=[1, 2, 3, 4]).astype(int)
        assert got["up"].tolist() == list(expected)
        assert got["down"].tolist() == [5 - e for e in expected]


def test_quartile_of_one_row(spark):
    base = freeze(spark.range(1).withColumn("v", F.lit(1)))
    assert ranking.quartile_scores(base, "id", {"s": ("v", True)}).first()["s"] == 1


def test_quartiles_of_six_are_not_equal_counts(spark):
    base = freeze(spark.range(6).withColumn("v", F.col("id")))
    got = ranking.quartile_scores(base, "id", {"s": ("v", True)}).groupBy("s").count().orderBy("s").collect()
    assert [r["count"] for r in got] == [2, 1, 1, 2] or [r["count"] for r in got] == [2, 1, 2, 1]


def test_previous_value_of_a_hot_group(skewed, local):
    times = skewed.select((F.col("v") == 7).cast("int").alias("u"), F.col("id").alias("t"))
    got = ranking.previous_in_group(times, "u", "t", "p").toPandas().sort_values(["u", "t"])
    frame = local.assign(u=(local["v"] == 7).astype(int), t=local["id"]).sort_values(["u", "t"])
    expected = frame.groupby("u")["t"].shift()
    assert np.array_equal(got["p"].to_numpy(dtype=float), expected.to_numpy(dtype=float), equal_nan=True)


def test_sample_is_reproducible(skewed):
    a = sorted(r["id"] for r in ranking.hashed_sample(skewed, "id", 100).collect())
    b = sorted(r["id"] for r in ranking.hashed_sample(skewed.repartition(7), "id", 100).collect())
    assert a == b and len(a) == 100
    assert ranking.hashed_sample(skewed, "id", 50_000).count() == 12_000
