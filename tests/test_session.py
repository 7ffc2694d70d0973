"""Checkpoint folder and checked broadcasts."""

from __future__ import annotations

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerline.model import StarModel, apply_slicers
from ledgerline.session import broadcast_if_small, ensure_checkpoint_dir, freeze


def fake(master, current=None, configured=None):
    folder = [current]
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: folder[0], setCheckpointDir=lambda d: folder.__setitem__(0, d)
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured))


def test_a_cluster_needs_a_shared_checkpoint_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake("yarn"))


def test_the_folder_of_the_session_is_used():
    assert ensure_checkpoint_dir(fake("yarn", configured="hdfs:///c")) == "hdfs:///c"
    assert ensure_checkpoint_dir(fake("yarn", current="hdfs:///now", configured="hdfs:///c")) == "hdfs:///now"
    assert "ledgerline-checkpoint" in ensure_checkpoint_dir(fake("local[2]"))


def test_frozen_rows_do_not_change(spark):
    frozen = freeze(spark.range(100).withColumn("r", F.rand()))
    assert frozen.collect() == frozen.collect()
    assert "Range" not in frozen._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_bound(spark):
    small, large = spark.range(10), spark.range(11)
    assert "broadcast" in broadcast_if_small(small, 10)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(large, 10)._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("bounds", [("2020-01-02", "2020-01-03"), (date(2020, 1, 2), date(2020, 1, 3))])
def test_date_slicer_includes_both_days(spark, bounds):
    times = [datetime(2020, 1, 1, 23), datetime(2020, 1, 2), datetime(2020, 1, 3, 23, 59), datetime(2020, 1, 4)]
    orders = spark.createDataFrame([(t,) for t in times], "order_datetime timestamp_ntz")
    model = apply_slicers(StarModel(orders, spark.range(1)), date_from=bounds[0], date_to=bounds[1])
    assert [r[0] for r in model.orders.orderBy(F.col("order_datetime")).collect()] == times[1:3]
