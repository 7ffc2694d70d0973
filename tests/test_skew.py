"""One seller and one customer hold a third of all rows: results stay whole, work stays spread."""

from __future__ import annotations

import os

import duckdb
import pytest

from ledgerline.operators import churn, measures, ranking
from ledgerline.session import freeze
from ledgerline.workloads import QUERIES
from ledgerline.workloads.binding import Binding
from tests.test_against_sql import rows

SOURCE = "/root/testdata/sf0.001"
NAMES = (
    "order_value_by_tag", "revenue_by_location", "location_table", "users_per_location", "repeat_customers",
    "menu_first_listing", "menu_price_by_cuisine", "orphan_counts", "quarantined_menu", "rfm_segments",
    "purchase_gaps", "churn_threshold", "stratified_split", "user_baskets", "described_orders",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    duck = duckdb.connect()
    duck.sql("SET TimeZone = 'UTC'")
    changed = {
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
        "lineitem": "SELECT * REPLACE (CASE WHEN l_linenumber % 3 = 0 THEN 42 ELSE l_partkey END AS l_partkey)",
    }
    for file in os.listdir(SOURCE):
        table = file.removesuffix(".parquet")
        duck.sql(f"COPY ({changed.get(table, 'SELECT *')} FROM '{SOURCE}/{file}') TO '{folder}/{file}'")
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{file}'")
    return folder, duck


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_on_skewed_data(spark, skewed, name):
    folder, duck = skewed
    frame = QUERIES[name].run(spark, folder)
    columns = sorted(frame.columns)
    relation = duck.sql(QUERIES[name].sql)
    at = [list(relation.columns).index(c) for c in columns]
    assert rows(tuple(r[c] for c in columns) for r in frame.collect()) == rows(
        tuple(r[i] for i in at) for r in relation.fetchall()
    )


def test_hot_seller_is_one_row_before_the_join(spark, skewed):
    b = Binding(spark, skewed[0])
    totals = measures.seller_totals(b.orders("sales_amount", "currency", "restaurant_id"), b.c)
    assert totals.count() == totals.select("restaurant_id").distinct().count()


def test_hot_customer_spreads_over_partitions(spark, skewed):
    b = Binding(spark, skewed[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        times = b.orders("user_id", "order_datetime").where("user_id = 7").distinct()
        placed = ranking._place(times, ["order_datetime"], ["user_id"])
        sizes = [r["count"] for r in placed.groupBy("__part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_gaps_of_the_hot_customer_are_whole(spark, skewed):
    b = Binding(spark, skewed[0])
    orders = b.orders("user_id", "order_datetime")
    counts = freeze(churn.gap_counts(churn.purchase_gaps(orders, b.c)))
    known = orders.where("user_id is not null")
    expected = known.count() - known.select("user_id").distinct().count()
    assert counts.groupBy().sum("n").first()[0] == expected
