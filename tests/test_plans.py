"""Physical plans: pruning, pushdown, broadcasts, partial aggregation, no one-partition sorts."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F

from ledgerline.model import apply_slicers
from ledgerline.operators import cleaning, joins, measures, profiling, ranking, rfm
from ledgerline.workloads import QUERIES
from ledgerline.workloads.binding import Binding


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_headline_reads_only_its_columns(spark, folder):
    b = Binding(spark, folder)
    text = plan(measures.headline(b.orders("sales_amount", "currency", "order_datetime"), b.c))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert columns <= {"l_orderkey", "l_extendedprice", "l_returnflag", "l_linenumber", "o_orderkey", "o_orderdate"}


def test_order_header_is_joined_only_on_demand(spark, folder):
    b = Binding(spark, folder)
    assert "Join" not in plan(b.orders("sales_amount", "currency", "restaurant_id"))
    assert "Join" in plan(b.orders("user_id"))


def test_dimension_is_broadcast(spark, folder):
    b = Binding(spark, folder)
    joined = joins.enrich_orders(b.orders("restaurant_id", "sales_amount"), b.restaurant(), b.c, "location")
    assert "BroadcastHashJoin" in plan(joined)


def test_rollups_aggregate_before_the_join(spark, folder):
    b = Binding(spark, folder)
    text = plan(measures.order_value_by_tag(b.model("sales_amount", "currency", "restaurant_id")))
    assert "TakeOrderedAndProject" in text
    join = text.index("Join")
    assert "partial_sum" in text[join:], "the fact is summed per seller below the join"


def test_date_slicer_reaches_the_scan(spark, folder):
    fact = spark.read.parquet(f"{folder}/orders.parquet").withColumnRenamed("o_orderdate", "order_datetime")
    b = Binding(spark, folder)
    model = apply_slicers(
        type(b.model())(fact, b.restaurant()), date_from="1996-01-01", date_to="1996-12-31"
    )
    text = plan(model.orders)
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_global_rank_sorts_no_single_partition(spark, folder):
    ranked = ranking.global_row_number(spark.range(100).withColumn("v", F.col("id") % 7), ["v", "id"])
    big = [line for line in plan(ranked).splitlines() if "SinglePartition" in line]
    # The only single partition holds one row per shuffle partition.
    assert len(big) <= 1
    assert "rangepartitioning" not in plan(ranked), "the range shuffle is behind the checkpoint"


def test_scores_are_a_projection(spark, folder):
    b = Binding(spark, folder)
    text = plan(rfm.rfm_segments(b.orders("user_id", "order_datetime", "sales_amount", "currency"), b.c))
    assert "Exchange" not in text and "Window" not in text


def test_sample_values_are_limited_before_the_shuffle(spark, folder):
    text = plan(profiling.column_profile(Binding(spark, folder).restaurant()))
    assert "WindowGroupLimit" in text


def test_rules_reach_the_scan_of_stored_orders(spark, folder, tmp_path):
    b = Binding(spark, folder)
    b.orders().write.parquet(str(tmp_path / "orders"))
    model = replace(b.model("restaurant_id"), orders=spark.read.parquet(str(tmp_path / "orders")))
    text = plan(measures.order_value_by_tag(model))
    assert "EqualTo(currency,INR)" in text and "IsNotNull(restaurant_id)" in text
    assert "ReadSchema: struct<sales_amount:decimal(12,2),currency:string,restaurant_id:bigint>" in text


def test_first_rows_combine_before_the_shuffle(spark, folder):
    b = Binding(spark, folder)
    text = plan(cleaning.keep_first(b.menu(), ("restaurant_id", "food_id"), ["listed_in", "listed_at"]))
    assert text.index("Exchange") < text.index("partial_min_by")


def test_percentiles_are_not_collected(spark, folder):
    b = Binding(spark, folder)
    text = plan(ranking.quantiles(b.menu(), "price", (0.5,), by=["cuisine"]))
    assert "percentile" not in text and "collect" not in text.lower().replace("collectlimit", "")


def test_every_query_plan_is_free_of_cross_joins(spark, folder):
    fitted = {"silhouette_by_k", "clustered_customers", "cluster_profile", "segments_against_clusters",
              "churn_model_quality", "churn_feature_importance", "load_report"}
    for name, query in QUERIES.items():
        if name not in fitted:
            text = plan(query.run(spark, folder))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_profiles_scan_once_and_shuffle_no_text(spark, folder):
    docs = Binding(spark, folder).raw("documents").select("doc_id", "lang", "text")
    profile = profiling.column_profile(docs)
    profile.collect()
    final = profile._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("Initial Plan")] if "Initial Plan" in final else final
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final
    assert "hashpartitioning(column" in final and "hashpartitioning(column, value" not in final
