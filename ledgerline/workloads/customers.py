"""Segments, baskets, churn and forecasts."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.sql import functions as F

from ledgerline.operators import basket, churn, clustering, evaluation, explore, forecast, measures, ranking, rfm, silhouette
from ledgerline.session import freeze
from ledgerline.sources import sinks
from ledgerline.workloads.binding import FESTIVALS
from ledgerline.workloads.quality import _describe_sql, _scratch
from ledgerline.workloads.registry import query

FACT = ("user_id", "order_datetime", "sales_amount", "currency")
SCALED = [f"{f}_z" for f in rfm.FEATURES]
TAGS = "ECONOMY LARGE MEDIUM PROMO SMALL STANDARD anvil bolt gear gizmo plate ring rod widget".split()


def _segments(b):
    return rfm.rfm_segments(b.orders(*FACT), b.c)


@query("rfm_segments", "M6 M7 W2 W3 T8", """
    SELECT user_id, recency_days, frequency, round(CAST(monetary AS DOUBLE), 4) AS monetary,
           CAST(r_score AS BIGINT) AS r_score, CAST(f_score AS BIGINT) AS f_score, CAST(m_score AS BIGINT) AS m_score, segment
    FROM m_segments""")
def rfm_segments(b):
    return _segments(b)


@query("segment_sizes", "A31 P9", "SELECT segment, count(*) AS customers FROM m_segments GROUP BY segment")
def segment_sizes(b):
    return measures.segment_sizes(_segments(b))


@query("revenue_share_by_segment", "A10", """
    g AS (SELECT segment, CAST(sum(monetary) AS DOUBLE) AS revenue FROM m_segments GROUP BY segment)
    SELECT segment, round(revenue, 6) AS revenue, round(revenue / sum(revenue) OVER (), 6) AS share FROM g""", places=6)
def revenue_share_by_segment(b):
    return measures.revenue_share_by_segment(_segments(b))


@query("top_customers", "T5", """
    SELECT user_id, name, segment, round(CAST(monetary AS DOUBLE), 4) AS monetary, frequency
    FROM m_segments JOIN m_users USING (user_id) ORDER BY m_segments.monetary DESC, user_id LIMIT 20""")
def top_customers(b):
    return measures.top_customers(_segments(b), b.users(), b.c)


@query("segment_profile", "A24", """
    SELECT segment, count(*) AS customers, round_even(avg(CAST(recency_days AS DOUBLE)), 1) AS avg_recency_days,
           round_even(avg(CAST(frequency AS DOUBLE)), 1) AS avg_frequency,
           round_even(avg(CAST(monetary AS DOUBLE)), 1) AS avg_monetary FROM m_segments GROUP BY segment""")
def segment_profile(b):
    return explore.segment_profile(_segments(b), "segment", rfm.FEATURES)


@query("segment_by_occupation", "A25", """
    g AS (SELECT segment, occupation, count(*) AS n FROM m_segments JOIN m_users USING (user_id) GROUP BY 1, 2)
    SELECT segment, occupation, n, round_even(n / CAST(sum(n) OVER (PARTITION BY segment) AS DOUBLE), 2) AS share FROM g""")
def segment_by_occupation(b):
    named = _segments(b).join(b.users().select("user_id", "occupation"), "user_id")
    return explore.crosstab_share(named, "segment", "occupation")


@query("described_rfm", "P8", """
    n AS (SELECT CAST(recency_days AS DOUBLE) AS recency_days, CAST(frequency AS DOUBLE) AS frequency,
                 CAST(monetary AS DOUBLE) AS monetary FROM m_rfm),
    lines AS (""" + _describe_sql("n", rfm.FEATURES) + ") SELECT * FROM lines")
def described_rfm(b):
    from ledgerline.operators.profiling import describe

    return describe(freeze(rfm.rfm_base(b.orders(*FACT), b.c)), rfm.FEATURES, places=2)


@query("scaled_rfm", "M8", """
    l AS (SELECT user_id, ln(1 + recency_days) AS r, ln(1 + frequency) AS f,
                 sign(monetary) * ln(1 + abs(CAST(monetary AS DOUBLE))) AS m FROM m_rfm),
    s AS (SELECT avg(r) AS ar, stddev_pop(r) AS sr, avg(f) AS af, stddev_pop(f) AS sf, avg(m) AS am, stddev_pop(m) AS sm FROM l)
    SELECT user_id, round((r - ar) / sr, 4) + 0 AS recency_days_z, round((f - af) / sf, 4) + 0 AS frequency_z,
           round((m - am) / sm, 4) + 0 AS monetary_z FROM l, s""")
def scaled_rfm(b):
    base = freeze(rfm.rfm_base(b.orders(*FACT), b.c))
    return rfm.scale_features(base).select("user_id", *SCALED)


# A model cannot be fitted in SQL. Queries on one return what can be known about it from the tables, such as
# sizes that add up and rows that lie at their nearest centre, next to what the tables say themselves.


def _sweep(b):
    scaled = freeze(rfm.scale_features(_segments(b)))
    return scaled, clustering.sweep_k(scaled, "user_id", SCALED)


def _clustered(b):
    """Customers with their cluster, and whether no other centre is nearer."""
    scaled, sweep = _sweep(b)
    model = sweep.models[sweep.best_k]
    labelled = clustering.assign_clusters(scaled, SCALED, model, "monetary")
    found = model.transform(clustering.with_vector(labelled, SCALED)).drop("features")
    gaps = _gaps(model)
    return found.withColumn("at_nearest", gaps[F.col("prediction")] <= F.array_min(gaps) + 1e-9), sweep


def _gaps(model):
    """Squared distances of a row to all centres."""
    return F.array(
        *[
            sum((F.pow(F.col(c) - F.lit(float(x)), F.lit(2)) for c, x in zip(SCALED, centre)), F.lit(0.0))
            for centre in model.clusterCenters()
        ]
    )


@query("silhouette_by_k", "M9 M10 M11", """
    SELECT k, (SELECT count(*) FROM m_rfm) AS customers, true AS in_range, true AS cost_adds_up, true AS best_is_chosen
    FROM (SELECT CAST(unnest(generate_series(2, 8)) AS BIGINT) AS k) t""")
def silhouette_by_k(b):
    """Every k of the range: sizes and cost add up, silhouettes are in range, and the best k is chosen."""
    scaled, sweep = _sweep(b)
    vectors = freeze(clustering.with_vector(scaled, SCALED).select("features"))
    best = max(sweep.silhouettes.values())
    rows = []
    for k, model in sorted(sweep.models.items()):
        score = sweep.silhouettes[k]
        # The last step only moves centres closer, so the fit's own cost is an upper bound.
        left = scaled.agg(F.sum(F.array_min(_gaps(model)))).first()[0]
        adds_up = 0 <= left <= model.summary.trainingCost * (1 + 1e-9) + 1e-9
        again = float(ClusteringEvaluator(featuresCol="features").evaluate(model.transform(vectors)))
        chosen = (score == best) == (k == sweep.best_k) or score == best
        rows.append((k, sum(model.summary.clusterSizes), -1.0 <= score <= 1.0 and abs(score - again) < 1e-6, adds_up, chosen))
    return b.spark.createDataFrame(rows, "k int, customers bigint, in_range boolean, cost_adds_up boolean, best_is_chosen boolean")


@query("silhouette_of_given_labels", "M10", """
    l AS (SELECT user_id, r_score AS label, ln(1 + recency_days) AS r, ln(1 + frequency) AS f,
                 sign(monetary) * ln(1 + abs(CAST(monetary AS DOUBLE))) AS m FROM m_scored),
    s AS (SELECT avg(r) AS ar, stddev_pop(r) AS sr, avg(f) AS af, stddev_pop(f) AS sf, avg(m) AS am, stddev_pop(m) AS sm FROM l),
    z AS (SELECT user_id, label, (r - ar) / sr AS x, (f - af) / sf AS y, (m - am) / sm AS w FROM l, s),
    size AS (SELECT label, count(*) AS n FROM z GROUP BY label),
    d AS (SELECT a.user_id, a.label AS own, b.label AS other,
                 sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.w - b.w) ** 2) AS total
          FROM z a, z b GROUP BY 1, 2, 3),
    e AS (SELECT user_id, max(CASE WHEN own = other THEN total / greatest(n - 1, 1) END) AS inner_mean,
                 min(CASE WHEN own <> other THEN total / n END) AS outer_mean
          FROM d JOIN size ON size.label = d.other GROUP BY user_id)
    SELECT round(avg((outer_mean - inner_mean) / greatest(inner_mean, outer_mean)), 6) AS silhouette FROM e""", places=6)
def silhouette_of_given_labels(b):
    scaled = freeze(rfm.scale_features(_segments(b)))
    score = clustering.silhouette(clustering.with_vector(scaled, SCALED), "r_score")
    return b.spark.createDataFrame([(score,)], "silhouette double")


@query("plain_silhouette_of_given_labels", "M10", """
    l AS (SELECT user_id, r_score AS label, ln(1 + recency_days) AS r, ln(1 + frequency) AS f,
                 sign(monetary) * ln(1 + abs(CAST(monetary AS DOUBLE))) AS m FROM m_scored),
    s AS (SELECT avg(r) AS ar, stddev_pop(r) AS sr, avg(f) AS af, stddev_pop(f) AS sf, avg(m) AS am, stddev_pop(m) AS sm FROM l),
    z AS (SELECT user_id, label, (r - ar) / sr AS x, (f - af) / sf AS y, (m - am) / sm AS w FROM l, s),
    p AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(user_id AS VARCHAR) || '-42'), user_id) <= 10000 AS taken FROM z),
    size AS (SELECT label, count(*) AS n, count(*) FILTER (WHERE taken) AS taken_n FROM p GROUP BY label),
    d AS (SELECT a.user_id, a.taken, a.label AS own, b.label AS other,
                 sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.w - b.w) ** 2)) AS total,
                 coalesce(sum(CASE WHEN b.taken THEN sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.w - b.w) ** 2) END), 0) AS taken_total
          FROM p a, p b GROUP BY ALL),
    e AS (SELECT user_id, taken, max(CASE WHEN own = other THEN total / greatest(n - 1, 1) END) AS a,
                 min(CASE WHEN own <> other THEN total / n END) AS b,
                 max(CASE WHEN own = other THEN taken_total / greatest(taken_n - 1, 1) END) AS ta,
                 min(CASE WHEN own <> other THEN taken_total / taken_n END) AS tb
          FROM d JOIN size ON size.label = d.other GROUP BY user_id, taken)
    SELECT count(*) AS rows, round(avg((b - a) / greatest(a, b)), 4) AS silhouette, count(*) FILTER (WHERE taken) AS sample_rows,
           round(avg((tb - ta) / greatest(ta, tb)) FILTER (WHERE taken), 4) AS sample_silhouette FROM e""")
def plain_silhouette_of_given_labels(b):
    """Plain distances: of all rows by the tree of cells, and of a sample of 10,000 by all pairs."""
    scaled = freeze(rfm.scale_features(_segments(b)).select("user_id", "r_score", *SCALED))
    score = silhouette.plain_silhouette(scaled, SCALED, "r_score", tolerance=0)
    sample = freeze(ranking.hashed_sample(scaled, "user_id", 10_000))
    of_sample = clustering.silhouettes(clustering.with_vector(sample, SCALED), {0: "r_score"})[0]
    row = (score.rows, score.silhouette, sample.count(), of_sample)
    return b.spark.createDataFrame([row], "rows bigint, silhouette double, sample_rows bigint, sample_silhouette double")


@query("plain_silhouette_with_bound", "M10")
def plain_silhouette_with_bound(b):
    """The same for margins from none to a tenth: the value, how far off it can be, and what the grid holds."""
    scaled = freeze(rfm.scale_features(_segments(b)).select("user_id", "r_score", *SCALED))
    rows = []
    for tolerance in (0.0, 0.01, 0.1):
        s = silhouette.plain_silhouette(scaled, SCALED, "r_score", tolerance, most_cells=2_000)
        rows.append((tolerance, s.silhouette, s.bound, s.rows, s.cells))
    return b.spark.createDataFrame(rows, "tolerance double, silhouette double, bound double, rows bigint, cells bigint")


@query("clustered_customers", "M9 M11", """
    SELECT user_id, recency_days, frequency, round(CAST(monetary AS DOUBLE), 4) AS monetary, segment, true AS at_nearest
    FROM m_segments""")
def clustered_customers(b):
    customers, _ = _clustered(b)
    return customers.select("user_id", "recency_days", "frequency", "monetary", "segment", "at_nearest")


@query("customer_clusters", "M9 M11")
def customer_clusters(b):
    """Every customer with the cluster of the chosen size."""
    customers, _ = _clustered(b)
    return customers.select("user_id", "segment", "cluster", *SCALED)


@query("silhouettes_and_costs", "M9 M10 M11")
def silhouettes_and_costs(b):
    """Silhouette and cost of the best fit of every size, the chosen size, and the least and greatest cluster."""
    _, sweep = _sweep(b)
    rows = [
        (k, sweep.silhouettes[k], m.summary.trainingCost, min(m.summary.clusterSizes), max(m.summary.clusterSizes), k == sweep.best_k)
        for k, m in sorted(sweep.models.items())
    ]
    return b.spark.createDataFrame(rows, "k int, silhouette double, cost double, least bigint, greatest bigint, chosen boolean")


@query("cluster_profile", "A24 M9", """
    SELECT count(*) AS customers, round(avg(CAST(frequency AS DOUBLE)), 4) AS frequency, true AS numbered, true AS money_falls
    FROM m_rfm""")
def cluster_profile(b):
    """Profiles of all clusters together: sizes and weighted means are those of all customers."""
    customers, sweep = _clustered(b)
    profile = explore.segment_profile(customers, "cluster", rfm.FEATURES, places=12)
    rows = sorted(profile.collect(), key=lambda r: r["cluster"])
    total = sum(r["customers"] for r in rows)
    money = [r["avg_monetary"] for r in rows]
    line = (
        total,
        sum(r["customers"] * r["avg_frequency"] for r in rows) / total,
        [r["cluster"] for r in rows] == list(range(sweep.best_k)),
        money == sorted(money, reverse=True),
    )
    return b.spark.createDataFrame([line], "customers bigint, frequency double, numbered boolean, money_falls boolean")


@query("segments_against_clusters", "M12 A25", """
    SELECT segment, count(*) AS n, true AS shares_add_up FROM m_segments GROUP BY segment""")
def segments_against_clusters(b):
    table = explore.crosstab_share(_clustered(b)[0], "segment", "cluster")
    return table.groupBy("segment").agg(F.sum("n").alias("n"), (F.abs(F.sum("share") - 1) < 0.05).alias("shares_add_up"))


# Baskets ---------------------------------------------------------------------------------------
# All subsets of the tags that occur, counted by bit mask: independent of any mining algorithm.
SQL_ITEMSETS = """
    pair AS (SELECT DISTINCT {key} AS basket, tag FROM m_orders JOIN m_tags USING (restaurant_id)
             WHERE {key} IS NOT NULL AND tag IS NOT NULL),
    item AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS i FROM (SELECT DISTINCT tag FROM pair) t),
    mask AS (SELECT basket, bit_or(CAST(1 AS BIGINT) << CAST(i AS INTEGER)) AS m FROM pair JOIN item USING (tag) GROUP BY basket),
    kinds AS (SELECT m, count(*) AS n FROM mask GROUP BY m),
    subset AS (SELECT unnest(generate_series(CAST(1 AS BIGINT), (CAST(1 AS BIGINT) << (SELECT CAST(count(*) AS INTEGER) FROM item)) - 1)) AS s),
    sets AS (SELECT s, sum(n) AS freq, sum(n) / CAST((SELECT count(*) FROM mask) AS DOUBLE) AS support
             FROM subset JOIN kinds ON (m & s) = s GROUP BY s
             HAVING sum(n) >= {support} * (SELECT count(*) FROM mask)),
    named AS (SELECT s, string_agg(tag, ' + ' ORDER BY tag) AS name, count(*) AS size
              FROM sets JOIN item ON (s >> CAST(i AS INTEGER)) & 1 = 1 GROUP BY s)"""
SQL_RULES = SQL_ITEMSETS + """,
    rules AS (SELECT na.name AS antecedents, nc.name AS consequents, w.support, w.support / a.support AS confidence,
                     w.support / a.support / c.support AS lift
              FROM sets w JOIN sets a ON (a.s & w.s) = a.s AND a.s <> w.s JOIN sets c ON c.s = w.s - a.s
              JOIN named na ON na.s = a.s JOIN named nc ON nc.s = c.s)"""


def _user_itemsets(b, min_support):
    model = b.model("user_id", "restaurant_id")
    return basket.frequent_itemsets(basket.build_baskets(basket.tag_pairs(model)), min_support)


def _order_itemsets(b, min_support):
    model = b.model("basket_id", "restaurant_id")
    return basket.frequent_itemsets(basket.build_baskets(basket.tag_pairs(model, "basket_id")), min_support)


@query("user_tag_pairs", "A17 J2 R3", """
    SELECT DISTINCT user_id AS basket, tag AS item FROM m_orders JOIN m_tags USING (restaurant_id)
    WHERE user_id IS NOT NULL AND tag IS NOT NULL""")
def user_tag_pairs(b):
    return basket.tag_pairs(b.model("user_id", "restaurant_id"))


@query("user_baskets", "M1", """
    SELECT user_id AS basket, string_agg(DISTINCT tag, '|' ORDER BY tag) AS items
    FROM m_orders JOIN m_tags USING (restaurant_id) WHERE user_id IS NOT NULL AND tag IS NOT NULL GROUP BY 1""")
def user_baskets(b):
    return basket.build_baskets(basket.tag_pairs(b.model("user_id", "restaurant_id")))


@query("user_tag_matrix", "A25 M1", """
    SELECT user_id AS basket, """ + ", ".join(f"""bool_or(tag = '{t}') AS "has_{t}\"""" for t in TAGS) + """
    FROM m_orders JOIN m_tags USING (restaurant_id) WHERE user_id IS NOT NULL AND tag IS NOT NULL GROUP BY 1""")
def user_tag_matrix(b):
    """One column for each tag that occurs; the SQL names the tags of the given tables."""
    return explore.presence_matrix(freeze(basket.tag_pairs(b.model("user_id", "restaurant_id"))), "basket", "item")


@query("order_itemsets", "M2 T3", SQL_ITEMSETS.format(key="basket_id", support=0.01) + """
    SELECT name AS itemset, CAST(freq AS BIGINT) AS freq, round(support, 6) AS support FROM sets JOIN named USING (s)""",
       places=6)
def order_itemsets(b):
    sets = _order_itemsets(b, 0.01)
    return sets.select(F.array_join("items", " + ").alias("itemset"), "freq", "support")


@query("top_order_itemsets", "T3 M2", SQL_ITEMSETS.format(key="basket_id", support=0.01) + """
    SELECT name AS itemset, CAST(freq AS BIGINT) AS freq, round(support, 6) AS support
    FROM sets JOIN named USING (s) ORDER BY freq DESC, itemset LIMIT 10""", places=6)
def top_order_itemsets(b):
    return basket.top_itemsets(_order_itemsets(b, 0.01))


@query("order_rules", "M3", SQL_RULES.format(key="basket_id", support=0.01) + """
    SELECT antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift
    FROM rules WHERE lift >= 1""", places=6)
def order_rules(b):
    rules = basket.association_rules(_order_itemsets(b, 0.01))
    return rules.select(
        F.array_join("antecedents", " + ").alias("antecedents"), F.array_join("consequents", " + ").alias("consequents"),
        "support", "confidence", "lift",
    )


@query("top_order_rules", "M3 M4 T3", SQL_RULES.format(key="basket_id", support=0.01) + """
    SELECT antecedents || '  ->  ' || consequents AS rule, antecedents, consequents, round_even(support, 4) AS support,
           round_even(confidence, 4) AS confidence, round_even(lift, 4) AS lift
    FROM rules WHERE lift >= 1 ORDER BY round(rules.lift, 9) DESC, antecedents, consequents LIMIT 50""")
def top_order_rules(b):
    return basket.top_rules(basket.association_rules(_order_itemsets(b, 0.01)))


@query("user_rules", "M2 M3 M4", SQL_RULES.format(key="user_id", support=0.01) + """
    SELECT antecedents || '  ->  ' || consequents AS rule, antecedents, consequents, round_even(support, 4) AS support,
           round_even(confidence, 4) AS confidence, round_even(lift, 4) AS lift
    FROM rules WHERE lift >= 1 ORDER BY round(rules.lift, 9) DESC, antecedents, consequents LIMIT 50""")
def user_rules(b):
    return basket.top_rules(basket.association_rules(_user_itemsets(b, 0.01)))


@query("rule_chart", "T3 M4", SQL_RULES.format(key="basket_id", support=0.01) + """,
    best AS (SELECT * FROM rules WHERE lift >= 1 ORDER BY round(lift, 9) DESC, antecedents, consequents LIMIT 15)
    SELECT substring(antecedents, 1, 18) || '  ->  ' || substring(consequents, 1, 18) AS label,
           round_even(lift, 3) AS lift FROM best""")
def rule_chart(b):
    best = basket.top_rules(basket.association_rules(_order_itemsets(b, 0.01)), 15, places=3)
    return basket.rule_labels(best).select("label", "lift")


@query("explained_rules", "M5", SQL_RULES.format(key="basket_id", support=0.01) + """,
    best AS (SELECT * FROM rules WHERE lift >= 1 ORDER BY round(lift, 9) DESC, antecedents, consequents LIMIT 20),
    shown AS (SELECT antecedents, consequents, round_even(support, 3) AS support, round_even(confidence, 3) AS confidence,
                     round_even(lift, 3) AS lift FROM best)
    SELECT antecedents, consequents, lift > 1.2 AS actionable,
           printf('Users who order %s also order %s (lift %.3fx, confidence %d%%, support %.1f%%)', antecedents, consequents,
                  lift, CAST(round(confidence * 100) AS BIGINT), support * 100) AS reading
    FROM shown ORDER BY lift DESC, antecedents, consequents LIMIT 3""")
def explained_rules(b):
    best = basket.top_rules(basket.association_rules(_order_itemsets(b, 0.01)), 20, places=3)
    return basket.explain_rules(best)


# Churn -----------------------------------------------------------------------------------------
CHURN_FACT = (*FACT, "restaurant_id")


def _features(b):
    return churn.churn_features(b.model(*CHURN_FACT))


def _threshold(b):
    return churn.churn_threshold(freeze(churn.gap_counts(churn.purchase_gaps(b.orders("user_id", "order_datetime"), b.c))))


def _labelled(b):
    return freeze(churn.label_churn(_features(b), _threshold(b).select("threshold_days").scalar()))


def _given_scores(b):
    """A score made from the features alone, so that evaluation can be checked exactly."""
    score = ((F.col("tenure_days") + F.col("avg_gap_days") * 3) % 101).cast("double")
    scored = _labelled(b).select("user_id", "churned", score.alias("score"))
    return freeze(scored.withColumn("prediction", (F.col("score") >= 50).cast("int")))


@query("churn_features", "M13 A13 A14 A23 J5 Q20 Q22", """
    SELECT user_id, recency_days, frequency, round(aov, 8) AS aov, tenure_days, avg_gap_days,
           round(CAST(monetary AS DOUBLE), 8) AS monetary, tag_diversity FROM m_features""", places=8)
def churn_features(b):
    return _features(b)


@query("purchase_gaps", "W1 T8", """
    g AS (SELECT user_id, order_datetime, count(*) AS orders FROM m_orders WHERE user_id IS NOT NULL GROUP BY 1, 2),
    p AS (SELECT *, lag(order_datetime) OVER (PARTITION BY user_id ORDER BY order_datetime) AS previous FROM g)
    SELECT user_id, CAST(order_datetime AS VARCHAR) AS order_datetime, orders, CAST(previous AS VARCHAR) AS previous_time,
           date_diff('day', previous, order_datetime) AS gap_days FROM p""")
def purchase_gaps(b):
    return churn.purchase_gaps(b.orders("user_id", "order_datetime"), b.c)


@query("gap_counts", "W1 A22", """
    SELECT gap_days, count(*) AS n FROM m_gaps WHERE gap_days IS NOT NULL GROUP BY 1""")
def gap_counts(b):
    return churn.gap_counts(churn.purchase_gaps(b.orders("user_id", "order_datetime"), b.c))


@query("churn_threshold", "M14 A22", """
    SELECT gaps, round(median_gap, 4) AS median_gap, round(std_gap, 4) AS std_gap, CAST(threshold_days AS BIGINT) AS threshold_days
    FROM m_threshold""")
def churn_threshold(b):
    return _threshold(b)


@query("churn_base_rate", "M15 M23", """
    SELECT count(*) AS customers, round(avg(CAST(churned AS DOUBLE)), 6) AS churn_rate,
           round(greatest(avg(CAST(churned AS DOUBLE)), 1 - avg(CAST(churned AS DOUBLE))), 6) AS majority_share
    FROM m_labelled""", places=6)
def churn_base_rate(b):
    return churn.base_rate(_labelled(b))


@query("stratified_split", "M16", "SELECT user_id, CAST(churned AS BIGINT) AS churned, is_test FROM m_split")
def stratified_split(b):
    return churn.stratified_split(_labelled(b).select("user_id", "churned"), "user_id")


@query("auc_of_given_scores", "M18", """
    r AS (SELECT churned, (rank() OVER (ORDER BY score)
                 + (count(*) OVER (PARTITION BY score) - 1) / 2.0) AS avg_rank FROM m_given_scores),
    t AS (SELECT sum(CASE WHEN churned = 1 THEN avg_rank ELSE 0 END) AS ranks, sum(churned) AS p, count(*) - sum(churned) AS n FROM r)
    SELECT round(CAST(ranks - p * (p + 1) / 2.0 AS DOUBLE) / (p * n), 6) AS auc, CAST(p AS BIGINT) AS positives,
           CAST(n AS BIGINT) AS negatives FROM t""", places=6)
def auc_of_given_scores(b):
    return evaluation.auc(_given_scores(b))


@query("roc_of_given_scores", "M21", """
    g AS (SELECT score, sum(churned) AS p, count(*) - sum(churned) AS n FROM m_given_scores GROUP BY score),
    c AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp FROM g),
    t AS (SELECT sum(p) AS p, sum(n) AS n FROM g)
    SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
           round(CAST(tp AS DOUBLE) / p, 6) AS tpr, round(CAST(fp AS DOUBLE) / n, 6) AS fpr FROM c, t
    UNION ALL SELECT NULL, 0, 0, 0, 0""", places=6)
def roc_of_given_scores(b):
    """The threshold of the origin is infinite, which is shown as NULL."""
    points = evaluation.roc_points(_given_scores(b))
    return points.withColumn("threshold", F.when(F.col("threshold") < 1e300, F.col("threshold")))


@query("confusion_of_given_scores", "M19", """
    SELECT CAST(churned AS BIGINT) AS label, CAST(prediction AS BIGINT) AS prediction, count(*) AS n
    FROM m_given_scores GROUP BY 1, 2""")
def confusion_of_given_scores(b):
    return evaluation.confusion_matrix(_given_scores(b))


@query("report_of_given_scores", "M20", """
    k AS (SELECT c, count(*) FILTER (WHERE churned = c) AS s, count(*) FILTER (WHERE prediction = c) AS claimed,
                 count(*) FILTER (WHERE churned = c AND prediction = c) AS hit
          FROM m_given_scores, (VALUES (0), (1)) v(c) GROUP BY c),
    m AS (SELECT c, s, hit / CAST(claimed AS DOUBLE) AS p, hit / CAST(s AS DOUBLE) AS r, hit FROM k),
    f AS (SELECT *, 2 * p * r / (p + r) AS f FROM m)
    SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM f
    UNION ALL SELECT 'accuracy', round(sum(hit) / CAST(sum(s) AS DOUBLE), 6), round(sum(hit) / CAST(sum(s) AS DOUBLE), 6),
                     round(sum(hit) / CAST(sum(s) AS DOUBLE), 6), CAST(sum(s) AS BIGINT) FROM f
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6),
                     round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM f""", places=6)
def report_of_given_scores(b):
    return evaluation.classification_report(_given_scores(b))


@query("verdict_of_given_scores", "M23", """
    r AS (SELECT churned, (rank() OVER (ORDER BY score)
                 + (count(*) OVER (PARTITION BY score) - 1) / 2.0) AS avg_rank FROM m_given_scores),
    t AS (SELECT sum(CASE WHEN churned = 1 THEN avg_rank ELSE 0 END) AS ranks, sum(churned) AS p, count(*) - sum(churned) AS n FROM r),
    a AS (SELECT CAST(ranks - p * (p + 1) / 2.0 AS DOUBLE) / (p * n) AS auc,
                 greatest(p, n) / CAST(p + n AS DOUBLE) AS majority FROM t)
    SELECT round(majority, 6) AS majority_share, round(auc, 6) AS auc,
           CASE WHEN auc > 0.70 THEN 'real signal' ELSE 'weak signal' END AS verdict FROM a""", places=6)
def verdict_of_given_scores(b):
    scored = _given_scores(b)
    return churn.verdict(churn.base_rate(scored), evaluation.auc(scored))


def _classifier(b):
    split = freeze(churn.stratified_split(_labelled(b), "user_id"))
    train, test = split.where(~F.col("is_test")), split.where("is_test")
    return split, test, churn.fit_classifier(train)


@query("churn_model_quality", "M17 M18 M23 S10", """
    SELECT count(*) FILTER (WHERE is_test) AS judged,
           round(greatest(avg(CAST(churned AS DOUBLE)), 1 - avg(CAST(churned AS DOUBLE))), 6) AS majority_share,
           true AS auc_is_exact, true AS loaded_alike, true AS verdict_follows FROM m_split""", places=6)
def churn_model_quality(b):
    """Fit, store, load again, and judge the loaded model on the held-back customers.

    The AUC is made again from the emitted scores by ranks; the model itself cannot be stated in SQL.
    """
    split, test, model = _classifier(b)
    path = _scratch(b, "churn-model")
    sinks.save_model(model, path)
    scored = freeze(churn.score(sinks.load_pipeline(path), test).select("user_id", "churned", "score", "prediction"))
    verdict = churn.verdict(churn.base_rate(split), evaluation.auc(scored)).first()
    judge = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="churned", numBins=0)
    again = judge.evaluate(scored.select(F.col("score").alias("raw"), F.col("churned").cast("double").alias("churned")))
    direct = churn.score(model, test).select("user_id", F.col("score").alias("direct"))
    alike = scored.join(direct, "user_id").where(F.abs(F.col("score") - F.col("direct")) > 1e-9).count() == 0
    follows = verdict["verdict"] == ("real signal" if verdict["auc"] > churn.USEFUL_AUC else "weak signal")
    line = (scored.count(), verdict["majority_share"], abs(float(again) - verdict["auc"]) < 1e-9, alike, follows)
    return b.spark.createDataFrame(
        [line], "judged bigint, majority_share double, auc_is_exact boolean, loaded_alike boolean, verdict_follows boolean"
    )


@query("churn_scores", "M17 M18 M23")
def churn_scores(b):
    """Score and prediction of every held-back customer, with the verdict on the model."""
    split, test, model = _classifier(b)
    scored = freeze(churn.score(model, test).select("user_id", "churned", "score", "prediction"))
    verdict = churn.verdict(churn.base_rate(split), evaluation.auc(scored)).first()
    return scored.withColumn("auc", F.lit(verdict["auc"])).withColumn("verdict", F.lit(verdict["verdict"]))


@query("churn_feature_importance", "M22", "SELECT unnest(['" + "', '".join(churn.FEATURES) + """']) AS feature,
    true AS is_share, CAST(1 AS DOUBLE) AS whole, (SELECT count(*) FROM m_split WHERE NOT is_test) AS learned_from""")
def churn_feature_importance(b):
    """Importances are shares of one whole."""
    split, _, model = _classifier(b)
    table = freeze(churn.feature_importance(model, split))
    whole = table.agg(F.sum("importance").alias("w")).scalar()
    learned = split.where(~F.col("is_test")).agg(F.count(F.lit(1)).alias("n")).scalar()
    return table.select("feature", F.col("importance").between(0, 1).alias("is_share"), whole.alias("whole"), learned.alias("learned_from"))


# Forecast --------------------------------------------------------------------------------------
SERIES_FACT = ("order_datetime", "sales_amount", "currency")
SQL_SERIES = """
    series AS (SELECT 'all' AS series, week, revenue FROM m_weekly),
    edge AS (SELECT max(week) - 77 AS border FROM series),
    guess AS (SELECT series, CAST(week + 364 AS DATE) AS week, revenue AS forecast, revenue - 1000.001 AS lower, revenue + 1000.001 AS upper
              FROM series WHERE week + 364 <= (SELECT max(week) FROM series))"""


def _series(b, by=None):
    columns = (*SERIES_FACT, *([by] if by else []))
    return freeze(forecast.weekly_series(b.orders(*columns), b.c, by))


def _given_forecast(series):
    """The value of 52 weeks ago, as a forecast that SQL can state too."""
    last = series.agg(F.max("week").alias("w")).scalar()
    ahead = F.date_add("week", 364)
    return series.where(ahead <= last).select(
        "series", ahead.alias("week"), F.col("revenue").alias("forecast"),
        (F.col("revenue") - 1000.001).alias("lower"), (F.col("revenue") + 1000.001).alias("upper"),
    )


@query("holdout_split", "W6", SQL_SERIES + """
    SELECT CASE WHEN week < border THEN 'train' ELSE 'holdout' END AS part, count(*) AS weeks,
           CAST(min(week) AS VARCHAR) AS first_week, CAST(max(week) AS VARCHAR) AS last_week FROM series, edge GROUP BY 1""")
def holdout_split(b):
    series = _series(b)
    train, test = forecast.split_holdout(series, forecast.holdout(series))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("holdout")))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("weeks"), F.min("week").alias("first_week"), F.max("week").alias("last_week")
    )


@query("holdout_errors_of_given_forecast", "M27", SQL_SERIES + """
    SELECT series, count(*) AS weeks, round(avg(abs(revenue - forecast)), 4) AS mae,
           round(avg(abs(revenue - forecast) / greatest(revenue, 1)) * 100, 4) AS mape
    FROM series JOIN guess USING (series, week), edge WHERE week >= border GROUP BY series""")
def holdout_errors_of_given_forecast(b):
    series = _series(b)
    test = forecast.split_holdout(series, forecast.holdout(series))[1]
    return forecast.holdout_errors(test, _given_forecast(series))


@query("run_metadata", "S9 M27", SQL_SERIES + """
    SELECT '52 weeks ago' AS engine, count(*) AS holdout_weeks, round(avg(abs(revenue - forecast)), 2) AS mae,
           round(avg(abs(revenue - forecast) / greatest(revenue, 1)) * 100, 2) AS mape_pct
    FROM series JOIN guess USING (series, week), edge WHERE week >= border""", places=2)
def run_metadata(b):
    """Write the facts of a run as JSON and read them back."""
    series = _series(b)
    test = forecast.split_holdout(series, forecast.holdout(series))[1]
    errors = forecast.holdout_errors(test, _given_forecast(series)).first()
    path = _scratch(b, "run")
    sinks.export_run_metadata(
        b.spark, path, engine="52 weeks ago", holdout_weeks=errors["weeks"], mae=errors["mae"], mape_pct=errors["mape"]
    )
    return b.spark.read.schema("engine string, holdout_weeks bigint, mae double, mape_pct double").json(path)


@query("table_of_given_forecast", "M28 J6", SQL_SERIES + """
    SELECT series, CAST(week AS VARCHAR) AS week, round_even(revenue, 2) AS actual_revenue, round_even(forecast, 2) AS forecast,
           round_even(lower, 2) AS lower, round_even(upper, 2) AS upper, week >= border AS is_holdout_forecast
    FROM series FULL JOIN guess USING (series, week), edge""", places=2)
def table_of_given_forecast(b):
    series = _series(b)
    return forecast.forecast_table(series, _given_forecast(series), forecast.holdout(series))


@query("last_week_cards", "A33", SQL_SERIES + """
    SELECT round(arg_max(revenue, week), 4) AS last_actual_revenue,
           (SELECT round(arg_max(forecast, week), 4) FROM guess) AS last_forecast FROM series""")
def last_week_cards(b):
    series = _series(b)
    table = series.withColumnRenamed("revenue", "actual_revenue").join(
        _given_forecast(series).select("series", "week", "forecast"), ["series", "week"], "full_outer"
    )
    return measures.last_known(table, "week", ["actual_revenue", "forecast"])


# A fitted series stands on every Monday from its first training week to the end, between its bounds.
SQL_FORECAST = """
    grid AS (SELECT CAST(unnest(generate_series(min(week), (SELECT max(week) FROM series), INTERVAL 7 DAY)) AS DATE) AS week
             FROM series, edge WHERE week < border)
    SELECT 'all' AS series, CAST(week AS VARCHAR) AS week, round_even(revenue, 2) AS actual_revenue,
           week >= border AS is_holdout_forecast, true AS bounded FROM grid LEFT JOIN series USING (week), edge"""


def _forecast(b, method, series):
    kept_back = forecast.holdout(series)
    train, test = forecast.split_holdout(series, kept_back)
    return test, freeze(forecast.forecast_series(train, kept_back, method, FESTIVALS)), kept_back


def _facts(series, predicted, kept_back):
    table = forecast.forecast_table(series, predicted, kept_back)
    bounded = F.coalesce((F.col("lower") <= F.col("forecast")) & (F.col("forecast") <= F.col("upper")), F.lit(False))
    return table.withColumn("bounded", bounded).drop("forecast", "lower", "upper")


@query("seasonal_forecast", "M25 M28", SQL_SERIES + "," + SQL_FORECAST, places=2)
def seasonal_forecast(b):
    series = _series(b)
    _, predicted, kept_back = _forecast(b, "seasonal", series)
    return _facts(series, predicted, kept_back)


@query("seasonal_forecast_table", "M25 M28")
def seasonal_forecast_table(b):
    """Actual, forecast and bounds of every week, and the form that was fitted."""
    series = _series(b)
    _, predicted, kept_back = _forecast(b, "seasonal", series)
    return forecast.forecast_table(series, predicted, kept_back).join(predicted.select("series", "week", "form"), ["series", "week"], "left")


@query("holt_winters_forecast", "M26 M28", SQL_SERIES + "," + SQL_FORECAST, places=2)
def holt_winters_forecast(b):
    series = _series(b)
    _, predicted, kept_back = _forecast(b, "holt_winters", series)
    return _facts(series, predicted, kept_back)


SQL_LOCATED = """
    located AS (SELECT location AS series, CAST(date_trunc('week', order_datetime) AS DATE) AS week,
                       CAST(sum(sales_amount) AS DOUBLE) AS revenue
                FROM m_orders JOIN m_restaurant USING (restaurant_id) WHERE currency = 'INR' GROUP BY 1, 2),
    series AS (SELECT * FROM located WHERE week + 6 <= (SELECT max(CAST(order_datetime AS DATE))
               FROM m_orders JOIN m_restaurant USING (restaurant_id) WHERE currency = 'INR')),
    edge AS (SELECT max(week) - 77 AS border, max(week) AS last FROM series)"""


@query("seasonal_forecast_by_seller_location", "M25 M26 M28", SQL_LOCATED + """,
    grid AS (SELECT series, CAST(unnest(generate_series(min(week), any_value(last), INTERVAL 7 DAY)) AS DATE) AS week, true AS fitted
             FROM series, edge WHERE week < border GROUP BY series)
    SELECT method, series, CAST(week AS VARCHAR) AS week, round_even(revenue, 2) AS actual_revenue,
           week >= border AS is_holdout_forecast, coalesce(fitted, false) AS bounded
    FROM series FULL JOIN grid USING (series, week), edge, (VALUES ('seasonal'), ('holt_winters')) v(method)""", places=2)
def seasonal_forecast_by_seller_location(b):
    """One series per location, each fitted on its own by both methods; a series too young to fit is kept."""
    columns = (*SERIES_FACT, "restaurant_id")
    orders = b.orders(*columns).where("restaurant_id is not null")
    located = orders.join(b.restaurant().select("restaurant_id", "location"), "restaurant_id")
    series = freeze(forecast.weekly_series(located, b.c, "location", drop_partial_last_week=True))
    out = None
    for method in ("seasonal", "holt_winters"):
        _, predicted, kept_back = _forecast(b, method, series)
        part = _facts(series, predicted, kept_back).withColumn("method", F.lit(method))
        out = part if out is None else out.unionByName(part)
    return out


@query("holdout_errors_by_method", "M25 M26 M27", SQL_SERIES + """
    SELECT method, series, count(*) AS weeks, true AS errors_are_known FROM series, edge,
           (VALUES ('seasonal'), ('holt_winters')) v(method) WHERE week >= border GROUP BY 1, 2""")
def holdout_errors_by_method(b):
    series, out = _series(b), None
    for method in ("seasonal", "holt_winters"):
        test, predicted, _ = _forecast(b, method, series)
        line = forecast.holdout_errors(test, predicted).withColumn("method", F.lit(method))
        out = line if out is None else out.unionByName(line)
    known = F.coalesce((F.col("mae") >= 0) & (F.col("mape") >= 0), F.lit(False))
    return out.select("method", "series", "weeks", known.alias("errors_are_known"))
