"""Dashboard measures, explorations and calendars."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerline.model import apply_slicers, base_currency_only, with_known
from ledgerline.operators import calendar, explore, joins, measures, rfm
from ledgerline.operators.cleaning import drop_incomplete, fill_defaults, null_rate
from ledgerline.operators.profiling import value_counts
from ledgerline.sources.files import query as sql_text
from ledgerline.workloads.binding import FESTIVALS
from ledgerline.workloads.registry import query

FESTIVAL_ROWS = ", ".join(f"('{n}', DATE '{d}')" for n, days in FESTIVALS.items() for d in days)


@query("order_value_by_tag", "A16 T1 J2 J1 Q19 R1", """
    SELECT tag, round(avg(CASE WHEN quantity % 10 <> 3 THEN sales_amount END), 2) AS aov, count(*) AS orders
    FROM m_orders JOIN m_tags USING (restaurant_id)
    WHERE currency = 'INR' AND tag IS NOT NULL GROUP BY tag ORDER BY aov DESC NULLS FIRST, tag LIMIT 12""")
def order_value_by_tag(b):
    """Some orders lack an amount, as junk in the files leaves them."""
    model = b.model("sales_amount", "currency", "restaurant_id", "quantity")
    amount = F.when(F.col("quantity") % 10 != 3, F.col("sales_amount"))
    return measures.order_value_by_tag(replace(model, orders=model.orders.withColumn("sales_amount", amount)))


@query("headline_kpis", "A1 A2 A3 A5 A12 R1 R2", """
    SELECT round(CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE), 4) AS total_revenue,
           count(*) AS total_orders, count(*) FILTER (WHERE currency = 'INR') AS base_orders,
           round(CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE)
                 / count(*) FILTER (WHERE currency = 'INR'), 4) AS avg_order_value,
           CAST(max(CAST(order_datetime AS DATE)) + 1 AS VARCHAR)[1:10] AS latest_data_date
    FROM m_orders""")
def headline_kpis(b):
    return measures.headline(b.orders("sales_amount", "currency", "order_datetime"), b.c)


@query("average_rating", "A4", "SELECT round(avg(CAST(rating AS DOUBLE)), 4) AS avg_rating FROM m_restaurant")
def average_rating(b):
    return measures.average_rating(b.restaurant(), b.c)


@query("currency_split", "A35 R1", """
    SELECT currency, count(*) AS orders, round(CAST(sum(sales_amount) AS DOUBLE), 4) AS amount,
           currency = 'INR' AS is_base FROM m_orders GROUP BY currency""")
def currency_split(b):
    return measures.currency_split(b.orders("sales_amount", "currency"), b.c)


@query("revenue_by_month", "A27", """
    SELECT CAST(CAST(date_trunc('month', order_datetime) AS DATE) AS VARCHAR) AS month,
           round(CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE), 4) AS revenue, count(*) AS orders
    FROM m_orders GROUP BY 1""")
def revenue_by_month(b):
    return measures.monthly_revenue(b.orders("sales_amount", "currency", "order_datetime"), b.c)


@query("rolling_30_day_revenue", "A7 W4", """
    daily AS (SELECT CAST(order_datetime AS DATE) AS day, sum(sales_amount) FILTER (WHERE currency = 'INR') AS revenue
              FROM m_orders GROUP BY 1),
    days AS (SELECT CAST(d AS DATE) AS day FROM
             (SELECT unnest(generate_series(date_trunc('year', min(day)),
                     date_trunc('year', max(day)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM daily) t),
    filled AS (SELECT day, coalesce(revenue, 0) AS revenue FROM days LEFT JOIN daily USING (day))
    SELECT CAST(day AS VARCHAR) AS day, round(CAST(revenue AS DOUBLE), 4) AS revenue,
           round(CAST(sum(revenue) OVER (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE), 4)
               AS rolling_revenue
    FROM filled""")
def rolling_30_day_revenue(b):
    return measures.rolling_revenue(b.orders("sales_amount", "currency", "order_datetime"), b.c)


@query("year_over_year_monthly", "A6 W5", """
    monthly AS (SELECT CAST(date_trunc('month', order_datetime) AS DATE) AS month,
                       CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE) AS revenue
                FROM m_orders GROUP BY 1)
    SELECT CAST(a.month AS VARCHAR) AS month, round(a.revenue, 4) AS revenue, round(p.revenue, 4) AS prior_revenue,
           round((a.revenue - p.revenue) / nullif(p.revenue, 0), 4) AS growth
    FROM monthly a LEFT JOIN monthly p ON a.month = p.month + INTERVAL 1 YEAR""")
def year_over_year_monthly(b):
    return measures.year_over_year(b.orders("sales_amount", "currency", "order_datetime"), b.c)


@query("year_over_year_daily", "A6 W5", """
    daily AS (SELECT CAST(order_datetime AS DATE) AS day,
                     CAST(coalesce(sum(sales_amount) FILTER (WHERE currency = 'INR'), 0) AS DOUBLE) AS revenue
              FROM m_orders GROUP BY 1)
    SELECT CAST(a.day AS VARCHAR) AS day, round(a.revenue, 4) AS revenue, round(p.revenue, 4) AS prior_revenue,
           round((a.revenue - p.revenue) / nullif(p.revenue, 0), 4) AS growth
    FROM daily a LEFT JOIN daily p
      ON a.day = CAST(p.day + INTERVAL 1 YEAR AS DATE) AND NOT (month(p.day) = 2 AND day(p.day) = 29)""")
def year_over_year_daily(b):
    return measures.year_over_year_daily(b.orders("sales_amount", "currency", "order_datetime"), b.c)


@query("repeat_customers", "A8 A9 A13 Q20", """
    per AS (SELECT user_id, count(*) AS n FROM m_orders WHERE user_id IS NOT NULL GROUP BY user_id)
    SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
           round(count(*) FILTER (WHERE n > 1) / CAST(count(*) AS DOUBLE), 6) AS repeat_rate,
           round(1 - count(*) FILTER (WHERE n > 1) / CAST(count(*) AS DOUBLE), 6) AS one_time_share FROM per""", places=6)
def repeat_customers(b):
    return measures.repeat_customers(b.orders("user_id"), b.c)


@query("repeat_customers_with_unknown", "A8", """
    per AS (SELECT user_id, count(*) AS n FROM m_orders GROUP BY user_id)
    SELECT count(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
           round(count(*) FILTER (WHERE n > 1) / CAST(count(*) AS DOUBLE), 6) AS repeat_rate,
           round(1 - count(*) FILTER (WHERE n > 1) / CAST(count(*) AS DOUBLE), 6) AS one_time_share FROM per""", places=6)
def repeat_customers_with_unknown(b):
    return measures.repeat_customers(b.orders("user_id"), b.c, include_null_group=True)


@query("revenue_by_location", "A26", """
    g AS (SELECT location, CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE) AS revenue
          FROM m_orders JOIN m_restaurant USING (restaurant_id) GROUP BY location)
    SELECT location, round(revenue, 6) AS revenue, round(revenue / sum(revenue) OVER (), 6) AS share FROM g""", places=6)
def revenue_by_location(b):
    return measures.revenue_by(b.model("sales_amount", "currency", "restaurant_id"), "location")


@query("revenue_by_cuisine", "A29", """
    g AS (SELECT cuisine, CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE) AS revenue
          FROM m_orders JOIN m_restaurant USING (restaurant_id) GROUP BY cuisine)
    SELECT cuisine, round(revenue, 6) AS revenue, round(revenue / sum(revenue) OVER (), 6) AS share FROM g""", places=6)
def revenue_by_cuisine(b):
    return measures.revenue_by(b.model("sales_amount", "currency", "restaurant_id"), "cuisine")


@query("location_table", "A30 J8 R3", """
    sold AS (SELECT restaurant_id, count(*) AS orders, sum(sales_amount) FILTER (WHERE currency = 'INR') AS revenue
             FROM m_orders WHERE restaurant_id IS NOT NULL GROUP BY 1)
    SELECT location, round(CAST(sum(revenue) AS DOUBLE), 4) AS revenue, CAST(coalesce(sum(orders), 0) AS BIGINT) AS orders,
           round(avg(CAST(rating AS DOUBLE)), 4) AS avg_rating
    FROM m_restaurant LEFT JOIN sold USING (restaurant_id) GROUP BY location""")
def location_table(b):
    return measures.seller_rollup(b.model("sales_amount", "currency", "restaurant_id"), "location")


@query("top_cuisine", "A11 T6", """
    g AS (SELECT cuisine, sum(sales_amount) FILTER (WHERE currency = 'INR') AS revenue
          FROM m_orders JOIN m_restaurant USING (restaurant_id) WHERE cuisine IS NOT NULL GROUP BY cuisine)
    SELECT string_agg(cuisine, ', ' ORDER BY cuisine) AS top_group, round(CAST(max(revenue) AS DOUBLE), 4) AS revenue
    FROM g WHERE revenue = (SELECT max(revenue) FROM g)""")
def top_cuisine(b):
    return measures.top_by_revenue_with_ties(b.model("sales_amount", "currency", "restaurant_id"), "cuisine")


@query("top_restaurants", "T4", """
    SELECT name, round(CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE), 4) AS revenue, count(*) AS orders
    FROM m_orders JOIN m_restaurant USING (restaurant_id) GROUP BY name ORDER BY revenue DESC, name LIMIT 20""")
def top_restaurants(b):
    return measures.top_sellers(b.model("sales_amount", "currency", "restaurant_id"))


@query("restaurant_scatter", "A28 Q21", """
    SELECT restaurant_id, name, round(CAST(least(cost_for_two, 950) AS DOUBLE), 4) AS cost,
           round(CAST(rating AS DOUBLE), 4) AS rating, CAST(num_ratings AS BIGINT) AS num_ratings
    FROM m_restaurant WHERE rating IS NOT NULL AND cost_for_two IS NOT NULL""")
def restaurant_scatter(b):
    return measures.seller_scatter(b.restaurant(), b.c, cost_limit=950)


@query("menu_price_by_cuisine", "A32", """
    SELECT cuisine, round(avg(CAST(price AS DOUBLE)), 4) AS avg_price, count(price) AS items,
           round(quantile_cont(CAST(price AS DOUBLE), 0.5), 4) AS median_price FROM m_menu GROUP BY cuisine""")
def menu_price_by_cuisine(b):
    return measures.price_by_group(b.menu(), "cuisine", b.c)


@query("location_profile", "A15 A14", """
    g AS (SELECT location, CAST(sum(cost_for_two) AS DOUBLE) / count(cost_for_two) AS avg_cost,
                 CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating, count(DISTINCT restaurant_id) AS sellers
          FROM m_orders JOIN m_restaurant USING (restaurant_id)
          WHERE currency = 'INR' AND location IS NOT NULL AND rating IS NOT NULL AND cost_for_two IS NOT NULL GROUP BY location HAVING count(DISTINCT restaurant_id) >= 20)
    SELECT location, round(avg_cost, 4) AS avg_cost, round(avg_rating, 4) AS avg_rating, sellers,
           round(sellers / CAST(max(sellers) OVER () AS DOUBLE), 4) AS bubble FROM g""")
def location_profile(b):
    return explore.location_profile(b.model("currency", "restaurant_id"))


@query("largest_locations", "T2", """
    g AS (SELECT location, CAST(sum(cost_for_two) AS DOUBLE) / count(cost_for_two) AS avg_cost,
                 CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating, count(DISTINCT restaurant_id) AS sellers
          FROM m_orders JOIN m_restaurant USING (restaurant_id)
          WHERE currency = 'INR' AND location IS NOT NULL AND rating IS NOT NULL AND cost_for_two IS NOT NULL GROUP BY location HAVING count(DISTINCT restaurant_id) >= 20)
    SELECT location, round(avg_cost, 4) AS avg_cost, round(avg_rating, 4) AS avg_rating, sellers,
           round(sellers / CAST((SELECT max(sellers) FROM g) AS DOUBLE), 4) AS bubble
    FROM g ORDER BY sellers DESC, location LIMIT 6""")
def largest_locations(b):
    return explore.top_locations(explore.location_profile(b.model("currency", "restaurant_id")), b.c)


@query("users_per_location", "A14", """
    SELECT location, count(DISTINCT user_id) AS users
    FROM m_orders JOIN m_restaurant USING (restaurant_id) GROUP BY location""")
def users_per_location(b):
    pairs = b.orders("user_id", "restaurant_id").distinct()
    joined = joins.enrich_orders(pairs, b.restaurant(), b.c, "location")
    return explore.count_distinct_by(joined, ["location"], "user_id", "users")


@query("orders_per_day", "A18 W7", """
    daily AS (SELECT CAST(order_datetime AS DATE) AS day, count(*) AS n FROM m_orders
              WHERE currency = 'INR' AND restaurant_id IS NOT NULL GROUP BY 1),
    days AS (SELECT CAST(d AS DATE) AS day FROM
             (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS d FROM daily) t)
    SELECT CAST(day AS VARCHAR) AS day, coalesce(n, 0) AS orders FROM days LEFT JOIN daily USING (day)""")
def orders_per_day(b):
    orders = with_known(base_currency_only(b.orders("order_datetime", "currency", "restaurant_id"), b.c), "restaurant_id")
    return calendar.orders_per_day(orders, b.c)


@query("order_value_distribution", "A22", """
    SELECT round(avg(CAST(sales_amount AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST(sales_amount AS DOUBLE)), 4) AS std,
           round(quantile_cont(CAST(sales_amount AS DOUBLE), 0.5), 4) AS median FROM m_orders WHERE currency = 'INR'""")
def order_value_distribution(b):
    return explore.distribution(base_currency_only(b.orders("sales_amount", "currency"), b.c), "sales_amount")


HISTOGRAM = """
    v AS (SELECT {value} AS value FROM m_orders JOIN m_restaurant USING (restaurant_id)
          WHERE currency = 'INR' AND {column} IS NOT NULL),
    s AS (SELECT min(value) AS low, max(value) AS high FROM v),
    c AS (SELECT least(CAST(floor((value - low) * {bins} / (high - low)) AS INTEGER), {bins} - 1) AS bin, count(*) AS n
          FROM v, s GROUP BY 1),
    grid AS (SELECT CAST(unnest(generate_series(0, {bins} - 1)) AS INTEGER) AS bin)
    SELECT CAST(bin AS BIGINT) AS bin, round(low + bin * (high - low) / {bins}, 4) AS low,
           round(low + (bin + 1) * (high - low) / {bins}, 4) AS high, coalesce(n, 0) AS n
    FROM grid LEFT JOIN c USING (bin), s"""


@query("rating_histogram", "A20",
       HISTOGRAM.format(value="CAST(rating AS DOUBLE)", column="rating", bins=20))
def rating_histogram(b):
    orders = base_currency_only(b.orders("currency", "restaurant_id"), b.c)
    sellers = measures.sellers_by_orders(orders, b.restaurant(), b.c, "rating")
    return explore.histogram(sellers, "rating", 20, weight="n")


@query("cost_histogram_clipped", "A20", HISTOGRAM.format(
    value="CAST(least(greatest(cost_for_two, 0), 980) AS DOUBLE)", column="cost_for_two", bins=40))
def cost_histogram_clipped(b):
    orders = base_currency_only(b.orders("currency", "restaurant_id"), b.c)
    sellers = measures.sellers_by_orders(orders, b.restaurant(), b.c, "cost_for_two")
    return explore.histogram(sellers, "cost_for_two", 40, clip=(0, 980), weight="n")


def _correlation_sql() -> str:
    names = ("quantity", "sales_amount", "rating", "cost_for_two")
    cells = [
        f"SELECT '{x}' AS x, '{y}' AS y, "
        + ("CAST(1 AS DOUBLE)" if x == y else f"round(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6)")
        + " AS r FROM j"
        for x in names
        for y in names
    ]
    join = "j AS (SELECT * FROM m_orders JOIN m_restaurant USING (restaurant_id) WHERE currency = 'INR')"
    return f"{join}, cells AS ({' UNION ALL '.join(cells)}) SELECT DISTINCT x, y, r FROM cells"


@query("correlation_matrix", "A21", _correlation_sql(), places=6)
def correlation_matrix(b):
    orders = base_currency_only(b.orders("currency", "restaurant_id", "quantity", "sales_amount"), b.c)
    joined = joins.enrich_orders(orders, b.restaurant(), b.c, "rating", "cost_for_two")
    return explore.correlations(joined, ("quantity", "sales_amount", "rating", "cost_for_two"))


@query("rating_null_rate", "Q23 J1", """
    SELECT count(*) FILTER (WHERE rating IS NULL) AS null_rows,
           round(100.0 * count(*) FILTER (WHERE rating IS NULL) / count(*), 4) AS null_pct
    FROM m_orders JOIN m_restaurant USING (restaurant_id) WHERE currency = 'INR'""")
def rating_null_rate(b):
    orders = base_currency_only(b.orders("currency", "restaurant_id"), b.c)
    return null_rate(measures.sellers_by_orders(orders, b.restaurant(), b.c, "rating"), "rating", weight="n")


@query("orders_by_location_with_unknown", "J8 R3", """
    SELECT location, count(*) AS orders, round(CAST(sum(sales_amount) AS DOUBLE), 4) AS amount
    FROM m_orders LEFT JOIN m_restaurant USING (restaurant_id) GROUP BY location""")
def orders_by_location_with_unknown(b):
    view = joins.keep_unmatched_orders(b.orders("sales_amount", "restaurant_id"), b.restaurant(), b.c, "location")
    return view.groupBy("location").agg(F.count(F.lit(1)).alias("orders"), F.sum("sales_amount").alias("amount"))


@query("order_age", "J7 R2", """
    SELECT date_diff('day', CAST(order_datetime AS DATE), (SELECT max(CAST(order_datetime AS DATE)) + 1 FROM m_orders))
           AS days_ago, count(*) AS orders FROM m_orders GROUP BY 1""")
def order_age(b):
    aged = joins.days_before_reference(b.orders("order_datetime"), b.c)
    return aged.groupBy("days_ago").agg(F.count(F.lit(1)).alias("orders"))


@query("orders_with_known_sellers", "J4", """
    SELECT currency, count(*) AS orders FROM m_orders
    WHERE restaurant_id IN (SELECT restaurant_id FROM m_restaurant WHERE rating IS NOT NULL) GROUP BY currency""")
def orders_with_known_sellers(b):
    rated = drop_incomplete(b.restaurant(), ["rating"])
    kept = joins.rows_with_parent(b.orders("currency", "restaurant_id"), "restaurant_id", rated, "restaurant_id")
    return kept.groupBy("currency").agg(F.count(F.lit(1)).alias("orders"))


@query("orders_without_known_sellers", "J3", """
    SELECT restaurant_id, count(*) AS orders FROM m_orders WHERE restaurant_id IS NOT NULL
      AND restaurant_id NOT IN (SELECT restaurant_id FROM m_restaurant WHERE rating IS NOT NULL) GROUP BY 1""")
def orders_without_known_sellers(b):
    rated = drop_incomplete(b.restaurant(), ["rating"])
    left = joins.rows_without_parent(b.orders("restaurant_id"), "restaurant_id", rated, "restaurant_id")
    return left.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("orders"))


@query("user_money_with_defaults", "J5 Q22 A12", """
    SELECT u.user_id, occupation, round(CAST(coalesce(m, 0) AS DOUBLE), 4) AS money, coalesce(n, 0) AS orders
    FROM m_users u LEFT JOIN (SELECT user_id, count(*) AS n, sum(sales_amount) FILTER (WHERE currency = 'INR') AS m
                              FROM m_orders WHERE user_id IS NOT NULL GROUP BY 1) o USING (user_id)""")
def user_money_with_defaults(b):
    orders = b.orders("user_id", "sales_amount", "currency")
    per_user = orders.where("user_id is not null").groupBy("user_id").agg(
        measures.total_revenue(b.c).cast("double").alias("money"), measures.total_orders().alias("orders")
    )
    users = b.users().select("user_id", "occupation")
    return joins.attach_features(users, per_user, "user_id", {"money": 0, "orders": 0})


@query("users_per_occupation", "P9", """
    SELECT occupation, count(*) AS n FROM m_users GROUP BY occupation""")
def users_per_occupation(b):
    return value_counts(b.users(), "occupation")


@query("filled_ratings", "Q22", """
    SELECT restaurant_id, round(coalesce(CAST(rating AS DOUBLE), 0), 4) AS rating, coalesce(cuisine, 'Unknown') AS cuisine
    FROM m_restaurant""")
def filled_ratings(b):
    typed = b.restaurant().select("restaurant_id", F.col("rating").cast("double").alias("rating"), "cuisine")
    return fill_defaults(typed, {"rating": 0.0, "cuisine": "Unknown"})


SLICED = """
    kept AS (SELECT * FROM m_restaurant WHERE location IN ('Brand#3', 'Brand#7', 'Brand#11')),
    o AS (SELECT * FROM m_orders WHERE restaurant_id IN (SELECT restaurant_id FROM kept)
          AND order_datetime >= TIMESTAMP '1996-02-01' AND order_datetime < TIMESTAMP '1999-07-01')"""


def _sliced(b, *columns):
    return apply_slicers(
        b.model(*columns), location=("Brand#3", "Brand#7", "Brand#11"), date_from="1996-02-01", date_to="1999-06-30"
    )


@query("sliced_headline", "A34", SLICED + """
    SELECT round(CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE), 4) AS total_revenue,
           count(*) AS total_orders, count(*) FILTER (WHERE currency = 'INR') AS base_orders,
           round(CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE)
                 / count(*) FILTER (WHERE currency = 'INR'), 4) AS avg_order_value,
           CAST(max(CAST(order_datetime AS DATE)) + 1 AS VARCHAR)[1:10] AS latest_data_date FROM o""")
def sliced_headline(b):
    view = _sliced(b, "sales_amount", "currency", "order_datetime", "restaurant_id")
    return measures.headline(view.orders, view.c)


@query("sliced_top_restaurants", "A34 T4", SLICED + """
    SELECT name, round(CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE), 4) AS revenue, count(*) AS orders
    FROM o JOIN kept USING (restaurant_id) GROUP BY name ORDER BY revenue DESC, name LIMIT 20""")
def sliced_top_restaurants(b):
    return measures.top_sellers(_sliced(b, "sales_amount", "currency", "order_datetime", "restaurant_id"))


@query("sliced_menu_by_cuisine", "A34", """
    SELECT m.cuisine, count(*) AS items FROM m_menu m JOIN m_restaurant r USING (restaurant_id)
    WHERE r.cuisine IN ('PROMO, ring', 'SMALL, rod') GROUP BY 1""")
def sliced_menu_by_cuisine(b):
    view = apply_slicers(b.model("restaurant_id"), tags=("PROMO, ring", "SMALL, rod"))
    return view.menu.groupBy("cuisine").agg(F.count(F.lit(1)).alias("items"))


@query("date_table", "M30", """
    s AS (SELECT date_trunc('year', min(order_datetime)) AS first,
                 date_trunc('year', max(order_datetime)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS last FROM m_orders),
    d AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM s)
    SELECT CAST(date AS VARCHAR) AS date, year(date) AS year, quarter(date) AS quarter, month(date) AS month,
           day(date) AS day_of_month, CAST(CAST(date_trunc('week', date) AS DATE) AS VARCHAR) AS week FROM d""")
def date_table(b):
    return calendar.date_dimension(b.raw("orders"), "o_orderdate")


@query("weekly_revenue", "A19", """
    SELECT CAST(week AS VARCHAR) AS week, round(revenue, 4) AS revenue FROM m_weekly""")
def weekly_revenue(b):
    return calendar.weekly_revenue(b.orders("sales_amount", "currency", "order_datetime"), b.c)


@query("weekly_extent", "A36", """
    SELECT count(*) AS weeks, CAST(min(week) AS VARCHAR) AS first_week, CAST(max(week) AS VARCHAR) AS last_week
    FROM m_weekly""")
def weekly_extent(b):
    return calendar.series_extent(calendar.weekly_revenue(b.orders("sales_amount", "currency", "order_datetime"), b.c))


@query("weekly_grid_of_busy_weeks", "W7", """
    busy AS (SELECT week, CASE WHEN revenue > (SELECT avg(revenue) FROM m_weekly) THEN revenue END AS revenue FROM m_weekly),
    grid AS (SELECT CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM busy)
    SELECT CAST(week AS VARCHAR) AS week, round(revenue, 4) AS revenue FROM grid LEFT JOIN busy USING (week)""")
def weekly_grid_of_busy_weeks(b):
    weekly = calendar.weekly_revenue(b.orders("sales_amount", "currency", "order_datetime"), b.c)
    mean = weekly.agg(F.avg("revenue").alias("m")).scalar()
    busy = weekly.withColumn("revenue", F.when(F.col("revenue") > mean, F.col("revenue")))
    return calendar.fill_gaps(busy, "week", 7)


@query("festival_windows", "M24 U1", f"""
    f(festival, date) AS (VALUES {FESTIVAL_ROWS})
    SELECT festival, CAST(date AS VARCHAR) AS date, CAST(date - 1 AS VARCHAR) AS window_start,
           CAST(date + 1 AS VARCHAR) AS window_end
    FROM f WHERE date <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)""")
def festival_windows(b):
    last = b.raw("orders").agg(F.to_date(F.max("o_orderdate")).alias("last")).scalar()
    return calendar.festival_calendar(b.spark, FESTIVALS).where(F.col("date") <= last)


@query("festival_week_revenue", "J9 M24", f"""
    f(festival, date) AS (VALUES {FESTIVAL_ROWS}),
    t AS (SELECT DISTINCT festival, date, CAST(date_trunc('week', date + shift) AS DATE) AS week
          FROM f, (VALUES (-1), (0), (1)) s(shift))
    SELECT festival, CAST(date AS VARCHAR) AS date, CAST(week AS VARCHAR) AS week, round(revenue, 4) AS revenue
    FROM t JOIN m_weekly USING (week)""")
def festival_week_revenue(b):
    weekly = calendar.weekly_revenue(b.orders("sales_amount", "currency", "order_datetime"), b.c)
    festivals = calendar.festival_calendar(b.spark, FESTIVALS).select("festival", "date")
    return joins.weeks_touched(festivals, "date").join(weekly, "week")


@query("festivals_in_range", "M29", f"""
    f(festival, date) AS (VALUES {FESTIVAL_ROWS})
    SELECT festival, CAST(date AS VARCHAR) AS date FROM f
    WHERE date >= (SELECT min(week) FROM m_weekly) AND date <= (SELECT max(week) + 84 FROM m_weekly)""")
def festivals_in_range(b):
    weekly = calendar.weekly_revenue(b.orders("sales_amount", "currency", "order_datetime"), b.c)
    return calendar.festivals_in_range(calendar.festival_calendar(b.spark, FESTIVALS), weekly)


@query("sql_text", "S4 S11", """
    SELECT location, count(*) AS orders, CAST(max(quantity) AS BIGINT) AS largest FROM m_orders JOIN m_restaurant USING (restaurant_id)
    GROUP BY location""")
def sql_text_query(b):
    text = """SELECT r.location, count(*) AS orders, max(o.quantity) AS largest
              FROM {orders} o JOIN {restaurant} r ON r.restaurant_id = o.restaurant_id
              GROUP BY r.location"""
    return sql_text(b.spark, text, orders=b.orders("quantity", "restaurant_id"), restaurant=b.restaurant())


@query("rfm_base", "M6 A12 A13", """
    SELECT user_id, recency_days, frequency, round(CAST(monetary AS DOUBLE), 4) AS monetary FROM m_rfm""")
def rfm_base(b):
    return rfm.rfm_base(b.orders("user_id", "order_datetime", "sales_amount", "currency"), b.c)
