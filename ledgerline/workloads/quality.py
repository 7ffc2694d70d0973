"""Cleaning, integrity and profiling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.operators import cleaning, integrity, profiling, ranking
from ledgerline.plans import ingest
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources import sinks, versions
from ledgerline.sources.contracts import CONTRACTS, ForeignKey, TableContract
from ledgerline.sources.files import normalise_headers, read_csv_inferred, read_csv_robust, resolve_columns
from ledgerline.workloads.registry import query

MENU_TO_RESTAURANT = ForeignKey("restaurant_id", "restaurant", "restaurant_id")
MENU_TO_FOOD = ForeignKey("food_id", "food", "food_id")

# The reading rules of dirty integers and numbers, in SQL.
SQL_INTEGERS = r"""
    t AS (SELECT *, replace(regexp_replace(quantity, '^\s+|\s+$', '', 'g'), ',', '') AS x FROM m_dirty),
    u AS (SELECT *, CASE WHEN regexp_matches(x, '^[+-]?[0-9]+(\.[0-9]*)?$') THEN CAST(x AS DOUBLE) END AS plain,
                 try_cast(nullif(regexp_extract(x, '(?i)^[a-z_\-]*([0-9]+(?:\.[0-9]+)?)$', 1), '') AS DOUBLE) AS code,
                 try_cast(nullif(regexp_extract(x, '(?i)^([0-9]+(?:\.[0-9]+)?)\s*(k)?\+', 1), '') AS DOUBLE)
                   * CASE WHEN regexp_matches(x, '(?i)^[0-9.]+\s*k\+') THEN 1000 ELSE 1 END AS band FROM t),
    v AS (SELECT *, coalesce(plain, code, band) AS number FROM u),
    w AS (SELECT *, CASE WHEN number = floor(number) THEN CAST(number AS BIGINT) END AS value,
                 CASE WHEN number IS NULL THEN 'lost' WHEN number <> floor(number) THEN 'nonint'
                      WHEN plain IS NOT NULL THEN 'plain' WHEN code IS NOT NULL THEN 'prefix' ELSE 'band' END AS how FROM v)"""
SQL_NUMBERS = r"""
    p AS (SELECT *, try_cast(nullif(regexp_replace(price, '[^0-9.\-]', '', 'g'), '') AS DECIMAL(12,2)) AS value FROM m_dirty)"""
SQL_DATES = """
    d AS (SELECT *, coalesce(try_strptime(shipped, '%Y-%m-%d'), try_strptime(shipped, '%d/%m/%Y')) AS day_first,
                 coalesce(try_strptime(shipped, '%Y-%m-%d'), try_strptime(shipped, '%m/%d/%Y')) AS month_first FROM m_dirty)"""


@query("mapped_headers", "Q1 Q2", """
    SELECT p_partkey AS restaurant_id, p_name AS name, p_brand AS location, CAST(p_size AS VARCHAR) AS rating,
           p_size AS num_ratings, CAST(p_retailprice AS VARCHAR) AS cost_for_two, p_type AS cuisine,
           p_partkey AS license_number, p_name AS website_link, p_brand AS address FROM part""")
def mapped_headers(b):
    untidy = b.raw("part").select(
        F.col("p_partkey").alias(" R ID "),
        F.col("p_name").alias("Restaurant-Name"),
        F.col("p_brand").alias("CITY"),
        F.col("p_size").cast("string").alias("Rate"),
        F.col("p_size").alias("votes "),
        F.col("p_retailprice").cast("string").alias(" Approx Cost (for two) "),
        F.col("p_type").alias("Cuisines"),
        F.col("p_partkey").alias("Lic No"),
        F.col("p_name").alias("URL"),
        F.col("p_brand").alias("address"),
        F.col("p_size").alias("not wanted"),
    )
    return resolve_columns(normalise_headers(untidy), "restaurant", CONTRACTS["restaurant"])


@query("cleaned_text", "Q3", r"""
    SELECT currency, count(*) AS n FROM
      (SELECT CASE WHEN t NOT IN ('', 'nan', 'None') THEN t END AS currency FROM
        (SELECT regexp_replace(currency, '^\s+|\s+$', '', 'g') AS t FROM m_dirty) a) b GROUP BY 1""")
def cleaned_text(b):
    cleaned = cleaning.clean_strings(b.dirty(), ["currency"])
    return cleaned.groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


@query("parsed_integers", "Q4", SQL_INTEGERS + """
    SELECT quantity AS raw, value, how, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def parsed_integers(b):
    cells = b.dirty().select(F.col("quantity").alias("raw"), F.col("quantity").alias("value"))
    parsed = cleaning.parse_integers(cells, ["value"], readings=True)
    return parsed.groupBy("raw", "value", F.col("value_reading").alias("how")).agg(F.count(F.lit(1)).alias("n"))


@query("integer_reading_stats", "Q4 Q8", SQL_INTEGERS + """
    SELECT 'quantity' AS "column", count(*) FILTER (WHERE how = 'plain') AS plain,
           count(*) FILTER (WHERE how = 'prefix') AS prefix, count(*) FILTER (WHERE how = 'band') AS band,
           count(*) FILTER (WHERE how = 'nonint') AS nonint, count(*) FILTER (WHERE value IS NULL) AS lost FROM w""")
def integer_reading_stats(b):
    return cleaning.integer_stats(b.dirty(), ["quantity"])


@query("parsed_numbers", "Q5 Q6", SQL_NUMBERS + """
    SELECT l_orderkey, round(CAST(sum(value) AS DOUBLE), 4) AS amount, count(value) AS parsed,
           count(*) FILTER (WHERE value < 0) AS negative FROM p GROUP BY l_orderkey""")
def parsed_numbers(b):
    cells = b.dirty().select("l_orderkey", F.col("price").alias("value"))
    parsed = cleaning.parse_numbers(cells, ["value"], "decimal(12,2)")
    return parsed.groupBy("l_orderkey").agg(
        F.sum("value").alias("amount"), F.count("value").alias("parsed"), F.count_if(F.col("value") < 0).alias("negative")
    )


@query("parsed_dates", "Q7", SQL_DATES + """,
    best AS (SELECT count(day_first) > count(month_first) AS day_first_wins FROM d)
    SELECT CAST(CASE WHEN day_first_wins THEN day_first ELSE month_first END AS VARCHAR) AS shipped, count(*) AS n
    FROM d, best GROUP BY 1""")
def parsed_dates(b):
    parsed = cleaning.parse_timestamps(b.dirty().select("shipped"), ["shipped"])
    return parsed.groupBy("shipped").agg(F.count(F.lit(1)).alias("n"))


DIRTY_CONTRACT = TableContract(
    headers={
        "l_orderkey": ("l_orderkey",), "l_linenumber": ("l_linenumber",), "quantity": ("quantity",),
        "price": ("price",), "shipped": ("shipped",), "currency": ("currency",),
    },
    types={
        "l_orderkey": "bigint", "l_linenumber": "int", "quantity": "int", "price": "decimal(12,2)",
        "shipped": "timestamp_ntz", "currency": "varchar(10)",
    },
    integers=("l_orderkey", "l_linenumber", "quantity"),
    numbers=("price",),
    timestamps=("shipped",),
)


@query("coercion_counts", "Q6 Q8 Q13", SQL_INTEGERS + "," + SQL_NUMBERS + "," + SQL_DATES + """,
    n AS (SELECT count(*) AS rows FROM m_dirty)
    SELECT 'l_orderkey' AS "column", rows, 0 AS coerced, 0 AS negative FROM n
    UNION ALL SELECT 'l_linenumber', rows, 0, 0 FROM n
    UNION ALL SELECT 'quantity', rows, (SELECT count(*) FROM w WHERE value IS NULL), 0 FROM n
    UNION ALL SELECT 'price', rows, (SELECT count(*) FROM p WHERE value IS NULL),
                     (SELECT count(*) FROM p WHERE value < 0) FROM n
    UNION ALL SELECT 'shipped', rows,
                     (SELECT count(*) - greatest(count(day_first), count(month_first)) FROM d), 0 FROM n
    UNION ALL SELECT 'currency', rows, 0, 0 FROM n""")
def coercion_counts(b):
    text = b.dirty().select(*[F.col(c).cast("string").alias(c) for c in DIRTY_CONTRACT.headers])
    return cleaning.clean_types(text, DIRTY_CONTRACT)[1]


@query("menu_first_listing", "Q9 Q10", """
    SELECT restaurant_id, food_id, cuisine, round(CAST(price AS DOUBLE), 4) AS price, listed_in,
           CAST(listed_at AS BIGINT) AS listed_at
    FROM (SELECT *, row_number() OVER (PARTITION BY restaurant_id, food_id
                                       ORDER BY listed_in, listed_at, price, cuisine) AS rn FROM m_menu) t WHERE rn = 1""")
def menu_first_listing(b):
    return cleaning.keep_first(b.menu(), ("restaurant_id", "food_id"), ["listed_in", "listed_at", "price", "cuisine"])


@query("user_first_order", "Q9 Q10", """
    SELECT user_id, CAST(min(order_datetime) AS VARCHAR) AS order_datetime FROM m_orders WHERE user_id IS NOT NULL GROUP BY 1""")
def user_first_order(b):
    return cleaning.keep_first(b.orders("user_id", "order_datetime"), ("user_id",), ["order_datetime"])


# Every parent row is read; some child keys are moved out of range to make orphans.
STRAY = """
    s AS (SELECT CASE WHEN listed_in % 10 = 0 THEN restaurant_id + 1000000000000 ELSE restaurant_id END AS restaurant_id,
                 CASE WHEN listed_in % 10 IN (0, 1) THEN food_id + 1000000000000 ELSE food_id END AS food_id,
                 cuisine, price, listed_in, listed_at FROM m_menu)"""
ORPHANED = STRAY + """,
    m AS (SELECT *, CASE WHEN restaurant_id NOT IN (SELECT restaurant_id FROM m_restaurant) THEN 'restaurant_id'
                         WHEN food_id NOT IN (SELECT food_id FROM m_food) THEN 'food_id' END AS reject_reason FROM s)"""


def _stray_menu(b):
    """Listings of which some point to a restaurant or a food that is not there."""
    moved = F.lit(1_000_000_000_000)
    return b.menu().withColumns(
        {
            "restaurant_id": F.col("restaurant_id") + F.when(F.col("listed_in") % 10 == 0, moved).otherwise(0),
            "food_id": F.col("food_id") + F.when((F.col("listed_in") % 10).isin(0, 1), moved).otherwise(0),
        }
    )


def _parents(b):
    return {"restaurant": b.restaurant(), "food": b.food()}


@query("quarantined_menu", "Q11 S7", ORPHANED + """
    SELECT reject_reason, restaurant_id, food_id, count(*) AS n FROM m WHERE reject_reason IS NOT NULL GROUP BY 1, 2, 3""")
def quarantined_menu(b):
    marked = integrity.mark_orphans(_stray_menu(b), [MENU_TO_RESTAURANT, MENU_TO_FOOD], _parents(b))
    rejected = integrity.split_orphans(marked)[1]
    return rejected.groupBy("reject_reason", "restaurant_id", "food_id").agg(F.count(F.lit(1)).alias("n"))


@query("kept_menu", "Q11", ORPHANED + """
    SELECT cuisine, count(*) AS n, round(CAST(sum(price) AS DOUBLE), 4) AS price FROM m WHERE reject_reason IS NULL GROUP BY 1""")
def kept_menu(b):
    marked = integrity.mark_orphans(_stray_menu(b), [MENU_TO_RESTAURANT, MENU_TO_FOOD], _parents(b))
    kept = integrity.split_orphans(marked)[0]
    return kept.groupBy("cuisine").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query("orphan_counts", "Q15 J3", STRAY + """
    SELECT 'menu' AS child, 'restaurant_id' AS fk_column, count(*) AS orphans FROM s
    WHERE restaurant_id NOT IN (SELECT restaurant_id FROM m_restaurant)
    UNION ALL
    SELECT 'menu', 'food_id', count(*) FROM s WHERE food_id NOT IN (SELECT food_id FROM m_food)
    UNION ALL
    SELECT 'orders', 'restaurant_id', count(*) FROM m_orders WHERE restaurant_id IS NOT NULL
      AND restaurant_id NOT IN (SELECT restaurant_id FROM m_restaurant)
    UNION ALL
    SELECT 'orders', 'user_id', count(*) FROM m_orders WHERE user_id IS NOT NULL
      AND user_id NOT IN (SELECT user_id FROM m_users)""")
def orphan_counts(b):
    tables = {"menu": _stray_menu(b), "orders": b.orders("user_id", "restaurant_id"), "users": b.users(), **_parents(b)}
    return integrity.orphan_counts(
        tables,
        [
            ("menu", MENU_TO_RESTAURANT),
            ("menu", MENU_TO_FOOD),
            ("orders", MENU_TO_RESTAURANT),
            ("orders", ForeignKey("user_id", "users", "user_id")),
        ],
    )


@query("missing_keys", "Q12 Q20 R3", """
    SELECT 'user_id' AS fk_column, count(*) - count(user_id) AS null_rows FROM m_orders
    UNION ALL SELECT 'restaurant_id', count(*) - count(restaurant_id) FROM m_orders""")
def missing_keys(b):
    return integrity.null_key_counts(b.orders("user_id", "restaurant_id"), ["user_id", "restaurant_id"])


@query("never_listed", "Q17 J10", """
    SELECT count(*) AS total_items, count(*) FILTER (WHERE food_id NOT IN
        (SELECT CASE WHEN food_id % 7 = 3 THEN -food_id ELSE food_id END FROM m_menu)) AS never_listed
    FROM m_food""")
def never_listed(b):
    """Listings of every seventh food point elsewhere."""
    listed = F.when(F.col("food_id") % 7 == 3, -F.col("food_id")).otherwise(F.col("food_id"))
    return integrity.never_listed(b.food(), b.menu().select(listed.alias("food_id")), "food_id")


@query("never_ordered_with_unknown", "Q17 J10", """
    SELECT count(*) AS total_items, count(*) FILTER (WHERE restaurant_id NOT IN (SELECT restaurant_id FROM m_orders))
           AS never_listed FROM m_restaurant""")
def never_ordered_with_unknown(b):
    return integrity.never_listed(b.restaurant(), b.orders("restaurant_id"), "restaurant_id")


MENU_CONTRACT = TableContract(
    headers={},
    types={"restaurant_id": "int", "food_id": "int", "cuisine": "varchar(1)", "price": "decimal(6,2)"},
    key=("restaurant_id", "food_id"),
    foreign_keys=(MENU_TO_RESTAURANT, MENU_TO_FOOD),
)


@query("constraint_violations", "Q16", STRAY + """
    SELECT 'menu' AS "table", 'not null restaurant_id' AS rule, count(*) - count(restaurant_id) AS violations FROM s
    UNION ALL SELECT 'menu', 'range restaurant_id int', count(*) FROM s WHERE restaurant_id > 2147483647
    UNION ALL SELECT 'menu', 'not null food_id', count(*) - count(food_id) FROM s
    UNION ALL SELECT 'menu', 'range food_id int', count(*) FROM s WHERE food_id > 2147483647
    UNION ALL SELECT 'menu', 'length cuisine <= 1', count(*) FROM s WHERE length(cuisine) > 1
    UNION ALL SELECT 'menu', 'range price decimal(6,2)', count(*) FROM s WHERE abs(price) >= 10000
    UNION ALL SELECT 'menu', 'unique restaurant_id, food_id', count(*) - count(DISTINCT (restaurant_id, food_id)) FROM s
    UNION ALL SELECT 'menu', 'references restaurant_id -> restaurant', count(*) FROM s
              WHERE restaurant_id NOT IN (SELECT restaurant_id FROM m_restaurant)
    UNION ALL SELECT 'menu', 'references food_id -> food', count(*) FROM s
              WHERE food_id NOT IN (SELECT food_id FROM m_food)""")
def constraint_violations(b):
    return integrity.constraint_violations("menu", _stray_menu(b), MENU_CONTRACT, _parents(b))


@query("reconciled_counts", "Q14", """
    SELECT 'orders' AS "table", count(*) AS expected, count(*) AS stored, true AS ok FROM m_orders
    UNION ALL SELECT 'restaurant', count(*) - 1, count(*), false FROM m_restaurant""")
def reconciled_counts(b):
    orders, restaurant = b.orders("currency"), b.restaurant()
    expected = {"orders": orders.count(), "restaurant": restaurant.count() - 1}
    return integrity.reconcile_counts(expected, {"orders": orders, "restaurant": restaurant})


@query("surrogate_keys", "Q18 W2", """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id, o_orderkey FROM orders""")
def surrogate_keys(b):
    source = b.raw("orders").select("o_orderdate", "o_orderkey")
    return cleaning.add_surrogate_key(source, "row_id", ["o_orderdate", "o_orderkey"], dense=True).drop("o_orderdate")


@query("unique_row_ids", "Q18", "SELECT count(*) AS rows, count(*) AS ids FROM orders")
def unique_row_ids(b):
    keyed = cleaning.add_surrogate_key(b.raw("orders").select("o_orderkey"), "row_id")
    return keyed.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("row_id").alias("ids"))


@query("orders_ranked_by_price", "W2 T8", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS price_rank FROM orders""")
def orders_ranked_by_price(b):
    source = b.raw("orders").select("o_orderkey", "o_totalprice")
    return ranking.global_row_number(source, ["o_totalprice", "o_orderkey"], "price_rank").drop("o_totalprice")


@query("table_profile", "P1 P3", """
    SELECT 'm_orders' AS "table", count(*) AS rows, CAST(7 AS BIGINT) AS columns,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM m_orders) d) AS duplicate_rows,
           CAST(7 * count(*) - count(order_datetime) - count(quantity) - count(sales_amount) - count(currency)
                - count(user_id) - count(restaurant_id) - count(basket_id) AS BIGINT) AS null_cells
    FROM m_orders""")
def table_profile(b):
    return profiling.table_profile(b.orders(), "m_orders")


@query("repeated_rows", "P1 P3", """
    t AS (SELECT o_custkey % 40 AS a, CAST(o_orderdate AS TIMESTAMP) + to_microseconds(o_orderkey % 3) AS at,
                 CASE o_orderkey % 4 WHEN 0 THEN -0.0 WHEN 1 THEN 0.0 WHEN 2 THEN CAST('nan' AS DOUBLE) END AS x,
                 [NULL, CAST(o_custkey % 3 AS VARCHAR)] AS nested, encode(o_orderstatus) AS raw FROM orders)
    SELECT 't' AS "table", count(*) AS rows, CAST(5 AS BIGINT) AS columns,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t) d) AS duplicate_rows,
           count(*) FILTER (WHERE x IS NULL OR isnan(x)) AS null_cells FROM t""")
def repeated_rows(b):
    """Rows that differ in microseconds, in the kind of a missing number or inside a nested value are not the same."""
    key = F.col("o_orderkey")
    at = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + key % 3)
    x = F.when(key % 4 == 0, F.lit(-0.0)).when(key % 4 == 1, F.lit(0.0)).when(key % 4 == 2, F.lit(float("nan")))
    nested = F.array(F.lit(None).cast("string"), (F.col("o_custkey") % 3).cast("string"))
    rows = b.raw("orders").select(
        (F.col("o_custkey") % 40).alias("a"), at.alias("at"), x.alias("x"), nested.alias("nested"),
        F.col("o_orderstatus").cast("binary").alias("raw"),
    )
    return profiling.table_profile(rows, "t")


PROFILE_LINE = """
    SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
           round(100.0 * (count(*) - count({c})) / count(*), 4) AS null_pct, count(DISTINCT {c}) AS distinct_values,
           (SELECT string_agg(CASE WHEN length(v) > 25 THEN substring(v, 1, 22) || '...' ELSE v END, ', ' ORDER BY v)
            FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {s} WHERE {c} IS NOT NULL ORDER BY v LIMIT 5) q)
           AS sample_values
    FROM {s}"""


@query("restaurant_columns", "P2 P4", " UNION ALL ".join(
    PROFILE_LINE.format(c=c, t=t, s="m_restaurant") for c, t in (
        ("restaurant_id", "bigint"), ("name", "string"), ("location", "string"), ("rating", "decimal(3,1)"),
        ("num_ratings", "int"), ("cost_for_two", "decimal(10,2)"), ("cuisine", "string"))))
def restaurant_columns(b):
    return profiling.column_profile(b.restaurant())


@query("document_columns", "P2 P4", " UNION ALL ".join(
    PROFILE_LINE.format(c=c, t=t, s="documents") for c, t in (
        ("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("n_chars", "int"), ("text", "string"))))
def document_columns(b):
    return profiling.column_profile(b.raw("documents").select("doc_id", "lang", "source", F.col("n_chars").cast("int").alias("n_chars"), "text"))


APPROXIMATE_LINE = """
    SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
           round(100.0 * (count(*) - count({c})) / count(*), 4) AS null_pct, true AS close FROM m_orders"""


@query("approximate_columns", "P2", " UNION ALL ".join(
    APPROXIMATE_LINE.format(c=c, t=t) for c, t in (
        ("order_datetime", "timestamp_ntz"), ("quantity", "int"), ("sales_amount", "decimal(12,2)"),
        ("currency", "string"), ("user_id", "bigint"), ("restaurant_id", "bigint"), ("basket_id", "bigint"))))
def approximate_columns(b):
    """Estimated distinct values next to exact ones: an estimate should be within a fifth."""
    orders = b.orders()
    guess = profiling.column_profile(orders, approx=True)
    exact = profiling.column_profile(orders, samples=0).select("column", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.2 * F.col("exact")
    return guess.join(exact, "column").withColumn("close", near).drop("distinct_values", "exact")


@query("table_preview", "P5", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 3""")
def table_preview(b):
    return profiling.preview(b.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"])


@query("candidate_join_keys", "P6", """
    pairs AS (
      SELECT 'food_id' AS "column", 'food' AS left_table, 'menu' AS right_table,
             count(*) AS left_values, count(*) FILTER (WHERE k IN (SELECT food_id FROM m_menu)) AS shared_values
      FROM (SELECT DISTINCT food_id AS k FROM m_food) t
      UNION ALL
      SELECT 'restaurant_id', 'menu', 'restaurant', count(*),
             count(*) FILTER (WHERE k IN (SELECT restaurant_id FROM m_restaurant))
      FROM (SELECT DISTINCT restaurant_id AS k FROM m_menu) t
      UNION ALL
      SELECT 'cuisine', 'menu', 'restaurant', count(*), count(*) FILTER (WHERE k IN
             (SELECT cuisine FROM m_restaurant WHERE cuisine IS NOT NULL))
      FROM (SELECT DISTINCT cuisine AS k FROM m_menu) t
      UNION ALL
      SELECT 'name', 'food', 'restaurant', count(*), count(*) FILTER (WHERE k IN (SELECT name FROM m_restaurant))
      FROM (SELECT DISTINCT name AS k FROM m_food) t)
    SELECT * FROM pairs""")
def candidate_join_keys(b):
    return profiling.candidate_join_keys(
        {"food": b.food(), "menu": b.menu(), "restaurant": b.restaurant()}
    )


@query("foreign_key_checklist", "P7", STRAY + """
    SELECT 'menu.restaurant_id -> restaurant.restaurant_id' AS foreign_key, true AS present,
           count(*) AS child_values, count(*) FILTER (WHERE k IN (SELECT restaurant_id FROM m_restaurant)) AS matched_values,
           round(count(*) FILTER (WHERE k IN (SELECT restaurant_id FROM m_restaurant)) / CAST(count(*) AS DOUBLE), 4) AS inclusion
    FROM (SELECT DISTINCT restaurant_id AS k FROM s) t
    UNION ALL
    SELECT 'menu.food_id -> food.food_id', true, count(*), count(*) FILTER (WHERE k IN (SELECT food_id FROM m_food)),
           round(count(*) FILTER (WHERE k IN (SELECT food_id FROM m_food)) / CAST(count(*) AS DOUBLE), 4)
    FROM (SELECT DISTINCT food_id AS k FROM s) t""")
def foreign_key_checklist(b):
    return profiling.foreign_key_checklist(
        {"menu": _stray_menu(b), **_parents(b)}, [("menu", MENU_TO_RESTAURANT), ("menu", MENU_TO_FOOD)]
    )


def _describe_sql(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round_even(avg({c}), 2) AS mean, round_even(stddev_samp({c}), 2) AS std,
            round_even(min({c}), 2) AS min, round_even(quantile_cont({c}, 0.25), 2) AS q25, round_even(quantile_cont({c}, 0.5), 2) AS q50,
            round_even(quantile_cont({c}, 0.75), 2) AS q75, round_even(max({c}), 2) AS max FROM {table}"""
        for c in columns
    )


@query("described_orders", "P8 A22", """
    n AS (SELECT CAST(quantity AS DOUBLE) AS quantity, CAST(sales_amount AS DOUBLE) AS sales_amount FROM m_orders),
    lines AS (""" + _describe_sql("n", ("quantity", "sales_amount")) + ") SELECT * FROM lines")
def described_orders(b):
    return profiling.describe(b.orders("quantity", "sales_amount"), ["quantity", "sales_amount"], places=2)


@query("sampled_customers", "T7", """
    SELECT user_id, name FROM m_users ORDER BY md5(user_id || '-42'), user_id LIMIT 500""")
def sampled_customers(b):
    return ranking.hashed_sample(b.users().select("user_id", "name"), "user_id", 500)


def _scratch(b, name: str) -> str:
    """A new folder next to the checkpoints, which every executor can reach."""
    return f"{ensure_checkpoint_dir(b.spark)}/{name}-{uuid.uuid4().hex}"


@query("load_report", "S1 S3 S5 S6 S7 S12 Q13 Q14", """
    listed AS (SELECT restaurant_id, food_id, first(price ORDER BY listed_in) AS price FROM m_menu GROUP BY 1, 2),
    o AS (SELECT o.*, 1 AS one FROM m_orders o)
    SELECT 'users' AS "table", (SELECT count(*) FROM customer) AS read, 0 AS coerced, 0 AS negative, 0 AS deduplicated,
           0 AS quarantined, (SELECT count(*) FROM customer) AS stored
    UNION ALL SELECT 'restaurant', count(*), count(*) - count(rating), 0, 0, 0, count(*) FROM m_restaurant
    UNION ALL SELECT 'food', count(*), 0, 0, 0, 0, count(*) FROM m_food
    UNION ALL SELECT 'menu', (SELECT count(*) FROM m_menu), 0, 0, (SELECT count(*) FROM m_menu) - count(*),
                     count(*) FILTER (WHERE food_id % 10 = 0), count(*) FILTER (WHERE food_id % 10 <> 0) FROM listed
    UNION ALL SELECT 'orders', count(*), 0, count(*) FILTER (WHERE sales_amount < 0), 0, 0, count(*) FROM o""")
def load_report(b):
    """Write the tables as untidy CSVs, load them through the whole ingest, and report."""
    raw, target = _scratch(b, "raw"), _scratch(b, "loaded")
    users = b.users().select(
        F.concat(F.lit("U"), F.col("user_id")).alias(" Id "), F.col("name").alias("Full Name"),
        *[F.lit(None).cast("string").alias(c) for c in ("email", "password", "age", "gender", "marital")],
        "occupation", *[F.lit(None).cast("string").alias(c) for c in ("income", "education", "family size")],
    )
    restaurant = b.restaurant().select(
        F.col("restaurant_id").cast("double").alias("R ID"), "name", F.col("location").alias("City"),
        F.coalesce(F.col("rating").cast("string"), F.lit("--")).alias("rate"),
        F.concat(F.col("num_ratings"), F.lit("+ ratings")).alias("votes"),
        F.concat(F.lit("₹ "), F.col("cost_for_two")).alias("Approx Cost (for two)"), "cuisine",
        *[F.lit(None).cast("string").alias(c) for c in ("license", "link", "address")],
    )
    food = b.food().select(
        F.concat(F.lit("fd"), F.col("food_id")).alias("f_id"), F.col("name").alias("item"), F.col("veg_or_non_veg").alias("type")
    )
    menu = b.menu().select(
        F.concat(F.lit("mn"), F.col("listed_at")).alias("menu_id"), F.col("restaurant_id").alias("r_id"),
        F.concat(F.lit("fd"), F.col("food_id") + F.when(F.col("food_id") % 10 == 0, 1_000_000).otherwise(0)).alias("f_id"),
        "cuisine", F.col("price").cast("string").alias("price"),
    )
    orders = b.orders().select(
        F.date_format("order_datetime", "dd/MM/yyyy HH:mm").alias("Order Date"), F.col("quantity").alias("sales_qty"),
        F.col("sales_amount").cast("string").alias("amount"),
        F.concat(F.col("currency"), F.lit("\r")).alias("currency"), "user_id",
        F.col("restaurant_id").cast("double").alias("r_id"),
    )
    sources = {"users": users, "restaurant": restaurant, "food": food, "menu": menu, "orders": orders}
    for name, frame in sources.items():
        frame.write.csv(f"{raw}/{name}", header=True)
    report = ingest.load(b.spark, {name: f"{raw}/{name}" for name in sources}, target)
    return report.table(b.spark)


@query("csv_round_trip", "S2 S8", """
    SELECT restaurant_id, name, location, round(CAST(cost_for_two AS DOUBLE), 4) AS cost_for_two FROM m_restaurant""")
def csv_round_trip(b):
    path = _scratch(b, "export")
    sinks.export_csv(b.restaurant().select("restaurant_id", "name", "location", "cost_for_two"), path, ["restaurant_id"])
    return read_csv_inferred(b.spark, path)


@query("quoted_csv_round_trip", "S1", r"""
    SELECT doc_id, md5(replace(text, chr(13), '')) AS text_md5, length(replace(text, chr(13), '')) AS n_chars, lang
    FROM documents WHERE replace(text, chr(13), '') <> ''""")
def quoted_csv_round_trip(b):
    """Texts with line breaks and quotes in CSV files of several splits each, read in splits by many tasks."""
    path = _scratch(b, "texts")
    docs = b.raw("documents").where(F.replace("text", F.lit("\r"), F.lit("")) != "").select("doc_id", "text", "lang")
    # A file takes two splits of the table: no task reads or writes more of it, however large it is.
    files = (docs.rdd.getNumPartitions() + 1) // 2
    docs.coalesce(files).write.csv(path, header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    read = read_csv_robust(b.spark, path)
    return read.select(F.col("doc_id").cast("long"), F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), "lang")


@query("load_left_undone", "S5 S6 S12", """
    SELECT 'users' AS "table", count(*) AS rows, 1 AS version FROM customer
    UNION ALL SELECT 'food', count(*), 1 FROM m_food""")
def load_left_undone(b):
    """Tables as readers find them after a second load that broke at its last table, when the first was written anew."""
    raw, target = _scratch(b, "raw"), _scratch(b, "loaded")
    order = ("users", "food")
    contracts = {n: ingest.CONTRACTS[n] for n in order}
    users = b.users().select("user_id", "name", *[F.lit(None).cast("string").alias(c) for c in list(contracts["users"].headers)[2:]])
    food = b.food().select("food_id", "name", "veg_or_non_veg")
    sources = {"users": f"{raw}/users", "food": f"{raw}/food"}
    users.write.csv(sources["users"], header=True)
    food.write.csv(sources["food"], header=True)
    ingest.create_tables(b.spark, target, contracts, order)
    ingest.load(b.spark, sources, target, contracts=contracts, order=order, must_exist=True)
    users.where("user_id % 2 = 0").write.csv(f"{raw}/half", header=True)
    food.drop("name").write.csv(f"{raw}/broken", header=True)
    try:
        ingest.load(b.spark, {"users": f"{raw}/half", "food": f"{raw}/broken"}, target, reset=True, contracts=contracts, order=order)
    except ValueError:
        pass
    version = versions.current(b.spark, target).version
    tables = versions.open_tables(b.spark, target)
    counted = [df.agg(F.lit(n).alias("table"), F.count(F.lit(1)).alias("rows"), F.lit(version - 1).alias("version")) for n, df in tables.items()]
    return counted[0].unionByName(counted[1])


@query("cleaned_documents", "Q3", r"""
    SELECT doc_id, CASE WHEN t NOT IN ('', 'nan', 'None') THEN length(t) END AS n_chars
    FROM (SELECT doc_id, regexp_replace(text, '^[\s]+|[\s]+$', '', 'g') AS t FROM documents) d""")
def cleaned_documents(b):
    cleaned = cleaning.clean_strings(b.raw("documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.length("text").alias("n_chars"))
