"""The given Parquet tables seen through the star model.

A fact row is a line item with the customer and date of its order. The order header is joined only
when a query asks for one of its columns: as a left join on a unique key it adds no rows, so leaving
it out changes nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.model import Columns, StarModel

HEADER_COLUMNS = ("order_datetime", "user_id")
FACT_COLUMNS = (
    "order_datetime", "quantity", "sales_amount", "currency", "user_id", "restaurant_id", "basket_id",
)

FESTIVALS = {
    "lights": ("1995-10-23", "1996-11-10", "1997-10-30", "1998-10-19", "1999-11-07", "2000-10-26"),
    "spring": ("1996-03-05", "1997-03-24", "1998-03-13", "1999-03-02", "2000-03-20", "2001-03-10"),
}


@dataclass(frozen=True)
class Binding:
    spark: SparkSession
    folder: str
    c: Columns = Columns()

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{table}.parquet")

    def orders(self, *columns: str) -> DataFrame:
        wanted = columns or FACT_COLUMNS
        lines = self.raw("lineitem")
        first_refund = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        expressions: dict[str, Column] = {
            "order_datetime": F.col("o_orderdate").cast("timestamp_ntz"),
            "quantity": F.col("l_quantity").cast("int"),
            "sales_amount": F.when(first_refund, -price).otherwise(price).cast("decimal(12,2)"),
            "currency": F.when(F.col("l_returnflag") == "A", "USD").otherwise("INR"),
            "user_id": F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")),
            "restaurant_id": F.when(F.col("l_linenumber") != 7, F.col("l_partkey")),
            "basket_id": F.col("l_orderkey"),
        }
        if any(name in HEADER_COLUMNS for name in wanted):
            headers = self.raw("orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_orderpriority")
            lines = lines.join(headers, lines.l_orderkey == headers.o_orderkey, "left")
        return lines.select(*[expressions[name].alias(name) for name in wanted])

    def restaurant(self) -> DataFrame:
        size = F.col("p_size")
        second_word = F.split_part("p_name", F.lit(" "), F.lit(2))
        return self.raw("part").select(
            F.col("p_partkey").alias("restaurant_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("location"),
            F.when(size <= 45, (size / 10).cast("decimal(3,1)")).alias("rating"),
            (size * 7).alias("num_ratings"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("cost_for_two"),
            F.when(size <= 5, F.col("p_type"))
            .when(size <= 49, F.concat("p_type", F.lit(", "), second_word))
            .alias("cuisine"),
        )

    def users(self) -> DataFrame:
        nations = self.raw("nation").select("n_nationkey", F.col("n_name").alias("home"))
        customers = self.raw("customer")
        return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            "home",
            F.col("c_mktsegment").alias("occupation"),
        )

    def food(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("food_id"),
            F.col("s_name").alias("name"),
            F.when(F.col("s_acctbal") < 0, "Non-veg").otherwise("Veg").alias("veg_or_non_veg"),
        )

    def menu(self) -> DataFrame:
        """Listings with repeated (restaurant, food) pairs and the columns that order them."""
        return self.raw("lineitem").select(
            F.col("l_partkey").alias("restaurant_id"),
            F.col("l_suppkey").alias("food_id"),
            F.concat("l_returnflag", "l_linestatus").alias("cuisine"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
            F.col("l_orderkey").alias("listed_in"),
            F.col("l_linenumber").alias("listed_at"),
        )

    def dirty(self) -> DataFrame:
        """Line items as the untidy text that exports contain."""
        quantity = F.col("l_quantity").cast("int").cast("string")
        price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
        kind, cell = F.col("l_orderkey") % 8, F.col("l_partkey") % 5
        return self.raw("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.when(kind == 0, F.concat(F.lit("fd"), quantity))
            .when(kind == 1, F.concat(quantity, F.lit("+ ratings")))
            .when(kind == 2, F.concat(quantity, F.lit("K+ ratings")))
            .when(kind == 3, F.concat(quantity, F.lit(".0")))
            .when(kind == 4, F.concat(quantity, F.lit(".5")))
            .when(kind == 5, F.lit("Too Few Ratings"))
            .when(kind == 6, F.concat(F.lit("1,"), F.lpad(quantity, 3, "0")))
            .otherwise(F.concat(F.lit("  "), quantity, F.lit(" ")))
            .alias("quantity"),
            F.when(cell == 0, F.concat(F.lit("₹ "), price))
            .when(cell == 1, F.lit("--"))
            .when(cell == 2, F.lit("NEW"))
            .when(cell == 3, F.concat(F.lit("-"), price))
            .otherwise(price)
            .alias("price"),
            F.when(F.col("l_orderkey") % 10 == 7, F.lit("soon"))
            .when(F.col("l_orderkey") % 4 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy"))
            .alias("shipped"),
            F.when(F.col("l_suppkey") % 6 == 0, F.lit("\tINR "))
            .when(F.col("l_suppkey") % 6 == 1, F.lit("   "))
            .when(F.col("l_suppkey") % 6 == 2, F.lit("nan"))
            .when(F.col("l_suppkey") % 6 == 3, F.lit("None"))
            .when(F.col("l_suppkey") % 6 == 4, F.lit(""))
            .otherwise(F.lit("USD"))
            .alias("currency"),
        )

    def model(self, *fact_columns: str) -> StarModel:
        return StarModel(
            orders=self.orders(*fact_columns),
            restaurant=self.restaurant(),
            users=self.users(),
            food=self.food(),
            menu=self.menu(),
            c=self.c,
        )


# The same tables in SQL; a statement gets the ones it names.
SQL_TABLES = {
    "m_orders": """
        SELECT o.o_orderdate AS order_datetime, CAST(l.l_quantity AS INTEGER) AS quantity,
               CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice ELSE l_extendedprice END
                    AS DECIMAL(12,2)) AS sales_amount,
               CASE WHEN l_returnflag = 'A' THEN 'USD' ELSE 'INR' END AS currency,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS user_id,
               CASE WHEN l_linenumber <> 7 THEN l_partkey END AS restaurant_id,
               l_orderkey AS basket_id
        FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "m_restaurant": """
        SELECT p_partkey AS restaurant_id, p_name AS name, p_brand AS location,
               CASE WHEN p_size <= 45 THEN CAST(p_size / 10.0 AS DECIMAL(3,1)) END AS rating,
               p_size * 7 AS num_ratings, CAST(p_retailprice AS DECIMAL(10,2)) AS cost_for_two,
               CASE WHEN p_size <= 5 THEN p_type
                    WHEN p_size <= 49 THEN p_type || ', ' || split_part(p_name, ' ', 2) END AS cuisine
        FROM part""",
    "m_tags": """
        SELECT restaurant_id, trim(tag) AS tag
        FROM (SELECT p_partkey AS restaurant_id,
                     unnest(string_split(CASE WHEN p_size <= 5 THEN p_type
                            WHEN p_size <= 49 THEN p_type || ', ' || split_part(p_name, ' ', 2) END, ',')) AS tag
              FROM part) t""",
    "m_users": """
        SELECT c_custkey AS user_id, c_name AS name, n_name AS home, c_mktsegment AS occupation
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "m_food": """
        SELECT s_suppkey AS food_id, s_name AS name,
               CASE WHEN s_acctbal < 0 THEN 'Non-veg' ELSE 'Veg' END AS veg_or_non_veg
        FROM supplier""",
    "m_menu": """
        SELECT l_partkey AS restaurant_id, l_suppkey AS food_id, l_returnflag || l_linestatus AS cuisine,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price, l_orderkey AS listed_in, l_linenumber AS listed_at
        FROM lineitem""",
    "m_dirty": """
        SELECT l_orderkey, l_linenumber,
               CASE l_orderkey % 8 WHEN 0 THEN 'fd' || q WHEN 1 THEN q || '+ ratings' WHEN 2 THEN q || 'K+ ratings'
                    WHEN 3 THEN q || '.0' WHEN 4 THEN q || '.5' WHEN 5 THEN 'Too Few Ratings'
                    WHEN 6 THEN '1,' || lpad(q, 3, '0') ELSE '  ' || q || ' ' END AS quantity,
               CASE l_partkey % 5 WHEN 0 THEN '₹ ' || p WHEN 1 THEN '--' WHEN 2 THEN 'NEW' WHEN 3 THEN '-' || p
                    ELSE p END AS price,
               CASE WHEN l_orderkey % 10 = 7 THEN 'soon' WHEN l_orderkey % 4 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
                    ELSE strftime(l_shipdate, '%d/%m/%Y') END AS shipped,
               CASE l_suppkey % 6 WHEN 0 THEN chr(9) || 'INR ' WHEN 1 THEN '   ' WHEN 2 THEN 'nan' WHEN 3 THEN 'None'
                    WHEN 4 THEN '' ELSE 'USD' END AS currency
        FROM (SELECT *, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q,
                     CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS p FROM lineitem) t""",
    "m_rfm": """
        SELECT user_id,
               date_diff('day', max(CAST(order_datetime AS DATE)),
                         (SELECT max(CAST(order_datetime AS DATE)) + 1 FROM m_orders)) AS recency_days,
               count(*) AS frequency,
               coalesce(sum(sales_amount) FILTER (WHERE currency = 'INR'), 0) AS monetary
        FROM m_orders WHERE user_id IS NOT NULL GROUP BY user_id""",
    "m_ranked": """
        SELECT *, row_number() OVER (ORDER BY recency_days, user_id) AS rr,
               row_number() OVER (ORDER BY frequency, user_id) AS rf,
               row_number() OVER (ORDER BY monetary, user_id) AS rm, count(*) OVER () AS n
        FROM m_rfm""",
    "m_scored": """
        SELECT user_id, recency_days, frequency, monetary,
               5 - greatest(1, CAST(ceil(4.0 * (rr - 1) / (n - 1)) AS INTEGER)) AS r_score,
               greatest(1, CAST(ceil(4.0 * (rf - 1) / (n - 1)) AS INTEGER)) AS f_score,
               greatest(1, CAST(ceil(4.0 * (rm - 1) / (n - 1)) AS INTEGER)) AS m_score
        FROM m_ranked""",
    "m_segments": """
        SELECT *, CASE WHEN r_score + f_score + m_score >= 11 THEN 'Champions'
                       WHEN r_score + f_score + m_score >= 9 THEN 'Loyal'
                       WHEN r_score + f_score + m_score >= 7 THEN 'Potential Loyalist'
                       WHEN r_score + f_score + m_score >= 5 THEN 'At Risk' ELSE 'Lost' END AS segment
        FROM m_scored""",
    "m_gaps": """
        SELECT user_id, order_datetime,
               lag(order_datetime) OVER (PARTITION BY user_id ORDER BY order_datetime) AS previous_time,
               date_diff('day', lag(order_datetime) OVER (PARTITION BY user_id ORDER BY order_datetime),
                         order_datetime) AS gap_days
        FROM m_orders WHERE user_id IS NOT NULL""",
    "m_threshold": """
        SELECT count(gap_days) AS gaps, median(gap_days) AS median_gap, stddev_samp(gap_days) AS std_gap,
               CAST(least(greatest(ceil(median(gap_days) + stddev_samp(gap_days)), 30), 180) AS INTEGER) AS threshold_days
        FROM m_gaps""",
    "m_features": """
        SELECT f.*, coalesce(d.tag_diversity, 0) AS tag_diversity
        FROM (SELECT user_id,
                     date_diff('day', max(order_datetime),
                               (SELECT max(order_datetime) FROM m_orders WHERE user_id IS NOT NULL)) + 1 AS recency_days,
                     count(*) AS frequency,
                     CAST(sum(sales_amount) FILTER (WHERE currency = 'INR') AS DOUBLE)
                         / nullif(count(*) FILTER (WHERE currency = 'INR'), 0) AS aov,
                     date_diff('day', min(order_datetime), max(order_datetime)) AS tenure_days,
                     CASE WHEN count(*) > 1 THEN date_diff('day', min(order_datetime), max(order_datetime))
                          // (count(*) - 1) ELSE 0 END AS avg_gap_days,
                     coalesce(sum(sales_amount) FILTER (WHERE currency = 'INR'), 0) AS monetary
              FROM m_orders WHERE user_id IS NOT NULL GROUP BY user_id) f
        LEFT JOIN (SELECT user_id, count(DISTINCT tag) AS tag_diversity
                   FROM m_orders JOIN m_tags USING (restaurant_id) WHERE user_id IS NOT NULL GROUP BY user_id) d
        USING (user_id)""",
    "m_labelled": """
        SELECT f.*, CASE WHEN recency_days > threshold_days THEN 1 ELSE 0 END AS churned
        FROM m_features f, m_threshold""",
    "m_split": """
        SELECT *, row_number() OVER (PARTITION BY churned ORDER BY md5(user_id || '-42'), user_id)
                  <= floor(count(*) OVER (PARTITION BY churned) * 0.25 + 0.5) AS is_test
        FROM m_labelled""",
    "m_given_scores": """
        SELECT user_id, churned, score, CASE WHEN score >= 50 THEN 1 ELSE 0 END AS prediction
        FROM (SELECT user_id, churned, CAST((tenure_days + avg_gap_days * 3) % 101 AS DOUBLE) AS score FROM m_labelled) t""",
    "m_weekly": """
        SELECT CAST(date_trunc('week', order_datetime) AS DATE) AS week, CAST(sum(sales_amount) AS DOUBLE) AS revenue
        FROM m_orders WHERE currency = 'INR' GROUP BY 1""",
}


def with_tables(body: str) -> str:
    """Prefix a statement with the tables it uses. ``body`` is a SELECT or ``name AS (…), … SELECT``."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in SQL_TABLES.items():
            if name in text and name not in needed:
                visit(definition)
                if name not in needed:
                    needed.append(name)

    visit(body)
    prefix = ", ".join(f"{name} AS ({SQL_TABLES[name].strip()})" for name in needed)
    body = body.strip()
    if not prefix:
        return body if body.upper().startswith("SELECT") else f"WITH {body}"
    return f"WITH {prefix} {body}" if body.upper().startswith("SELECT") else f"WITH {prefix}, {body}"
