"""Input tables: the driver's Parquet tables and two views with dirt in them.

The Parquet tables hold no nulls and clean numbers, so the cleaning operators
run on ``listings`` and ``host_profiles``. Both are plain expressions over
``orders`` and ``customer``: they read the whole tables and grow with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# column -> expression; {dmy}(d) and {ymd}(d) format a date. The same text runs
# in Spark and in the SQL the results are checked against.
LISTING_COLUMNS = {
    "row_id": "o_orderkey * 10 + copy",
    "id": "CASE WHEN copy = 2 THEN o_orderkey + 1000000000 ELSE o_orderkey END",
    "host_id": "CASE WHEN o_orderkey % 307 = 0 THEN NULL ELSE o_custkey END",
    "host_name": "c_name",
    "name": (
        "concat('Suite ', c_mktsegment, ' no ', CAST(o_orderkey % 100 AS {text}), "
        "CASE WHEN copy = 2 THEN ' annex' ELSE '' END)"
    ),
    "latitude": (
        "CASE WHEN o_orderkey % 211 = 0 THEN NULL "
        "ELSE CAST(42640 + o_custkey % 80 AS DOUBLE) / CAST(1000 AS DOUBLE) END"
    ),
    "longitude": "CAST(-73850 + o_custkey % 120 AS DOUBLE) / CAST(1000 AS DOUBLE)",
    "price": (
        "CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN '$0.00' "
        "WHEN cents >= 100000 THEN concat('$', CAST(CAST(floor(cents / 100000) AS BIGINT) AS {text}), ',', "
        "lpad(CAST(CAST(floor(cents / 100) AS BIGINT) % 1000 AS {text}), 3, '0'), '.', "
        "lpad(CAST(cents % 100 AS {text}), 2, '0')) "
        "ELSE concat('$', CAST(CAST(floor(cents / 100) AS BIGINT) AS {text}), '.', "
        "lpad(CAST(cents % 100 AS {text}), 2, '0')) END"
    ),
    "minimum_nights": (
        "CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 400 "
        "WHEN o_orderkey % 37 = 0 THEN 40 ELSE 1 + o_orderkey % 7 END"
    ),
    "maximum_nights": (
        "CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN 1 "
        "ELSE 30 + o_orderkey % 336 END"
    ),
    "availability_365": (
        "CASE WHEN o_orderkey % 53 = 0 THEN 400 WHEN o_orderkey % 11 = 0 THEN 0 "
        "ELSE (o_orderkey * 7) % 366 END"
    ),
    "number_of_reviews": "(o_orderkey * 13) % 251",
    "room_type": (
        "CASE WHEN o_orderkey % 67 = 0 THEN NULL WHEN o_orderkey % 61 = 0 THEN 'Tent' "
        "WHEN o_orderkey % 10 < 6 THEN 'Entire home/apt' WHEN o_orderkey % 10 < 8 THEN 'Private room' "
        "WHEN o_orderkey % 10 = 8 THEN 'Hotel room' ELSE 'Shared room' END"
    ),
    "neighbourhood_cleansed": (
        "CASE o_custkey % 4 WHEN 0 THEN 'FIRST WARD' WHEN 1 THEN ' second ward ' "
        "WHEN 2 THEN 'Third Ward' ELSE 'FOURTH WARD' END"
    ),
    "neighbourhood_group_cleansed": (
        "CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 71 = 0 THEN 'OUTSIDE' "
        "WHEN o_custkey % 3 = 0 THEN 'FIRST WARD' WHEN o_custkey % 3 = 1 THEN 'second ward' "
        "ELSE 'THIRD WARD ' END"
    ),
    "bathrooms_text": (
        "CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '1 bath' WHEN 2 THEN '1.5 baths' "
        "WHEN 3 THEN 'Half-bath' WHEN 4 THEN 'Shared half-bath' WHEN 5 THEN '2 shared baths' "
        "WHEN 6 THEN '1 private bath' WHEN 7 THEN 'Private half-bath' ELSE 'none' END"
    ),
    "bathrooms": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 3 AS DOUBLE) END",
    "bedrooms": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS DOUBLE) END",
    "beds": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS DOUBLE) END",
    "accommodates": "1 + o_orderkey % 8",
    "review_scores_rating": (
        "CASE WHEN o_orderkey % 8 = 0 THEN NULL "
        "ELSE CAST(10 + o_orderkey % 41 AS DOUBLE) / CAST(10 AS DOUBLE) END"
    ),
    "last_scraped": "CASE WHEN o_orderkey % 83 = 0 THEN 'bad date' ELSE {dmy}(o_orderdate) END",
    "host_since": (
        "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {ymd}(o_orderdate - INTERVAL 400 DAY) END"
    ),
    "host_response_rate": (
        "CASE WHEN o_orderkey % 12 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN '120%' "
        "ELSE concat(CAST(50 + o_orderkey % 51 AS {text}), '%') END"
    ),
    "hosts_time_as_host_years": "o_custkey % 3",
    "hosts_time_as_host_months": "o_custkey % 2",
    "first_review": (
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {dmy}(o_orderdate - INTERVAL 90 DAY) END"
    ),
    "description": (
        "CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN '  ' "
        "WHEN o_orderkey % 43 = 0 THEN 'N/A' WHEN o_orderkey % 47 = 0 THEN 'Apartment' "
        "WHEN o_orderkey % 19 = 0 THEN 'Great safe area' "
        "ELSE concat('Bright ', lower(c_mktsegment), ' suite with a garden, near the old market "
        "and the park, number ', CAST(o_orderkey AS {text})) END"
    ),
    "amenities": (
        "CASE o_orderkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN 'Wifi, Kitchen , Free parking' "
        "WHEN 3 THEN '[\"Wifi\", \"Wifi\", \"Heating\"]' WHEN 4 THEN '[\"Café corner\", \"TV\"]' "
        "WHEN 5 THEN '[{q}Washer{q}, {q}Dryer{q}]' "
        "ELSE concat('[\"Wifi\", \"Kitchen\", \"Smoke alarm\", \"Item ', CAST(o_orderkey % 40 AS {text}), '\"]') END"
    ),
}

def _dialect(expression: str, dialect: str) -> str:
    """Fill in the few spellings that differ between the two SQL dialects."""
    text = expression.replace("{text}", "STRING" if dialect == "spark" else "VARCHAR")
    text = text.replace("{q}", "\\'" if dialect == "spark" else "''")  # a quote inside a literal
    for mark, spark_format, duck_format in (
        ("{dmy}", "dd-MM-yyyy", "%d-%m-%Y"),
        ("{ymd}", "yyyy-MM-dd", "%Y-%m-%d"),
    ):
        while mark in text:
            start = text.index(mark)
            end = text.index(")", start)
            argument = text[start + len(mark) + 1 : end]
            call = (
                f"date_format({argument}, '{spark_format}')"
                if dialect == "spark"
                else f"strftime({argument}, '{duck_format}')"
            )
            text = text[:start] + call + text[end + 1 :]
    return text


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows with exact copies, near copies, nulls and malformed cells."""
    base = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    base = spread(base, "o_orderkey")  # a file may be one split; what is derived from a row costs more than moving it
    copies = F.filter(
        F.array(
            F.lit(0),
            F.when(F.col("o_orderkey") % 50 == 0, F.lit(1)),
            F.when(F.col("o_orderkey") % 45 == 0, F.lit(2)),
        ),
        lambda c: c.isNotNull(),
    )
    rows = base.select(
        "*", F.floor("o_totalprice").cast("bigint").alias("cents"), F.explode(copies).alias("copy")
    )
    return rows.select(*[F.expr(_dialect(e, "spark")).alias(c) for c, e in LISTING_COLUMNS.items()])


def listings_sql() -> str:
    """The same rows as a query for the checking database."""
    columns = ", ".join(f"{_dialect(e, 'duckdb')} AS {c}" for c, e in LISTING_COLUMNS.items())
    return (
        "WITH base AS (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS cents "
        "FROM orders JOIN customer ON o_custkey = c_custkey), "
        "copied AS (SELECT *, 0 AS copy FROM base "
        "UNION ALL SELECT *, 1 AS copy FROM base WHERE o_orderkey % 50 = 0 "
        "UNION ALL SELECT *, 2 AS copy FROM base WHERE o_orderkey % 45 = 0) "
        f"SELECT {columns} FROM copied"
    )


# One row per customer; nulls follow the key.
PROFILE_COLUMNS = {
    "host_id": "c_custkey",
    "balance": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END",
    "orders_count": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(n_orders AS DOUBLE) END",
    "mean_price": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE mean_price END",
    "top_price": "top_price",
    "nation": "CAST(c_nationkey AS DOUBLE)",
}


def host_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One numeric row per customer, with nulls, for the neighbour operators."""
    spent = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("n_orders"),
            (F.sum(F.floor("o_totalprice").cast("bigint")).cast("double") / F.count("*")).alias("mean_price"),
            F.max("o_totalprice").alias("top_price"),
        )
    )
    joined = (
        table(spark, sf_dir, "customer")
        .join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumns(
            {
                "n_orders": F.coalesce("n_orders", F.lit(0)),
                "mean_price": F.coalesce("mean_price", F.lit(0.0)),
                "top_price": F.coalesce("top_price", F.lit(0.0)),
            }
        )
    )
    return joined.select(*[F.expr(e).alias(c) for c, e in PROFILE_COLUMNS.items()])


def host_profiles_sql() -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in PROFILE_COLUMNS.items())
    return (
        "WITH spent AS (SELECT o_custkey, count(*) AS n_orders, "
        "CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS DOUBLE) / count(*) AS mean_price, "
        "max(o_totalprice) AS top_price FROM orders GROUP BY o_custkey), "
        "joined AS (SELECT c_custkey, c_acctbal, c_nationkey, coalesce(n_orders, 0) AS n_orders, "
        "coalesce(mean_price, 0.0) AS mean_price, coalesce(top_price, 0.0) AS top_price "
        "FROM customer LEFT JOIN spent ON c_custkey = o_custkey) "
        f"SELECT {columns} FROM joined"
    )
