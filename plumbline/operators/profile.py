"""Column and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, count_where, is_missing, is_numeric, is_text, percent
from plumbline.functions.quantiles import quantile_row, quantile_table
from plumbline.functions.scalars import attach
from plumbline.functions.text import SPACE, strip
from plumbline.operators.dedup import row_signature
from plumbline.session import settle

# Columns of the correlation matrix and of its plotted triangle.
CORRELATION_COLUMNS = ["price", "minimum_nights", "availability_365", "number_of_reviews"]
TRIANGLE_COLUMNS = [
    "minimum_nights",
    "availability_365",
    "number_of_reviews",
    "reviews_per_month",
    "calculated_host_listings_count",
]
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if is_numeric(df, c)]


def _without(df: DataFrame, key: str | None) -> list[str]:
    return [c for c in df.columns if c != key]


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Fail before any job starts when a needed column is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise KeyError(f"missing required column(s): {absent}")


def cells(df: DataFrame, key: str | None = None) -> DataFrame:
    """Long form ``(column, value text, [key])``; missing cells have a null value."""
    names = _without(df, key)
    wide = df.select(
        *([key] if key else []),
        *[F.when(~is_missing(df, c), F.col(c).cast("string")).alias(c) for c in names],
    )
    return wide.unpivot([key] if key else [], names, "column", "value")


def dataset_summary(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows, columns and copies of earlier rows (``key`` is not compared)."""
    names = _without(df, key)
    groups = df.groupBy(row_signature(df, names).alias("sig")).agg(F.count("*").alias("c"))
    total = groups.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    return total.select(
        "total_rows",
        F.lit(len(names)).cast("bigint").alias("total_columns"),
        "duplicate_rows",
        F.coalesce(percent(F.col("duplicate_rows"), F.col("total_rows"), 4), F.lit(0.0)).alias("duplicate_pct"),
    )


def column_profile(df: DataFrame, key: str | None = None, approx: bool = False) -> DataFrame:
    """Per column: type, rows, present and missing cells, distinct present values.

    The exact form counts each (column, value) first, so a value that fills a
    third of a column is one row after the map-side combine. ``approx`` does
    everything in one scan without a shuffle of the values.
    """
    names = _without(df, key)
    dtypes = {c: df.schema[c].dataType.simpleString() for c in names}
    if approx:
        one = df.agg(
            F.count("*").alias("total_rows"),
            *[count_where(~is_missing(df, c)).alias(f"n_{i}") for i, c in enumerate(names)],
            *[
                F.approx_count_distinct(F.when(~is_missing(df, c), F.col(c))).alias(f"d_{i}")
                for i, c in enumerate(names)
            ],
        )
        rows = ", ".join(f"'{c}', n_{i}, d_{i}" for i, c in enumerate(names))
        counted = one.selectExpr(
            "total_rows", f"stack({len(names)}, {rows}) AS (column, non_null_count, unique_count)"
        )
    else:
        values = cells(df, key).drop(*([key] if key else [])).groupBy("column", "value").agg(F.count("*").alias("c"))
        counted = values.groupBy("column").agg(
            F.sum("c").alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("c"))), F.lit(0)).alias("non_null_count"),
            F.count("value").alias("unique_count"),
        )
    return counted.select(
        "column",
        _lookup(dtypes, F.col("column")).alias("dtype"),
        "total_rows",
        "non_null_count",
        (F.col("total_rows") - F.col("non_null_count")).alias("missing_count"),
        percent(F.col("total_rows") - F.col("non_null_count"), F.col("total_rows"), 4).alias("missing_pct"),
        "unique_count",
    )


def _lookup(values: Mapping[str, object], key: Column) -> Column:
    """Map literal lookup; the map has one entry per column of the table."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.create_map(*pairs)[key]


def distribution_stats(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the numeric columns."""
    columns = list(columns or numeric_columns(df))
    exprs = {c: as_double(df, c) for c in columns}
    aggregates = []
    for i, c in enumerate(columns):
        v = exprs[c]
        aggregates += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"a{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"l{i}"),
            F.max(v).alias(f"h{i}"),
        ]
    rows = ", ".join(f"'{c}', n{i}, a{i}, s{i}, l{i}, h{i}" for i, c in enumerate(columns))
    moments = df.agg(*aggregates).selectExpr(
        f"stack({len(columns)}, {rows}) AS (column, count, mean, std, min, max)"
    )
    # Both sides have one row per named column.
    quartiles = quantile_table(df, exprs, QUARTILES).drop("n")
    joined = moments.join(F.broadcast(quartiles), "column", "left")
    std = F.when(F.col("count") == 1, F.lit(0.0)).otherwise(F.col("std"))
    return joined.select(
        "column",
        "count",
        F.round("mean", digits).alias("mean"),
        F.round(std, digits).alias("std"),
        *[F.round(c, digits).alias(c) for c in ("min", "q25", "q50", "q75", "max")],
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS, digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson correlation, one row per ordered pair.

    Columns that are absent or still text are left out.
    """
    names = [c for c in columns if c in df.columns and is_numeric(df, c)]
    value = {c: as_double(df, c) for c in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    one = df.agg(
        *[
            F.corr(
                F.when(value[b].isNotNull(), value[a]), F.when(value[a].isNotNull(), value[b])
            ).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = [f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs)]
    rows += [f"'{b}', '{a}', c{i}" for i, (a, b) in enumerate(pairs) if a != b]
    long = one.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (col_a, col_b, corr)")
    defined = F.when(~F.isnan("corr"), F.round("corr", digits))
    return long.select("col_a", "col_b", defined.alias("corr"))


def correlation_triangle(df: DataFrame, columns: Sequence[str] = TRIANGLE_COLUMNS, digits: int = 6) -> DataFrame:
    """The part of the matrix below its diagonal, as the plotted heat map shows."""
    names = [c for c in columns if c in df.columns and is_numeric(df, c)]
    below = {(b, a) for a, b in combinations(names, 2)}
    matrix = correlation_matrix(df, names, digits)
    wanted = reduce(
        lambda x, y: x | y,
        [(F.col("col_a") == a) & (F.col("col_b") == b) for a, b in sorted(below)],
        F.lit(False),
    )
    return matrix.where(wanted)


def missing_matrix(df: DataFrame, key: str, buckets: int = 20) -> DataFrame:
    """Missing share per (row bucket, column): the data behind a missingness heat map."""
    names = _without(df, key)
    span = F.col("__span")
    width = (span["hi"] - span["lo"] + 1) / F.lit(float(buckets))
    bucket = F.least(F.floor((F.col(key) - span["lo"]) / width), F.lit(buckets - 1)).cast("bigint")
    spanned = attach(df, df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")), "__span")
    grouped = spanned.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("rows"), *[count_where(is_missing(df, c)).alias(c) for c in names]
    )
    long = grouped.unpivot(["bucket", "rows"], names, "column", "missing_count")
    return long.select(
        "bucket", "column", "rows", "missing_count", percent(F.col("missing_count"), F.col("rows"), 4).alias("missing_pct")
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str], annotate_above: float = 365.0) -> DataFrame:
    """Box, whiskers at 1.5 IQR and flier counts per column.

    ``annotated_max`` holds the maximum where it passes ``annotate_above``.
    """
    exprs = {c: as_double(df, c) for c in columns}
    box = quantile_table(df, exprs, QUARTILES)
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    quarters = quantile_row(df, {names[c]: exprs[c] for c in columns}, {"q25": 0.25, "q75": 0.75})
    q = F.col("__q")
    aggregates = []
    for i, c in enumerate(columns):
        v, q1, q3 = exprs[c], q[f"{names[c]}_q25"], q[f"{names[c]}_q75"]
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        aggregates += [
            F.min(F.when(v >= low, v)).alias(f"wl{i}"),
            F.max(F.when(v <= high, v)).alias(f"wh{i}"),
            count_where((v < low) | (v > high)).alias(f"f{i}"),
            F.max(v).alias(f"m{i}"),
        ]
    rows = ", ".join(f"'{c}', wl{i}, wh{i}, f{i}, m{i}" for i, c in enumerate(columns))
    whiskers = attach(df, quarters, "__q").agg(*aggregates).selectExpr(
        f"stack({len(columns)}, {rows}) AS (column, whisker_low, whisker_high, flier_count, max_value)"
    )
    # One row per named column on both sides.
    return whiskers.join(F.broadcast(box), "column", "left").select(
        "column",
        "n",
        *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75", "whisker_low", "whisker_high")],
        "flier_count",
        F.when(F.col("max_value") > annotate_above, F.col("max_value")).alias("annotated_max"),
    )


def boxplot_fliers(df: DataFrame, key: str, column: str) -> DataFrame:
    """The rows outside the whiskers of one column."""
    v = as_double(df, column)
    q = F.col("__q")
    reach = 1.5 * (q["q75"] - q["q25"])
    boxed = attach(df.select(key, v.alias("value")), quantile_table(df, {column: v}, QUARTILES).select("q25", "q75"), "__q")
    outside = (F.col("value") < q["q25"] - reach) | (F.col("value") > q["q75"] + reach)
    return boxed.where(outside).select(key, "value")


# Names the semantic-type decision list knows.
NUMERIC_PREFIXES = [
    "number_of_reviews",
    "reviews_per_month",
    "review_scores_",
    "calculated_host_listings",
    "availability_",
    "hosts_time_as_",
]
DATE_WORDS = ["scraped", "since", "first_review", "last_review"]
TEXT_NUMERIC = ["price", "bathrooms_text"]
FREE_TEXT = [
    "name",
    "description",
    "neighborhood_overview",
    "host_about",
    "amenities",
    "price_quote_raw",
    "host_verifications",
    "license",
]
CATEGORICAL = [
    "source",
    "host_is_superhost",
    "host_has_profile_pic",
    "host_identity_verified",
    "has_availability",
    "instant_bookable",
    "neighbourhood_cleansed",
    "host_location",
    "host_response_time",
]
MIXED_EXEMPT = ["property_type", "room_type", "source", "neighbourhood_cleansed", "host_location"]
DATE_SHAPE = r"^(\d{2}-\d{2}-\d{4}|\d{4}-\d{2}-\d{2})$"


def has_few_values(df: DataFrame, columns: Sequence[str], limit: int) -> set[str]:
    """The columns with fewer than ``limit`` distinct present values; exact, and no cell of the others is shuffled.

    One scan marks each value's place in a bitmap of 64; ``limit`` marks prove as many values. Only columns with
    fewer marks, which have few values, are then counted value by value. One row passes the driver.
    """
    columns = list(columns)
    if not columns:
        return set()
    if limit > 64:
        raise ValueError("a bitmap proves 64 values at most")

    def place(c: str) -> Column:
        bit = F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(64)).cast("int")
        return F.when(~is_missing(df, c), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))

    marks = df.agg(*[F.bit_count(F.bit_or(place(c))).alias(c) for c in columns]).first()
    open_ = [c for c in columns if (marks[c] or 0) < limit]
    if not open_:
        return set()
    values = cells(df.select(*open_)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("c"))
    more = values.groupBy("column").agg(F.count("*").alias("n")).where(F.col("n") >= limit)
    return set(open_) - {r["column"] for r in more.collect()}


#: Rows looked at first for the values that a column begins with, and how many of them are reported or judged.
EARLY_ROWS = 1_000
SAMPLES, HEAD = 3, 10


def column_facts(df: DataFrame, key: str) -> DataFrame:
    """One row of facts per column, enough to decide type, mixture and samples.

    Facts are one aggregate over the cells; distinct values are counted by two 64-bit hashes, so texts are not
    shuffled. What a column begins with comes from the first rows by ``key``; a column that shows too
    little there (sparse, or nearly constant) is looked up whole.
    """
    names = _without(df, key)
    kinds = {c: "number" if is_numeric(df, c) else "text" if is_text(df, c) else "other" for c in names}
    long = cells(df, key).where(F.col("value").isNotNull())
    value = F.col("value")
    facts = long.groupBy("column").agg(
        F.count("*").alias("non_null_count"),
        F.avg(F.length(value)).alias("mean_length"),
        F.bool_or(value.rlike(f"^{SPACE}*[$€£]") | value.contains("%")).alias("has_mark"),
        F.bool_or(value.rlike(r"\p{Nd}")).alias("has_digit"),
        F.bool_or(value.rlike(r"[a-zA-Z]")).alias("has_letter"),
        F.bool_or(F.lower(value).contains("half")).alias("has_half"),
    )
    hashed = long.select("column", F.xxhash64("value").alias("a"), F.xxhash64(F.lit(1), "value").alias("b")).distinct()
    facts = settle(facts.join(hashed.groupBy("column").agg(F.count("*").alias("unique_count")), "column"))  # one row per column
    counted = {r["column"]: r for r in facts.select("column", "non_null_count", "unique_count").collect()}

    early = settle(cells(df.orderBy(key).limit(EARLY_ROWS), key).where(F.col("value").isNotNull()))
    seen = {r["column"]: r for r in early.groupBy("column").agg(F.count("*").alias("n"), F.count_distinct("value").alias("d")).collect()}

    def short(number: str, enough: int, of: str) -> list[str]:
        """Columns whose early rows show too little of what they hold."""
        found = {c: seen[c][number] if c in seen else 0 for c in counted}
        return [c for c in counted if found[c] < min(enough, counted[c][of])]

    texts = [c for c in short("n", HEAD, "non_null_count") if kinds[c] == "text"]
    judged = early.where(~F.col("column").isin(texts))
    if texts:
        judged = judged.unionByName(cells(df.select(key, *texts), key).where(F.col("value").isNotNull()))
    by_key = Window.partitionBy("column").orderBy(key)
    head = judged.withColumn("rn", F.row_number().over(by_key)).where(F.col("rn") <= HEAD)
    head = head.groupBy("column").agg(F.bool_and(strip(F.col("value")).rlike("^https?://")).alias("head_is_url"))

    rare = short("d", SAMPLES, "unique_count")
    known = early.where(~F.col("column").isin(rare)).groupBy("column", "value").agg(F.min(key).alias("at"))
    ranked = known.withColumn("rn", F.row_number().over(Window.partitionBy("column").orderBy("at")))
    sample = ranked.groupBy("column").agg(*[F.max(F.when(F.col("rn") == i, F.col("value"))).alias(f"sample_{i}") for i in (1, 2, 3)])
    if rare:
        sample = sample.unionByName(_first_samples(df, key, rare))
    sample = sample.withColumn("first_value", strip(F.col("sample_1")))
    # The tables have one row per column; the frame of names keeps columns without values.
    base = df.agg(F.count("*").alias("total_rows")).select(
        "total_rows", F.explode(F.array(*[F.lit(c) for c in names])).alias("column")
    )
    types = {c: df.schema[c].dataType.simpleString() for c in names}
    out = base
    for part in (facts, head, sample):
        out = out.join(F.broadcast(part), "column", "left")
    return out.withColumns(
        {
            "dtype": _lookup(types, F.col("column")),
            "kind": _lookup(kinds, F.col("column")),
            "non_null_count": F.coalesce("non_null_count", F.lit(0)),
            "unique_count": F.coalesce("unique_count", F.lit(0)),
        }
    )


def _first_samples(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Three values by first appearance: each the earliest value that differs from those before it."""
    long = cells(df.select(key, *columns), key).where(F.col("value").isNotNull())
    found = settle(long.groupBy("column").agg(F.min_by("value", key).alias("sample_1")))
    for i in (2, 3):
        known = [F.coalesce(F.col("value") == F.col(f"sample_{j}"), F.lit(False)) for j in range(1, i)]
        rest = long.join(F.broadcast(found), "column").where(~reduce(lambda a, b: a | b, known))  # one row per column
        following = rest.groupBy("column").agg(F.min_by("value", key).alias(f"sample_{i}"))
        found = settle(found.join(F.broadcast(following), "column", "left"))
    return found


def semantic_type() -> Column:
    """Decision list over the columns of :func:`column_facts`; first match wins."""
    name = F.lower("column")
    text = (F.col("kind") == "text") & (F.col("non_null_count") > 0)
    dated = (
        reduce(lambda a, b: a | b, [name.contains(w) for w in DATE_WORDS])
        | name.endswith("_date")
        | name.startswith("date_")
    )
    return (
        F.when((name == "id") | name.endswith("_id"), "ID")
        .when(name.contains("url"), "URL")
        .when(text & F.col("head_is_url"), "URL")
        .when(reduce(lambda a, b: a | b, [name.startswith(p) for p in NUMERIC_PREFIXES]), "numeric")
        .when(dated, "date")
        .when(text & F.col("first_value").rlike(DATE_SHAPE), "date")
        .when(name.isin(TEXT_NUMERIC), "numeric")
        .when(F.col("kind") == "number", "numeric")
        .when(name.isin(FREE_TEXT), "free text")
        .when(F.col("non_null_count") == 0, "free text")
        .when(F.col("mean_length") > 60, "free text")
        .when((F.col("unique_count") <= 100) | name.endswith("_type") | name.isin(CATEGORICAL), "categorical")
        .otherwise("free text")
    )


def mixed_type(semantic: Column) -> Column:
    """Numbers kept inside text, by the facts of the column."""
    name = F.lower("column")
    mixture = (F.col("has_digit") & F.col("has_letter")) | F.col("has_half")
    return (
        F.when(name.isin(TEXT_NUMERIC), True)
        .when(F.col("non_null_count") == 0, False)
        .when(semantic.isin("URL", "ID", "free text"), False)
        .when(F.col("has_mark"), True)
        .when(
            semantic.isin("categorical", "numeric") & ~name.isin(MIXED_EXEMPT) & (F.col("kind") == "text"),
            mixture,
        )
        .otherwise(False)
    )


def metadata_report(df: DataFrame, key: str) -> DataFrame:
    """Per column: type, meaning, mixture flag, counts and three first values."""
    typed = column_facts(df, key).withColumn("semantic_type", semantic_type())
    return typed.select(
        "column",
        "dtype",
        "semantic_type",
        mixed_type(F.col("semantic_type")).alias("is_mixed_type"),
        "total_rows",
        "non_null_count",
        (F.col("total_rows") - F.col("non_null_count")).alias("null_count"),
        "unique_count",
        "sample_1",
        "sample_2",
        "sample_3",
    )
