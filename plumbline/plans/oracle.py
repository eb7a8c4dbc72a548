"""SQL equivalents of the registered queries, for a checking database.

Written from the definition of each operator, not from its Spark plan.
"""

from __future__ import annotations

from plumbline.operators.listfields import CATEGORIES
from plumbline.operators.profile import (
    CATEGORICAL,
    DATE_WORDS,
    FREE_TEXT,
    MIXED_EXEMPT,
    NUMERIC_PREFIXES,
    TEXT_NUMERIC,
)
from plumbline.operators.rules import BOUNDING_BOX, DISTRICTS
from plumbline.operators.schema import BATHROOM_FORMAT, KEY_COLUMN_SPECS, KEY_COLUMNS, PRICE_FORMAT, ROOM_TYPES
from plumbline.operators.suspicious import PII_COLUMNS, PII_PATTERNS, REQUIRED_PII
from plumbline.operators.textquality import GENUINE, MISSING, NEAR_EMPTY, PLACEHOLDER, PLACEHOLDER_PATTERN, SINGLE_WORDS
from plumbline.sources.derived import LISTING_COLUMNS, host_profiles_sql, listings_sql

ORACLE_SQL: dict[str, str] = {}

LISTINGS = f"WITH listings AS ({listings_sql()})"
PROFILES = f"WITH profiles AS ({host_profiles_sql()})"
COLUMNS = [c for c in LISTING_COLUMNS if c != "row_id"]
BIGINTS = [
    "id",
    "host_id",
    "minimum_nights",
    "maximum_nights",
    "availability_365",
    "number_of_reviews",
    "accommodates",
    "hosts_time_as_host_years",
    "hosts_time_as_host_months",
]
DOUBLES = ["latitude", "longitude", "bathrooms", "bedrooms", "beds", "review_scores_rating"]
DTYPES = {c: "bigint" if c in BIGINTS else "double" if c in DOUBLES else "string" for c in COLUMNS}


def texts(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def union(parts) -> str:
    return " UNION ALL ".join(parts)


PRICE = "TRY_CAST(trim(regexp_replace(price, '[$,]', '', 'g')) AS DOUBLE)"
PCT = "round(CAST({0} AS DOUBLE) / {1} * 100.0, {2})"


def pct(part: str, whole: str, digits: int) -> str:
    return PCT.format(part, whole, digits)


# Profiles

ORACLE_SQL["dataset_summary"] = (
    f"{LISTINGS}, g AS (SELECT count(*) AS c FROM listings GROUP BY {', '.join(COLUMNS)}) "
    f"SELECT CAST(sum(c) AS BIGINT) AS total_rows, CAST({len(COLUMNS)} AS BIGINT) AS total_columns, "
    f"CAST(sum(c - 1) AS BIGINT) AS duplicate_rows, {pct('sum(c - 1)', 'sum(c)', 4)} AS duplicate_pct FROM g"
)


def profile_sql(source: str, dtypes: dict[str, str], prefix: str = "") -> str:
    return prefix + union(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS total_rows, count({c}) AS non_null_count, "
        f"count(*) - count({c}) AS missing_count, {pct(f'(count(*) - count({c}))', 'count(*)', 4)} AS missing_pct, "
        f"count(DISTINCT {c}) AS unique_count FROM {source}"
        for c, t in dtypes.items()
    )


ORACLE_SQL["column_profile"] = profile_sql(
    "orders",
    {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
)
ORACLE_SQL["column_profile_listings"] = profile_sql("listings", DTYPES, LISTINGS + " ")

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORACLE_SQL["distribution_stats"] = union(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
    f"round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem"
    for c in LINE_NUMBERS
)
ORACLE_SQL["correlation_matrix"] = union(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in LINE_NUMBERS
    for b in LINE_NUMBERS
)
TRIANGLE = ["minimum_nights", "availability_365", "number_of_reviews"]
ORACLE_SQL["correlation_triangle"] = LISTINGS + " " + union(
    f"SELECT '{b}' AS col_a, '{a}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM listings"
    for i, a in enumerate(TRIANGLE)
    for b in TRIANGLE[i + 1 :]
)
ORACLE_SQL["missing_matrix"] = (
    f"{LISTINGS}, span AS (SELECT min(row_id) AS lo, max(row_id) AS hi FROM listings), "
    "placed AS (SELECT listings.*, least(CAST(floor((row_id - lo) / ((hi - lo + 1) / 20.0::DOUBLE)) AS BIGINT), 19) AS bucket "
    "FROM listings, span) "
    + union(
        f"SELECT bucket, '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS missing_count, "
        f"{pct(f'(count(*) - count({c}))', 'count(*)', 4)} AS missing_pct FROM placed GROUP BY bucket"
        for c in COLUMNS
    )
)
BOX = (
    "(SELECT count({c}) AS n, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
    "quantile_cont({c}, 0.75) AS q75 FROM listings)"
)
LOW, HIGH = "q25 - 1.5 * (q75 - q25)", "q75 + 1.5 * (q75 - q25)"
ORACLE_SQL["boxplot_stats"] = LISTINGS + " " + union(
    f"SELECT '{c}' AS \"column\", max(n) AS n, round(max(q25), 4) AS q25, round(max(q50), 4) AS q50, "
    f"round(max(q75), 4) AS q75, CAST(min(CASE WHEN {c} >= {LOW} THEN {c} END) AS DOUBLE) AS whisker_low, "
    f"CAST(max(CASE WHEN {c} <= {HIGH} THEN {c} END) AS DOUBLE) AS whisker_high, "
    f"count(CASE WHEN {c} < {LOW} OR {c} > {HIGH} THEN 1 END) AS flier_count, "
    f"CASE WHEN max({c}) > 365 THEN CAST(max({c}) AS DOUBLE) END AS annotated_max "
    f"FROM listings, {BOX.format(c=c)}"
    for c in ("minimum_nights", "availability_365")
)
ORACLE_SQL["boxplot_fliers"] = (
    f"{LISTINGS} SELECT row_id, CAST(minimum_nights AS DOUBLE) AS value "
    f"FROM listings, {BOX.format(c='minimum_nights')} WHERE minimum_nights < {LOW} OR minimum_nights > {HIGH}"
)

KIND = {"bigint": "number", "double": "number", "string": "text"}
CELLS = "cells AS (" + union(
    f"SELECT '{c}' AS col, '{DTYPES[c]}' AS dtype, '{KIND[DTYPES[c]]}' AS kind, row_id, "
    f"CAST({c} AS VARCHAR) AS v FROM listings"
    for c in COLUMNS
) + ")"
DATED = " OR ".join(f"contains(col, '{w}')" for w in DATE_WORDS)
PREFIXED = " OR ".join(f"starts_with(col, '{p}')" for p in NUMERIC_PREFIXES)
ORACLE_SQL["metadata_report"] = (
    f"{LISTINGS}, {CELLS}, "
    "facts AS (SELECT col, dtype, kind, count(*) AS total_rows, count(v) AS nn, count(DISTINCT v) AS nu, "
    "avg(length(v)) AS ml, bool_or(regexp_matches(trim(v), '^[$€£]') OR contains(v, '%')) AS mark, "
    "bool_or(regexp_matches(v, '[0-9]')) AS dig, bool_or(regexp_matches(v, '[a-zA-Z]')) AS let, "
    "bool_or(contains(lower(v), 'half')) AS half FROM cells GROUP BY col, dtype, kind), "
    "numbered AS (SELECT col, trim(v) AS v, row_number() OVER (PARTITION BY col ORDER BY row_id) AS rn "
    "FROM cells WHERE v IS NOT NULL), "
    "head AS (SELECT col, bool_and(regexp_matches(v, '^https?://')) AS urls, max(CASE WHEN rn = 1 THEN v END) AS fv "
    "FROM numbered WHERE rn <= 10 GROUP BY col), "
    "firsts AS (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY min(row_id)) AS rn FROM cells "
    "WHERE v IS NOT NULL GROUP BY col, v), "
    "samples AS (SELECT col, max(CASE WHEN rn = 1 THEN v END) AS s1, max(CASE WHEN rn = 2 THEN v END) AS s2, "
    "max(CASE WHEN rn = 3 THEN v END) AS s3 FROM firsts GROUP BY col), "
    "typed AS (SELECT *, CASE WHEN col = 'id' OR ends_with(col, '_id') THEN 'ID' WHEN contains(col, 'url') THEN 'URL' "
    "WHEN kind = 'text' AND nn > 0 AND urls THEN 'URL' "
    f"WHEN {PREFIXED} THEN 'numeric' "
    f"WHEN {DATED} OR ends_with(col, '_date') OR starts_with(col, 'date_') THEN 'date' "
    r"WHEN kind = 'text' AND nn > 0 AND regexp_matches(fv, '^([0-9]{2}-[0-9]{2}-[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})$') "
    "THEN 'date' "
    f"WHEN col IN ({texts(TEXT_NUMERIC)}) THEN 'numeric' WHEN kind = 'number' THEN 'numeric' "
    f"WHEN col IN ({texts(FREE_TEXT)}) THEN 'free text' WHEN nn = 0 THEN 'free text' WHEN ml > 60 THEN 'free text' "
    f"WHEN nu <= 100 OR ends_with(col, '_type') OR col IN ({texts(CATEGORICAL)}) THEN 'categorical' "
    "ELSE 'free text' END AS sem FROM facts LEFT JOIN head USING (col) LEFT JOIN samples USING (col)) "
    'SELECT col AS "column", dtype, sem AS semantic_type, '
    f"CASE WHEN col IN ({texts(TEXT_NUMERIC)}) THEN true WHEN nn = 0 THEN false "
    "WHEN sem IN ('URL', 'ID', 'free text') THEN false WHEN mark THEN true "
    f"WHEN sem IN ('categorical', 'numeric') AND col NOT IN ({texts(MIXED_EXEMPT)}) AND kind = 'text' "
    "THEN (dig AND let) OR half ELSE false END AS is_mixed_type, total_rows, nn AS non_null_count, "
    "total_rows - nn AS null_count, nu AS unique_count, s1 AS sample_1, s2 AS sample_2, s3 AS sample_3 FROM typed"
)


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, float)):
        return f"CAST({value} AS DOUBLE)"
    if isinstance(value, list):
        return texts(["|".join(value)])
    return texts([value])


def schema_line(c: str) -> str:
    if c in KEY_COLUMN_SPECS:
        dtype, semantic, nullable, unique, low, high, allowed, pattern = KEY_COLUMN_SPECS[c]
        return (
            f"SELECT '{c}' AS \"column\", '{dtype}' AS expected_dtype, '{semantic}' AS semantic_type, "
            f"{literal(nullable)} AS is_nullable, {literal(bool(unique))} AS is_unique, "
            f"CAST({literal(low)} AS DOUBLE) AS min_value, CAST({literal(high)} AS DOUBLE) AS max_value, "
            f"CAST({literal(allowed)} AS VARCHAR) AS allowed_values, CAST({literal(pattern)} AS VARCHAR) AS format_pattern, "
            "true AS is_key_column"
        )
    kind = {"bigint": ("integer", "numeric"), "double": ("float", "numeric")}.get(DTYPES[c])
    few = f"count(DISTINCT {c}) < 10 AND count({c}) = count(*)"
    dtype = f"'{kind[0]}'" if kind else f"CASE WHEN {few} THEN 'categorical' ELSE 'string' END"
    semantic = f"'{kind[1]}'" if kind else f"CASE WHEN {few} THEN 'categorical' ELSE 'free text' END"
    return (
        f"SELECT '{c}', {dtype}, {semantic}, count({c}) < count(*), false, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
        f"CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), false FROM listings"
    )


ORACLE_SQL["inferred_schema"] = LISTINGS + " " + union(
    schema_line(c) for c in sorted(COLUMNS, key=lambda c: c not in KEY_COLUMN_SPECS)
)


def bounds_line(c: str) -> str:
    if DTYPES[c] != "string":
        name = "integer" if DTYPES[c] == "bigint" else "float"
        return (
            f"SELECT '{c}' AS \"column\", '{name}' AS observed_dtype, CAST(min({c}) AS DOUBLE) AS min_value, "
            f"CAST(max({c}) AS DOUBLE) AS max_value FROM listings"
        )
    shape = r"'^[0-9]{2}-[0-9]{2}-[0-9]{4}$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"
    number = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"
    every = "count(*) > 0 AND count(*) = count(CASE WHEN {0} THEN 1 END)"
    return (
        f"SELECT '{c}', CASE WHEN {every.format(f'''lower(trim({c})) IN ('t', 'f', 'true', 'false')''')} THEN 'boolean' "
        f"WHEN {every.format(f'''regexp_matches(trim({c}), '^[+-]?[0-9]+$')''')} THEN 'integer' "
        f"WHEN {every.format(f'regexp_matches(trim({c}), {number})')} THEN 'float' "
        f"WHEN {every.format(f'regexp_matches(trim({c}), {shape})')} THEN 'datetime' ELSE 'string' END, "
        f"CASE WHEN {every.format(f'regexp_matches(trim({c}), {number})')} THEN min(TRY_CAST({c} AS DOUBLE)) END, "
        f"CASE WHEN {every.format(f'regexp_matches(trim({c}), {number})')} THEN max(TRY_CAST({c} AS DOUBLE)) END "
        f"FROM listings WHERE {c} IS NOT NULL"
    )


ORACLE_SQL["observed_bounds"] = LISTINGS + " " + union(bounds_line(c) for c in COLUMNS)

# Suspicious columns and rows

ORACLE_SQL["pii_profile"] = LISTINGS + " " + union(
    f"SELECT '{c}' AS \"column\", '{PII_COLUMNS[c]}' AS category, {literal(c in REQUIRED_PII)} AS required, "
    f"count({c}) AS non_null_count, count(DISTINCT {c}) AS unique_count FROM listings"
    for c in COLUMNS
    if c in PII_COLUMNS
)
ORACLE_SQL["pii_scan"] = union(
    f"SELECT 'text' AS \"column\", '{kind}' AS kind, count(CASE WHEN n > 0 THEN 1 END) AS rows_with_match, "
    f"CAST(coalesce(sum(n), 0) AS BIGINT) AS matches FROM (SELECT len(regexp_extract_all(text, '{p}')) AS n FROM documents)"
    for kind, p in PII_PATTERNS.items()
)
BATH_CLASS = (
    "CASE WHEN bathrooms_text IS NULL THEN 'null' WHEN contains(lower(bathrooms_text), 'half') THEN 'half_bath_text' "
    "WHEN regexp_matches(lower(bathrooms_text), 'shared|private') THEN 'shared_or_private_text' "
    r"WHEN regexp_matches(lower(trim(bathrooms_text)), '^[0-9]+(\.[0-9]+)?\s+(bath|baths)$') THEN 'standard_numeric_bath' "
    "ELSE 'other_unclassified' END"
)
ORACLE_SQL["format_classes"] = (
    f"{LISTINGS}, classes AS (SELECT unnest(['half_bath_text', 'shared_or_private_text', 'standard_numeric_bath', "
    "'other_unclassified', 'null']) AS class), "
    f"found AS (SELECT {BATH_CLASS} AS class, count(*) AS n, count(DISTINCT bathrooms_text) AS d FROM listings GROUP BY 1) "
    "SELECT class, coalesce(n, 0) AS row_count, coalesce(d, 0) AS distinct_values FROM classes LEFT JOIN found USING (class)"
)
ORACLE_SQL["format_samples"] = (
    f"{LISTINGS} SELECT trim(bathrooms_text) AS value, min(row_id) AS first_key FROM listings "
    "WHERE bathrooms_text IS NOT NULL GROUP BY 1 ORDER BY 2 LIMIT 10"
)
ZERO = "(trim(price) IN ('$0.00', '$0', '0', '0.0', '$0.0') OR trim(regexp_replace(price, '[$,]', '', 'g')) = '0.00')"
FLAGS = {"zero_price_rows": ZERO, "extreme_minimum_nights": "minimum_nights > 365"}
ORACLE_SQL["suspicious_rows"] = LISTINGS + " " + union(
    f"SELECT '{f}' AS flag, count(CASE WHEN {p} THEN 1 END) > 0 AS flagged, count(CASE WHEN {p} THEN 1 END) AS row_count, "
    f"{pct(f'count(CASE WHEN {p} THEN 1 END)', 'count(*)', 4)} AS pct FROM listings"
    for f, p in FLAGS.items()
)
ORACLE_SQL["suspicious_samples"] = LISTINGS + " SELECT * FROM (" + union(
    f"SELECT '{f}' AS flag, row_id, CAST(row_number() OVER (ORDER BY row_id) AS INTEGER) AS rank FROM listings WHERE {p}"
    for f, p in FLAGS.items()
) + ") WHERE rank <= 10"

# Duplicates

ALL = ", ".join(COLUMNS)
ORACLE_SQL["exact_duplicates"] = (
    f"{LISTINGS} SELECT row_id, retained_key FROM (SELECT row_id, min(row_id) OVER (PARTITION BY {ALL}) AS retained_key "
    "FROM listings) WHERE row_id <> retained_key"
)
ORACLE_SQL["exact_duplicates_events"] = " UNION ALL ".join(
    f"SELECT event_id, retained_key FROM (SELECT event_id, min(event_id) OVER (PARTITION BY {keys}) AS retained_key FROM events) "
    "WHERE event_id <> retained_key"
    for keys in ("ts, user_id, event_type", "date_trunc('minute', ts), event_type")
)
ORACLE_SQL["key_first"] = (
    f"{LISTINGS} SELECT row_id, id FROM listings QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1"
)
BLOCKED = (
    "blocked AS (SELECT *, host_id AS block_host, round_even(latitude, 4) AS block_lat, "
    "round_even(longitude, 4) AS block_lon, coalesce(trim(lower(name)), 'nan') AS cname FROM listings "
    "WHERE host_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL)"
)
ORACLE_SQL["block_summary"] = (
    f"{LISTINGS}, {BLOCKED} SELECT block_host, block_lat, block_lon, count(*) AS block_rows, "
    "count(DISTINCT cname) AS distinct_names, count(*) * (count(*) - 1) // 2 AS candidate_pairs "
    "FROM blocked GROUP BY 1, 2, 3"
)


def duplicates_sql(match: str) -> str:
    """Kept-first walk per block as a fold over ordered lists of entries."""
    return (
        f"{LISTINGS}, firsts AS (SELECT *, min(row_id) OVER (PARTITION BY {ALL}) AS fk FROM listings), "
        "full_copies AS (SELECT row_id AS removed_key, fk AS retained_key, 'exact_full_row' AS kind FROM firsts "
        "WHERE row_id <> fk), "
        "listings2 AS (SELECT * EXCLUDE (fk) FROM firsts WHERE row_id = fk), "
        f"{BLOCKED.replace('FROM listings', 'FROM listings2')}, "
        "blocks AS (SELECT block_host, block_lat, block_lon, "
        "list([{'ord': row_id, 'id': id, 'cname': cname}] ORDER BY row_id) AS rows FROM blocked GROUP BY 1, 2, 3), "
        "kept AS (SELECT block_host, block_lat, block_lon, rows, list_reduce(rows, lambda acc, x: "
        f"CASE WHEN len(list_filter(acc, lambda k: {match.format(k='k', x='x[1]')})) > 0 THEN acc "
        "ELSE list_concat(acc, x) END) AS kept FROM blocks), "
        "walked AS (SELECT unnest(rows)[1] AS x, kept FROM kept), "
        "judged AS (SELECT x, list_filter(kept, lambda k: k.ord < x.ord AND "
        f"({match.format(k='k', x='x')})) AS hits, list_contains(list_transform(kept, lambda k: k.ord), x.ord) AS stays "
        "FROM walked) "
        "SELECT * FROM full_copies UNION ALL SELECT x.ord, hits[1].ord, "
        "CASE WHEN hits[1].id = x.id OR hits[1].cname = x.cname THEN 'exact' ELSE 'fuzzy' END FROM judged WHERE NOT stays"
    )


EXACT_MATCH = "{k}.id = {x}.id OR {k}.cname = {x}.cname"
EDIT_MATCH = (
    EXACT_MATCH + " OR 1 - CAST(levenshtein({k}.cname, {x}.cname) AS DOUBLE) / "
    "greatest(length({k}.cname), length({x}.cname), 1) >= 0.9"
)
ORACLE_SQL["duplicates_by_id_or_name"] = duplicates_sql(EXACT_MATCH)
ORACLE_SQL["duplicates_by_edit_distance"] = duplicates_sql(EDIT_MATCH)
# TF-IDF over the distinct names of all rows in blocks, as one vector per name.
TERM_VECTORS = (
    "names AS (SELECT DISTINCT cname FROM blocked0), total AS (SELECT count(*) AS n FROM names), "
    "terms AS (SELECT cname, term, count(*) AS tf FROM (SELECT cname, unnest(regexp_split_to_array(cname, '\\s+')) AS term "
    "FROM names) GROUP BY 1, 2), idf AS (SELECT term, ln((1.0 + n) / (1 + count(*))) + 1 AS idf FROM terms, total GROUP BY term, n), "
    "weighed AS (SELECT cname, term, tf * idf AS w FROM terms JOIN idf USING (term)), "
    "sizes AS (SELECT cname, sqrt(sum(w * w)) AS size FROM weighed GROUP BY 1), "
    "vectors AS (SELECT cname, list(coalesce(w, 0.0) / size ORDER BY term) AS v FROM (SELECT cname, size, term FROM sizes, idf) "
    "LEFT JOIN weighed USING (cname, term) GROUP BY cname)"
)
TERM_MATCH = EXACT_MATCH + " OR list_dot_product({k}.v, {x}.v) >= 0.8"
ORACLE_SQL["duplicates_by_terms"] = (
    duplicates_sql(TERM_MATCH)
    .replace("blocked AS (", "blocked0 AS (")
    .replace("blocks AS (", f"{TERM_VECTORS}, blocked AS (SELECT blocked0.*, v FROM blocked0 JOIN vectors USING (cname)), blocks AS (", 1)
    .replace("'cname': cname}", "'cname': cname, 'v': v}")
    .replace("'exact_full_row' AS kind FROM", "'exact_full_row' AS kind, 1.0::DOUBLE AS similarity FROM")
    .replace(
        "THEN 'exact' ELSE 'fuzzy' END FROM",
        "THEN 'exact' ELSE 'fuzzy' END, CASE WHEN hits[1].id = x.id OR hits[1].cname = x.cname THEN NULL "
        "ELSE round(list_dot_product(hits[1].v, x.v), 4) END FROM",
    )
)
KEPT_ROWS = (
    f"SELECT row_id, id FROM ({listings_sql()}) WHERE row_id NOT IN (SELECT removed_key FROM ({duplicates_sql(EXACT_MATCH)}))"
)
ORACLE_SQL["deduplicated_rows"] = KEPT_ROWS
# Seven columns are added by the imputation, the formats and the features.
ORACLE_SQL["cleaning_log"] = (
    f"SELECT (SELECT count(*) FROM ({listings_sql()})) AS rows_before, {len(COLUMNS)} AS columns_before, "
    f"count(DISTINCT id) AS rows_after, {len(COLUMNS) + 7} AS columns_after FROM ({KEPT_ROWS})"
)
ORACLE_SQL["duplicate_counts"] = (
    f"SELECT (SELECT count(*) FROM ({listings_sql()})) AS rows_before, "
    f"(SELECT count(*) FROM ({listings_sql()})) - count(*) AS rows_after, "
    "count(CASE WHEN kind <> 'fuzzy' THEN 1 END) AS exact_duplicates, "
    "count(CASE WHEN kind = 'fuzzy' THEN 1 END) AS fuzzy_duplicates, count(*) AS total_removed "
    f"FROM ({duplicates_sql(EXACT_MATCH)})"
)

# Missing cells


def mode_sql(column: str) -> str:
    return (
        f"(SELECT {column} FROM listings WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


ORACLE_SQL["impute_mode"] = (
    f"{LISTINGS} SELECT row_id, coalesce(neighbourhood_group_cleansed, {mode_sql('neighbourhood_group_cleansed')}, "
    f"{mode_sql('neighbourhood_cleansed')}, 'Unknown') AS neighbourhood_group_cleansed FROM listings"
)
ORACLE_SQL["impute_group_median"] = (
    f"{LISTINGS}, m AS (SELECT room_type AS rt, median(review_scores_rating) AS med FROM listings "
    "WHERE room_type IS NOT NULL GROUP BY 1) "
    "SELECT row_id, round(coalesce(review_scores_rating, med, (SELECT median(review_scores_rating) FROM listings)), 4) "
    "AS review_scores_rating_stat_imputed FROM listings LEFT JOIN m ON room_type = rt"
)


def constants_sql(function: str) -> str:
    return f"{LISTINGS}, n AS (SELECT row_id, {PRICE} AS price, beds, bedrooms FROM listings) SELECT row_id, " + ", ".join(
        f"round(coalesce({c}, (SELECT {function}({c}) FROM n)), 4) AS {c}" for c in ("price", "beds", "bedrooms")
    ) + " FROM n"


ORACLE_SQL["impute_median"] = constants_sql("median")
ORACLE_SQL["impute_mean"] = constants_sql("avg")
ORACLE_SQL["enforce_non_null"] = (
    # The specification calls price a number; currency text is no plain number.
    rf"{LISTINGS}, n AS (SELECT *, CASE WHEN regexp_matches(trim(price), '^[+-]?[0-9.]+$') "
    "THEN TRY_CAST(price AS DOUBLE) END AS p FROM listings) "
    "SELECT row_id, coalesce(p, (SELECT median(p) FROM n), 0.0) AS price, "
    "coalesce(CAST(minimum_nights AS DOUBLE), (SELECT median(minimum_nights) FROM n)) AS minimum_nights, "
    f"coalesce(room_type, {mode_sql('room_type')}) AS room_type, "
    "coalesce(latitude, (SELECT median(latitude) FROM n)) AS latitude, review_scores_rating FROM n"
)
FILLED = ["price", "beds", "bedrooms"]
ORACLE_SQL["missing_summary"] = LISTINGS + " " + union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_before, "
    f"{'CAST(0 AS BIGINT)' if c in FILLED else f'count(*) - count({c})'} AS missing_after FROM listings"
    for c in COLUMNS
)
NUMBERS = ["balance", "orders_count", "mean_price", "top_price", "nation"]
SQUARES = " + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0.0)" for c in NUMBERS)
SHARED = " + ".join(f"CASE WHEN a.{c} IS NOT NULL AND b.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in NUMBERS)
ORACLE_SQL["impute_knn"] = (
    f"{PROFILES}, d AS (SELECT a.host_id AS key, b.host_id AS other, "
    f"sqrt(({SQUARES}) * (CAST({len(NUMBERS)} AS DOUBLE) / ({SHARED}))) AS distance, "
    + ", ".join(f"a.{c} AS a_{c}, b.{c} AS b_{c}" for c in NUMBERS)
    + " FROM profiles a JOIN profiles b ON a.host_id <> b.host_id), ranked AS ("
    + union(
        f"SELECT key, '{c}' AS target, b_{c} AS value, row_number() OVER (PARTITION BY key ORDER BY distance, other) AS rn "
        f"FROM d WHERE a_{c} IS NULL AND b_{c} IS NOT NULL"
        for c in NUMBERS[:3]
    )
    + ") SELECT key, target, round(avg(value), 4) AS fill FROM ranked WHERE rn <= 5 GROUP BY 1, 2"
)

# Formats and features

NORMAL_PRICE = (
    f"parsed AS (SELECT *, {PRICE} AS p FROM listings), "
    "rawfirst AS (SELECT id AS rid, p AS rp FROM parsed QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1), "
)
MEDIAN_PRICE = "(SELECT median(p) FROM {0} WHERE p > 0)"


def price_sql(source: str) -> str:
    return (
        f"(round_even(coalesce(CASE WHEN p > 0 THEN p END, CASE WHEN rp > 0 THEN rp END, {MEDIAN_PRICE.format(source)}, "
        f"{MEDIAN_PRICE.format('parsed')}, 100.0) * 100.0, 0) / 100.0)"
    )


ORACLE_SQL["normalize_price"] = (
    f"{LISTINGS}, {NORMAL_PRICE.rstrip(', ')} SELECT row_id, {price_sql('parsed')} AS price "
    "FROM parsed LEFT JOIN rawfirst ON id = rid"
)
T = "lower(trim(coalesce(bathrooms_text, '')))"
NUMBER = rf"regexp_extract({T}, '([0-9]+(\.[0-9]+)?)', 1)"
BATHROOMS = (
    f"CASE WHEN {NUMBER} <> '' THEN TRY_CAST({NUMBER} AS DOUBLE) WHEN contains({T}, 'half') THEN 0.5 "
    "WHEN bathrooms >= 0 THEN bathrooms ELSE 1.0 END"
)
BASE_KIND = f"CASE WHEN contains({T}, 'shared') THEN 'shared' WHEN contains({T}, 'private') THEN 'private' ELSE 'standard' END"
BATHROOM_KIND = (
    f"CASE WHEN NOT contains({T}, 'half') THEN {BASE_KIND} WHEN {BASE_KIND} = 'standard' THEN 'half' "
    f"ELSE {BASE_KIND} || '_half' END"
)
ORACLE_SQL["parse_quantity_text"] = (
    f"{LISTINGS} SELECT row_id, {BATHROOMS} AS bathrooms, {BATHROOM_KIND} AS bathroom_type FROM listings"
)
PLACE_UP = "CASE WHEN trim(neighbourhood_cleansed) <> '' THEN upper(trim(neighbourhood_cleansed)) ELSE 'UNKNOWN' END"
PLACE_SHOWN = (
    "CASE WHEN trim(neighbourhood_cleansed) <> '' THEN array_to_string(list_transform(string_split("
    "lower(trim(neighbourhood_cleansed)), ' '), lambda w: upper(w[1]) || w[2:]), ' ') ELSE 'Unknown' END"
)
ORACLE_SQL["standardize_places"] = (
    f"{LISTINGS} SELECT row_id, {PLACE_SHOWN} AS neighbourhood, {PLACE_UP} AS neighbourhood_cleansed FROM listings"
)
SEEN = "coalesce(CAST(try_strptime(last_scraped, '%d-%m-%Y') AS DATE), DATE '2026-06-16')"
DAYS = "CAST(floor(hosts_time_as_host_years * 365.25 + hosts_time_as_host_months * 30.4375) AS INTEGER)"
SINCE = (
    "coalesce(CAST(try_strptime(host_since, '%Y-%m-%d') AS DATE), "
    f"CASE WHEN hosts_time_as_host_years > 0 OR hosts_time_as_host_months > 0 THEN CAST({SEEN} - {DAYS} AS DATE) "
    f"ELSE coalesce(CAST(try_strptime(first_review, '%d-%m-%Y') AS DATE), CAST({SEEN} - 365 AS DATE)) END)"
)
ORACLE_SQL["parse_dates"] = (
    f"{LISTINGS} SELECT row_id, strftime({SEEN}, '%Y-%m-%d') AS last_scraped, strftime({SINCE}, '%Y-%m-%d') AS host_since "
    "FROM listings"
)
ROOM_CODE = "CASE room_type " + " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate(ROOM_TYPES)) + " ELSE 0 END"
ORACLE_SQL["encode_fixed"] = f"{LISTINGS} SELECT row_id, {ROOM_CODE} AS room_type_encoded FROM listings"
CODES = (
    "codes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM "
    "(SELECT DISTINCT coalesce(neighbourhood_group_cleansed, 'nan') AS label FROM {0}))"
)
ORACLE_SQL["encode_labels"] = (
    f"{LISTINGS}, {CODES.format('listings')} SELECT row_id, coalesce(code, 0) AS neighbourhood_group_cleansed_encoded "
    "FROM listings LEFT JOIN codes ON neighbourhood_group_cleansed = label"
)
TENURE = f"CAST(greatest(date_diff('day', {SINCE}, {SEEN}), 0) AS INTEGER)"
ORACLE_SQL["tenure_days"] = f"{LISTINGS} SELECT row_id, {TENURE} AS host_tenure_days FROM listings"


def unit_price_sql(price: str) -> str:
    return f"round_even({price} / greatest(coalesce(bedrooms, 1.0), 1.0) * 100.0, 0) / 100.0"


ORACLE_SQL["unit_price"] = (
    f"{LISTINGS}, {NORMAL_PRICE} normal AS (SELECT row_id, bedrooms, {price_sql('parsed')} AS np "
    f"FROM parsed LEFT JOIN rawfirst ON id = rid) SELECT row_id, {unit_price_sql('np')} AS price_per_bedroom FROM normal"
)
CLEANED = (
    f"{NORMAL_PRICE} uniq AS (SELECT * FROM parsed QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id) = 1), "
    f"{CODES.format('uniq')}, "
    f"cleaned AS (SELECT * REPLACE ({price_sql('uniq')} AS price, {BATHROOMS} AS bathrooms, "
    f"{PLACE_UP} AS neighbourhood_cleansed, strftime({SEEN}, '%Y-%m-%d') AS last_scraped, "
    f"strftime({SINCE}, '%Y-%m-%d') AS host_since), {BATHROOM_KIND} AS bathroom_type, {PLACE_SHOWN} AS neighbourhood, "
    f"{ROOM_CODE} AS room_type_encoded, coalesce(code, 0) AS neighbourhood_group_cleansed_encoded, "
    f"{TENURE} AS host_tenure_days, {unit_price_sql(price_sql('uniq'))} AS price_per_bedroom "
    "FROM uniq LEFT JOIN rawfirst ON id = rid LEFT JOIN codes ON neighbourhood_group_cleansed = label)"
)
ORACLE_SQL["clean_table"] = (
    f"{LISTINGS}, {CLEANED} SELECT row_id, id, price, bathrooms, bathroom_type, neighbourhood, neighbourhood_cleansed, "
    "last_scraped, host_since, room_type_encoded, neighbourhood_group_cleansed_encoded, host_tenure_days, "
    "price_per_bedroom FROM cleaned"
)

# Quality score


def quality_ctes(name: str, source: str, columns: list[str], price: str, price_is_number: bool) -> str:
    n = "count(*)"
    cells = " + ".join(f"count({c})" for c in columns)
    keys = " + ".join(f"count({c})" for c in KEY_COLUMNS if c in columns)
    shape = "100.0" if price_is_number else (
        f"coalesce({pct(f'''count(CASE WHEN regexp_matches(trim(price), '{PRICE_FORMAT}') THEN 1 END)''', 'count(price)', 2)}, 100.0)"
    )

    def inside(value: str, low: int, high: int) -> str:
        return pct(f"count(CASE WHEN {value} BETWEEN {low} AND {high} THEN 1 END)", f"count({value})", 2)

    metrics = {
        "overall_cell_completeness_pct": pct(f"({cells})", f"({n} * {len(columns)})", 2),
        "key_columns_completeness_pct": pct(f"({keys})", f"({n} * {len(KEY_COLUMNS)})", 2),
        "id_uniqueness_pct": pct("count(DISTINCT id)", n, 2),
        "price_format_consistency_pct": shape,
        "bathrooms_format_consistency_pct": "CASE WHEN count(bathrooms) > 0 THEN 100.0 ELSE 0.0 END",
        "min_max_nights_logic_pct": pct(
            "count(CASE WHEN minimum_nights <= maximum_nights THEN 1 END)",
            "count(CASE WHEN minimum_nights IS NOT NULL AND maximum_nights IS NOT NULL THEN 1 END)",
            2,
        ),
        "price_validity_pct": pct(f"count(CASE WHEN {price} >= 0 THEN 1 END)", f"count({price})", 2),
        "minimum_nights_validity_pct": inside("minimum_nights", 1, 365),
        "availability_365_validity_pct": inside("availability_365", 0, 365),
        "room_type_validity_pct": pct(f"count(CASE WHEN room_type IN ({texts(ROOM_TYPES)}) THEN 1 END)", n, 2),
        "geo_coordinates_validity_pct": pct(
            "(count(CASE WHEN latitude BETWEEN -90 AND 90 THEN 1 END) + "
            "count(CASE WHEN longitude BETWEEN -180 AND 180 THEN 1 END))",
            f"({n} * 2)",
            2,
        ),
    }
    names = list(metrics)

    def mean(parts: list[str]) -> str:
        return f"round(({' + '.join(parts)}) / {len(parts)}, 2)"

    return (
        f"{name}_m AS (SELECT " + ", ".join(f"{e} AS {m}" for m, e in metrics.items()) + f" FROM {source}), "
        f"{name}_s AS (SELECT *, {mean(names[:2])} AS completeness_score, {mean(names[2:6])} AS consistency_score, "
        f"{mean(names[6:])} AS validity_score FROM {name}_m), "
        f"{name}_t AS (SELECT *, {mean(['completeness_score', 'consistency_score', 'validity_score'])} "
        f"AS overall_quality_score FROM {name}_s), "
        f"{name} AS (SELECT metric, CAST(score AS DOUBLE) AS score FROM (SELECT "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SCORE_NAMES)
        + f" FROM {name}_t) UNPIVOT (score FOR metric IN ({', '.join(SCORE_NAMES)})))"
    )


SCORE_NAMES = [
    "overall_cell_completeness_pct",
    "key_columns_completeness_pct",
    "id_uniqueness_pct",
    "price_format_consistency_pct",
    "bathrooms_format_consistency_pct",
    "min_max_nights_logic_pct",
    "price_validity_pct",
    "minimum_nights_validity_pct",
    "availability_365_validity_pct",
    "room_type_validity_pct",
    "geo_coordinates_validity_pct",
    "completeness_score",
    "consistency_score",
    "validity_score",
    "overall_quality_score",
]
CLEAN_COLUMNS = [
    *COLUMNS,
    "bathroom_type",
    "neighbourhood",
    "room_type_encoded",
    "neighbourhood_group_cleansed_encoded",
    "host_tenure_days",
    "price_per_bedroom",
]
ORACLE_SQL["quality_score"] = (
    f"{LISTINGS}, {quality_ctes('q', 'listings', COLUMNS, PRICE, False)} SELECT metric, score FROM q"
)
ORACLE_SQL["missing_gaps"] = LISTINGS + " SELECT * FROM (" + union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
    f"{pct(f'(count(*) - count({c}))', 'count(*)', 2)} AS missing_pct FROM listings"
    for c in COLUMNS
) + ") WHERE missing_count > 0"
ORACLE_SQL["quality_delta"] = (
    f"{LISTINGS}, {CLEANED}, {quality_ctes('b', 'listings', COLUMNS, PRICE, False)}, "
    f"{quality_ctes('a', 'cleaned', CLEAN_COLUMNS, 'price', True)} "
    "SELECT metric, b.score AS before_score, a.score AS after_score, round(a.score - b.score, 2) AS delta, "
    "CASE WHEN round(a.score - b.score, 2) > 0 THEN 'MEASURABLE_IMPROVEMENT_PASSED' ELSE 'NO_IMPROVEMENT' END AS verdict "
    "FROM b JOIN a USING (metric)"
)

# Rules and errors


def shown(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'null')"


BOUNDED = (
    f"latitude BETWEEN {BOUNDING_BOX['min_lat']} AND {BOUNDING_BOX['max_lat']} "
    f"AND longitude BETWEEN {BOUNDING_BOX['min_lon']} AND {BOUNDING_BOX['max_lon']}"
)
# rule id -> name, category, severity, columns, condition that holds, shown value
RULES = {
    "R001": ("price_greater_than_zero", "numeric_range", "CRITICAL", "price", f"{PRICE} > 0", shown("price")),
    "R002": (
        "minimum_nights_in_range",
        "numeric_range",
        "HIGH",
        "minimum_nights",
        "minimum_nights BETWEEN 1 AND 365",
        shown("minimum_nights"),
    ),
    "R003": (
        "availability_365_in_range",
        "numeric_range",
        "HIGH",
        "availability_365",
        "availability_365 BETWEEN 0 AND 365",
        shown("availability_365"),
    ),
    "R004": (
        "room_type_valid",
        "categorical_consistency",
        "HIGH",
        "room_type",
        f"trim(room_type) IN ({texts(ROOM_TYPES)})",
        shown("room_type"),
    ),
    "R005": (
        "neighbourhood_group_valid",
        "categorical_consistency",
        "HIGH",
        "neighbourhood_group_cleansed",
        f"upper(trim(neighbourhood_group_cleansed)) IN ({texts(DISTRICTS)})",
        shown("neighbourhood_group_cleansed"),
    ),
    "R006": (
        "coordinate_bounding_box",
        "coordinate_sanity",
        "CRITICAL",
        "latitude,longitude",
        BOUNDED,
        f"'(' || {shown('latitude')} || ', ' || {shown('longitude')} || ')'",
    ),
    "R007": (
        "min_nights_le_max_nights",
        "cross_field_consistency",
        "CRITICAL",
        "minimum_nights,maximum_nights",
        "minimum_nights <= maximum_nights",
        f"'minimum_nights=' || {shown('minimum_nights')} || ', maximum_nights=' || {shown('maximum_nights')}",
    ),
}
RATE = (
    "response_rate_in_range",
    "numeric_range",
    "HIGH",
    "host_response_rate",
    "host_response_rate IS NULL OR TRY_CAST(replace(host_response_rate, '%', '') AS DOUBLE) BETWEEN 0 AND 100",
    shown("host_response_rate"),
)
VIOLATIONS = "violations AS (" + union(
    f"SELECT row_id, CAST(id AS VARCHAR) AS listing_id, '{i}' AS rule_id, '{r[0]}' AS rule_name, '{r[2]}' AS severity, "
    f"'{r[3]}' AS \"column\", {r[5]} AS value FROM listings WHERE NOT coalesce({r[4]}, false)"
    for i, r in RULES.items()
) + ")"
ORACLE_SQL["rule_violations"] = f"{LISTINGS}, {VIOLATIONS} SELECT * FROM violations"


def summary_sql(rules: dict, source: str) -> str:
    return union(
        f"SELECT '{i}' AS rule_id, '{r[0]}' AS rule_name, '{r[1]}' AS rule_category, "
        f"count(CASE WHEN NOT coalesce({r[4]}, false) THEN 1 END) AS violation_count, "
        f"{pct(f'count(CASE WHEN NOT coalesce({r[4]}, false) THEN 1 END)', 'count(*)', 2)} AS violation_pct FROM {source}"
        for i, r in rules.items()
    )


ORACLE_SQL["rule_summary"] = f"{LISTINGS} {summary_sql(RULES | {'R008': RATE}, 'listings')}"
ORACLE_SQL["custom_rules"] = summary_sql(
    {
        "C1": ("discount_small", "numeric_range", "", "", "l_discount <= 0.05"),
        "C2": ("tax_below_discount", "cross_field", "", "", "l_tax < l_discount"),
        "C3": ("flag_known", "categorical", "", "", "l_returnflag IN ('A', 'N')"),
    },
    "lineitem",
)
ORACLE_SQL["unknown_members"] = (
    f"{LISTINGS} SELECT row_id, neighbourhood_group_cleansed FROM listings a WHERE NOT EXISTS "
    "(SELECT 1 FROM listings b WHERE upper(trim(b.neighbourhood_cleansed)) = upper(trim(a.neighbourhood_group_cleansed)))"
)
FENCES = (
    f"numbers AS (SELECT *, {PRICE} AS p FROM listings), fences AS (SELECT "
    "quantile_cont(p, 0.75) + 3.0 * (quantile_cont(p, 0.75) - quantile_cont(p, 0.25)) AS pf, "
    "greatest(30.0, quantile_cont(minimum_nights, 0.75) + 3.0 * "
    "(quantile_cont(minimum_nights, 0.75) - quantile_cont(minimum_nights, 0.25))) AS nf FROM numbers)"
)
# error type -> severity, column, condition, value
ERRORS = {
    "IMPOSSIBLE_PRICE": ("CRITICAL", "price", "p <= 0", "p"),
    "EXTREME_PRICE_OUTLIER": ("HIGH", "price", "p > 0 AND p > pf", "p"),
    "IMPOSSIBLE_MIN_NIGHTS": ("CRITICAL", "minimum_nights", "minimum_nights > 365", "minimum_nights"),
    "EXTREME_MIN_NIGHTS_OUTLIER": (
        "HIGH",
        "minimum_nights",
        "minimum_nights <= 365 AND minimum_nights > nf",
        "minimum_nights",
    ),
    "SUSPICIOUS_UNAVAILABLE_HIGH_PRICE": (
        "HIGH",
        "availability_365",
        "availability_365 = 0 AND p > 500",
        "availability_365",
    ),
    "MIN_NIGHTS_GREATER_THAN_MAX": (
        "CRITICAL",
        "minimum_nights",
        "minimum_nights > maximum_nights",
        "minimum_nights",
    ),
}
FOUND_ERRORS = "found_errors AS (" + union(
    f"SELECT row_id, CAST(id AS VARCHAR) AS listing_id, '{e}' AS error_type, '{s}' AS severity, '{c}' AS \"column\", "
    f"CAST({v} AS DOUBLE) AS value FROM numbers, fences WHERE {p}"
    for e, (s, c, p, v) in ERRORS.items()
) + ")"
ORACLE_SQL["statistical_errors"] = f"{LISTINGS}, {FENCES}, {FOUND_ERRORS} SELECT * FROM found_errors"
ORACLE_SQL["error_summary"] = f"{LISTINGS}, {FENCES} " + union(
    f"SELECT '{e}' AS error_type, count(CASE WHEN {p} THEN 1 END) AS violation_count, "
    f"{pct(f'count(CASE WHEN {p} THEN 1 END)', 'count(*)', 2)} AS violation_pct FROM numbers, fences"
    for e, (_, _, p, _) in ERRORS.items()
)
ORACLE_SQL["zscore_outliers"] = union(
    f"SELECT l_orderkey, l_linenumber, '{c}' AS \"column\", {c} AS value, round(({c} - m) / s, 4) AS z_score FROM lineitem, "
    f"(SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM lineitem) WHERE abs(({c} - m) / s) > 1.5"
    for c in ("l_extendedprice", "l_discount")
)
ORACLE_SQL["iqr_outliers"] = union(
    f"SELECT l_orderkey, l_linenumber, '{c}' AS \"column\", {c} AS value, round(f, 4) AS fence FROM lineitem, "
    f"(SELECT quantile_cont({c}, 0.75) + 0.3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS f FROM lineitem) "
    f"WHERE {c} > f"
    for c in ("l_extendedprice", "l_quantity")
)

# Drift


# Chances of the states of two samples of up to 10,000 rows, drawn in a random order, while their distance is below the statistic.
KS_PATHS = (
    "sized AS (SELECT *, CAST(round(ks * (few // gcd(few, many) * many)) AS BIGINT) * gcd(few, many) AS h "
    "FROM (SELECT ks, least(n1, n2) AS few, greatest(n1, n2) AS many FROM m) WHERE few > 0 AND many <= 10000), "
    "path AS (SELECT few, many, h, 0::BIGINT AS t, 0::BIGINT AS i, 1.0::DOUBLE AS p FROM sized WHERE h > 0 UNION ALL "
    "SELECT few, many, h, t, i, sum(p) AS p FROM ("
    "SELECT few, many, h, t + 1 AS t, i + side AS i, p * CASE side WHEN 1 THEN few - i ELSE many - (t - i) END / (few + many - t) AS p "
    "FROM path, (VALUES (0::BIGINT), (1::BIGINT)) sides(side) WHERE t < few + many"
    ") WHERE abs((few + many) * i - few * t) < h GROUP BY few, many, h, t, i)"
)


def drift_sql(tagged: str, columns: dict[str, str]) -> str:
    """``tagged`` is a relation with a ``cohort`` column; columns map name to expression."""
    parts = []
    for c, e in columns.items():
        parts.append(
            f"(WITH RECURSIVE v AS (SELECT CAST({e} AS DOUBLE) AS value, cohort FROM {tagged} WHERE cohort IS NOT NULL AND {e} IS NOT NULL), "
            "s AS (SELECT count(CASE WHEN cohort = 1 THEN 1 END) AS n1, count(CASE WHEN cohort = 2 THEN 1 END) AS n2, "
            "avg(CASE WHEN cohort = 1 THEN value END) AS m1, avg(CASE WHEN cohort = 2 THEN value END) AS m2 FROM v), "
            "g AS (SELECT value, count(CASE WHEN cohort = 1 THEN 1 END) AS a, count(CASE WHEN cohort = 2 THEN 1 END) AS b "
            "FROM v GROUP BY value), "
            "r AS (SELECT value, sum(a) OVER w AS ca, sum(b) OVER w AS cb, lead(value) OVER (ORDER BY value) - value AS width "
            "FROM g WINDOW w AS (ORDER BY value ROWS UNBOUNDED PRECEDING)), "
            "m AS MATERIALIZED (SELECT max(abs(ca / n1 - cb / n2)) AS ks, sum(abs(ca / n1 - cb / n2) * coalesce(width, 0)) AS wd, "
            "max(n1) AS n1, max(n2) AS n2, max(m1) AS m1, max(m2) AS m2 FROM r, s), "
            f"{KS_PATHS}, "
            "z AS (SELECT *, ks * sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2)) AS lam FROM m), "
            "p AS (SELECT *, CASE WHEN greatest(n1, n2) <= 10000 THEN (SELECT least(greatest(1 - coalesce(sum(p), 0), 0.0), 1.0) "
            "FROM path WHERE t = few + many) WHEN lam < 0.2 THEN 1.0 ELSE least(greatest((SELECT sum(CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END "
            "* exp(-2.0 * j * j * lam * lam)) FROM range(1, 101) t(j)), 0.0), 1.0) END AS pv FROM z) "
            f"SELECT '{c}' AS \"column\", round(ks, 4) AS ks_statistic, CAST(round(pv, 5) AS DOUBLE) AS p_value, "
            "round(wd, 4) AS wasserstein_distance, CASE WHEN pv < 0.05 THEN 'DRIFT_DETECTED' ELSE 'STABLE' END AS drift_status, "
            "round(m1, 2) AS cohort1_mean, round(m2, 2) AS cohort2_mean, CAST(n1 AS BIGINT) AS cohort1_size, "
            "CAST(n2 AS BIGINT) AS cohort2_size FROM p WHERE n1 > 5 AND n2 > 5)"
        )
    return union(parts)


def cohort_sql(source: str, date: str) -> str:
    micros = f"epoch_us(CAST({date} AS TIMESTAMP))"
    return (
        f"tagged AS (SELECT *, CASE WHEN {micros} <= mid THEN 1 WHEN {micros} > mid THEN 2 END AS cohort "
        f"FROM {source}, (SELECT quantile_cont(CAST({micros} AS DOUBLE), 0.5) AS mid FROM {source}))"
    )


ORACLE_SQL["drift_orders"] = (
    f"WITH {cohort_sql('orders', 'o_orderdate')} "
    + drift_sql("tagged", {"o_totalprice": "o_totalprice", "o_custkey": "o_custkey"})
)
ORACLE_SQL["drift_report"] = (
    f"SELECT d.*, (SELECT strftime(make_timestamp(CAST(floor(quantile_cont(CAST(epoch_us(CAST(o_orderdate AS TIMESTAMP)) AS DOUBLE), "
    f"0.5)) AS BIGINT)), '%Y-%m-%d') FROM orders) AS split_date FROM ({ORACLE_SQL['drift_orders']}) d"
)
DRIFT = {
    "price": PRICE,
    "minimum_nights": "minimum_nights",
    "availability_365": "availability_365",
    "number_of_reviews": "number_of_reviews",
}
ORACLE_SQL["drift_listings"] = (
    f"{LISTINGS}, {cohort_sql('listings', 'try_strptime(host_since, $$%Y-%m-%d$$)')} {drift_sql('tagged', DRIFT)}"
)
ORACLE_SQL["drift_raw_cleaned"] = (
    f"{LISTINGS}, {NORMAL_PRICE} sides AS (SELECT p AS price_n, minimum_nights, availability_365, number_of_reviews, "
    f"1 AS cohort FROM parsed UNION ALL SELECT {price_sql('parsed')}, minimum_nights, availability_365, number_of_reviews, 2 "
    "FROM parsed LEFT JOIN rawfirst ON id = rid) " + drift_sql("sides", DRIFT | {"price": "price_n"})
)

# Anomalies

SCALED_NAMES = ["balance", "orders_count", "mean_price", "top_price"]
SCALED = (
    "filled AS (SELECT host_id, "
    + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM profiles)) AS {c}" for c in SCALED_NAMES)
    + " FROM profiles), scaled AS (SELECT host_id, "
    + ", ".join(
        f"({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled) AS z{i}"
        for i, c in enumerate(SCALED_NAMES)
    )
    + " FROM filled)"
)
GAPS = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(SCALED_NAMES)))
ORACLE_SQL["lof_scores"] = (
    f"{PROFILES}, {SCALED}, near AS (SELECT key, other, distance FROM (SELECT a.host_id AS key, b.host_id AS other, "
    f"sqrt({GAPS}) AS distance FROM scaled a JOIN scaled b ON a.host_id <> b.host_id) "
    "QUALIFY row_number() OVER (PARTITION BY key ORDER BY distance, other) <= 20), "
    "kd AS (SELECT key, max(distance) AS kdist FROM near GROUP BY key), "
    "dens AS (SELECT near.key, 1.0 / (avg(greatest(kd.kdist, distance)) + 1e-10) AS lrd FROM near JOIN kd ON other = kd.key "
    "GROUP BY near.key) "
    "SELECT near.key, round(avg(o.lrd) / max(m.lrd), 4) AS lof FROM near JOIN dens o ON other = o.key "
    "JOIN dens m ON near.key = m.key GROUP BY near.key"
)
SHARE = {"flag_top": ("top_price", ">"), "flag_mean": ("mean_price", ">"), "flag_count": ("orders_count", ">=")}
FLAGGED = (
    "ends AS (SELECT "
    + ", ".join(
        f"quantile_cont({c}, 0.95) AS {c}_cut, min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c, _ in SHARE.values()
    )
    + " FROM profiles), flagged AS (SELECT host_id, "
    + ", ".join(f"{c} {op} {c}_cut AS {f}" for f, (c, op) in SHARE.items())
    + ", "
    + ", ".join(f"round(({c} - {c}_lo) / ({c}_hi - {c}_lo + 1e-9), 4) AS {f}_score" for f, (c, _) in SHARE.items())
    + " FROM profiles, ends)"
)
ORACLE_SQL["share_flags"] = f"{PROFILES}, {FLAGGED} SELECT * FROM flagged"
A, B, C = (f"coalesce({f}, false)" for f in SHARE)


def counted(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


ORACLE_SQL["anomaly_overlap"] = (
    f"{PROFILES}, {FLAGGED}, n AS (SELECT count(*) AS total_rows, {counted(A)} AS first_count, {counted(B)} AS second_count, "
    f"{counted(C)} AS third_count, {counted(f'{A} AND {B}')} AS both_count, "
    f"{counted(f'{A} AND {B} AND {C}')} AS all_three_count, {counted(f'{A} OR {B}')} AS first_or_second_count, "
    f"{counted(f'{A} OR {B} OR {C}')} AS any_count, "
    f"{counted(f'CAST({A} AS INTEGER) + CAST({B} AS INTEGER) + CAST({C} AS INTEGER) >= 2')} AS consensus_count FROM flagged) "
    f"SELECT *, {pct('first_count', 'total_rows', 2)} AS first_pct, {pct('second_count', 'total_rows', 2)} AS second_pct, "
    f"{pct('third_count', 'total_rows', 2)} AS third_pct, "
    "coalesce(round(CAST(both_count AS DOUBLE) / nullif(first_or_second_count, 0), 4), 0.0) AS jaccard, "
    f"coalesce({pct('both_count', 'nullif(first_count, 0)', 2)}, 0.0) AS pct_first_in_second, "
    f"coalesce({pct('both_count', 'nullif(second_count, 0)', 2)}, 0.0) AS pct_second_in_first FROM n"
)
REASONS = ["balance", "mean_price", "top_price"]
ORACLE_SQL["anomaly_reasons"] = (
    f"{PROFILES}, r AS (SELECT host_id, concat_ws('; ', "
    + ", ".join(
        f"CASE WHEN {c} > (SELECT quantile_cont({c}, 0.95) FROM profiles) THEN '{c} above its 95th percentile' END"
        for c in REASONS
    )
    + ") AS found FROM profiles) SELECT host_id, CASE WHEN found = '' THEN 'multi-dimensional outlier' ELSE found END AS reasons FROM r"
)

# Text

SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"


def strip_sql(value: str) -> str:
    return f"regexp_replace({value}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def text_ctes(source: str, keys: list[str], columns: list[str], prefix: str = "") -> str:
    """``classified``: one row per (key, column) with category and measures."""
    long = union(
        f"SELECT {', '.join(keys)}, '{c}' AS \"column\", {c} AS text FROM {source}"
        if c
        else ""
        for c in columns
    )
    bare = strip_sql(r"regexp_replace(low, '[^\p{L}\p{N}_\s\p{Z}\x0b\x1c-\x1f\x85]', '', 'g')")
    names = ", ".join(keys)
    return (
        f"{prefix}long AS ({long}), s1 AS (SELECT *, {strip_sql('text')} AS s FROM long), "
        f"s2 AS (SELECT *, lower(s) AS low, regexp_split_to_array(s, '{SPACE}+') AS words FROM s1), "
        f"s3 AS (SELECT *, {bare} AS bare, len(words) AS wc FROM s2), "
        f"s4 AS (SELECT *, CASE WHEN text IS NULL OR s = '' THEN 0 WHEN regexp_matches(bare, '{PLACEHOLDER_PATTERN}') "
        f"OR regexp_matches(low, '{PLACEHOLDER_PATTERN}') THEN 1 "
        f"WHEN wc = 1 AND (length(bare) < 15 OR bare IN ({texts(SINGLE_WORDS)})) THEN 2 "
        "WHEN wc <= 5 OR length(s) < 25 THEN 3 ELSE 4 END AS k FROM s3), "
        f"classified AS (SELECT {names}, \"column\", text, "
        f"CASE k WHEN 0 THEN '{MISSING}' WHEN 1 THEN '{PLACEHOLDER}' WHEN 2 THEN '{PLACEHOLDER}' WHEN 3 THEN '{NEAR_EMPTY}' "
        f"ELSE '{GENUINE}' END AS category, CAST(CASE k WHEN 0 THEN 0.0 WHEN 1 THEN 0.05 WHEN 2 THEN 0.1 WHEN 3 THEN 0.35 "
        "ELSE least(1.0, round(0.5 + CAST(wc AS DOUBLE) / 100.0 * 0.5, 3)) END AS DOUBLE) AS confidence, "
        "CASE WHEN k = 0 THEN 0 ELSE wc END AS word_count, CASE WHEN k = 0 THEN 0 ELSE length(s) END AS char_count, "
        "CASE WHEN k = 4 THEN round(CAST(len(list_distinct(list_transform(words, lambda w: lower(w)))) AS DOUBLE) / wc, 3) END "
        "AS lexical_diversity FROM s4)"
    )


DOCUMENT_TEXT = f"WITH {text_ctes('documents', ['doc_id'], ['text'])}"
ORACLE_SQL["text_quality"] = (
    f"{DOCUMENT_TEXT} SELECT doc_id, \"column\", category, confidence, word_count, char_count, lexical_diversity FROM classified"
)
TWO_TEXTS = text_ctes(
    "(SELECT *, CAST(NULL AS VARCHAR) AS neighborhood_overview FROM listings)",
    ["row_id"],
    ["description", "neighborhood_overview"],
)
ORACLE_SQL["text_summary"] = (
    f"{LISTINGS}, {TWO_TEXTS} SELECT \"column\", category, count(*) AS rows, "
    f"{pct('count(*)', 'sum(count(*)) OVER (PARTITION BY \"column\")', 2)} AS pct FROM classified GROUP BY 1, 2"
)
ORACLE_SQL["text_means"] = (
    f"WITH {text_ctes('conversations', ['conv_id', 'turn'], ['text', 'role'])} SELECT \"column\", count(*) AS total_rows, "
    "count(text) AS non_null, round(avg(word_count), 2) AS mean_word_count, round(avg(char_count), 2) AS mean_char_count, "
    "round(avg(confidence), 3) AS mean_confidence FROM classified GROUP BY 1"
)
DESCRIPTIONS = text_ctes("listings", ["row_id"], ["description"])
ORACLE_SQL["text_issues"] = (
    f"{LISTINGS}, {DESCRIPTIONS} SELECT row_id, \"column\", category, confidence, word_count, char_count, "
    f"substring(text, 1, 100) AS text_sample FROM classified WHERE category <> '{GENUINE}'"
)

# List fields

PARSED = (
    "typed AS (SELECT row_id, id, trim(amenities) AS t, CASE WHEN amenities IS NULL THEN 'MISSING' "
    "WHEN trim(amenities) IN ('', '[]', '{}') THEN 'EMPTY' WHEN json_valid(amenities) THEN 'JSON' "
    "WHEN starts_with(trim(amenities), '[''') THEN 'PYTHON_LITERAL' ELSE 'PLAIN_TEXT_COMMA' END AS format_type FROM listings), "
    "split AS (SELECT *, CASE format_type WHEN 'JSON' THEN from_json(t, '[\"VARCHAR\"]') "
    "WHEN 'PYTHON_LITERAL' THEN from_json(replace(t, '''', '\"'), '[\"VARCHAR\"]') "
    "WHEN 'PLAIN_TEXT_COMMA' THEN list_filter(list_transform(string_split(t, ','), lambda x: trim(x)), lambda x: x <> '') "
    "ELSE CAST([] AS VARCHAR[]) END AS raw FROM typed), "
    "parsed AS (SELECT *, list_filter(raw, lambda x: x <> '') AS clean FROM split), "
    "lists AS (SELECT row_id, id, format_type, raw, "
    "list_filter(clean, lambda x, i: list_position(clean, x) = i) AS items, clean FROM parsed), "
    "lists2 AS (SELECT *, concat_ws('|', CASE WHEN format_type = 'MISSING' THEN 'Null or NaN amenities field' END, "
    "CASE WHEN format_type = 'EMPTY' THEN 'Empty amenities array' END, "
    "CASE WHEN format_type = 'PLAIN_TEXT_COMMA' THEN 'Fallback comma parsing required' END, "
    "CASE WHEN len(list_filter(raw, lambda x: regexp_matches(x, '[^\\x00-\\x7F]'))) > 0 THEN 'contains_encoding_artifacts' END, "
    "CASE WHEN len(items) <> len(clean) THEN 'contains_duplicate_items' END) AS issues FROM lists)"
)
ORACLE_SQL["list_parse"] = (
    f"{LISTINGS}, {PARSED} SELECT row_id, format_type, array_to_string(items, '|') AS items, issues FROM lists2"
)
ORACLE_SQL["list_metrics"] = (
    f"{LISTINGS}, {PARSED} SELECT count(*) AS total_processed, {counted('format_type = $$JSON$$')} AS valid_json_count, "
    f"{counted('contains(issues, $$artifacts$$)')} AS encoding_artifact_count, "
    f"{counted('contains(issues, $$duplicate$$)')} AS duplicate_items_count, {counted('len(items) = 0')} AS empty_count, "
    "round(avg(len(items)), 2) AS avg_items, min(len(items)) AS min_items, max(len(items)) AS max_items, "
    "(SELECT count(DISTINCT i) FROM (SELECT unnest(items) AS i FROM lists2)) AS distinct_items FROM lists2"
)
ITEMS = (
    "items AS (SELECT row_id, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM lists2), "
    "counts AS (SELECT item, count(*) AS frequency, min(row_id * 1000 + pos) AS seen FROM items GROUP BY 1)"
)
ORACLE_SQL["list_top_items"] = (
    f"{LISTINGS}, {PARSED}, {ITEMS} SELECT item, frequency FROM counts ORDER BY frequency DESC, seen LIMIT 20"
)
ORACLE_SQL["list_categories"] = f"{LISTINGS}, {PARSED}, {ITEMS} SELECT * FROM (" + union(
    f"SELECT '{c}' AS category, CAST(sum(frequency) AS BIGINT) AS matches FROM counts "
    f"WHERE regexp_matches(lower(item), '{'|'.join(p)}')"
    for c, p in CATEGORIES.items()
) + ") WHERE matches > 0"
ORACLE_SQL["list_issues"] = (
    f"{LISTINGS}, {PARSED} SELECT row_id, CAST(id AS VARCHAR) AS listing_id, format_type, "
    "CAST(len(items) AS INTEGER) AS item_count, issues FROM lists2 WHERE issues <> ''"
)

# Health and evaluation

ISSUES = (
    f"{VIOLATIONS}, {FENCES}, {FOUND_ERRORS}, {DESCRIPTIONS}, issues AS ("
    "SELECT row_id, 'rule' AS source, rule_name AS name, severity FROM violations UNION ALL "
    "SELECT row_id, 'error', error_type, severity FROM found_errors UNION ALL "
    f"SELECT row_id, 'text', \"column\" || ':' || category, CASE WHEN category = '{MISSING}' THEN 'MEDIUM' ELSE 'LOW' END "
    f"FROM classified WHERE category <> '{GENUINE}'), "
    "weighed AS (SELECT *, CASE severity WHEN 'CRITICAL' THEN 15.0::DOUBLE WHEN 'HIGH' THEN 10.0 WHEN 'MEDIUM' THEN 5.0 "
    "ELSE 2.0 END AS weight FROM issues)"
)
SUB = (
    "greatest(0.0::DOUBLE, round(100.0 - coalesce(sum(CASE WHEN source = '{0}' THEN weight END), 0.0::DOUBLE) / "
    "(SELECT count(*) FROM listings) * 20.0, 2)) AS {0}_score"
)
ORACLE_SQL["health_score"] = (
    f"{LISTINGS}, {ISSUES}, subs AS (SELECT (SELECT count(*) FROM listings) AS total_rows, "
    + ", ".join(SUB.format(s) for s in ("rule", "anomaly", "text", "error"))
    + " FROM weighed), overall AS (SELECT *, round(rule_score * 0.35 + anomaly_score * 0.25 + text_score * 0.2 + "
    "error_score * 0.2, 2) AS overall_health_score FROM subs) SELECT *, CASE WHEN overall_health_score >= 90 THEN 'A+' "
    "WHEN overall_health_score >= 80 THEN 'A' WHEN overall_health_score >= 70 THEN 'B' WHEN overall_health_score >= 60 "
    "THEN 'C' WHEN overall_health_score >= 50 THEN 'D' ELSE 'F' END AS health_grade FROM overall"
)
ROW_SCORE = "greatest(0.0::DOUBLE, round(100.0 - coalesce(sum(weight), 0.0::DOUBLE) * 3.0, 2)) AS row_health_score"
ORACLE_SQL["row_health"] = (
    f"{LISTINGS}, {ISSUES} SELECT row_id, {ROW_SCORE}, count(weight) AS issue_count "
    "FROM listings LEFT JOIN weighed USING (row_id) GROUP BY row_id"
)


def severity_sql(extra: str = "") -> str:
    return (
        f"{LISTINGS}, {ISSUES}{extra} SELECT "
        + ", ".join(f"{counted(f'severity = $${s}$$')} AS {s.lower()}_count" for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW"))
        + ", count(*) AS total_issues_count FROM "
    )


ORACLE_SQL["severity_summary"] = severity_sql() + "issues"
ORACLE_SQL["severity_with_lists"] = (
    severity_sql(f", {PARSED}")
    + "(SELECT severity FROM issues UNION ALL SELECT 'LOW' FROM (SELECT unnest(string_split(issues, '|')) AS i FROM lists2 "
    "WHERE issues <> ''))"
)


def names_sql(source: str) -> str:
    return f"coalesce(string_agg(CASE WHEN source = '{source}' THEN weighed.name END, '|' ORDER BY weighed.name), '')"


ORACLE_SQL["master_log"] = (
    f"{LISTINGS}, {ISSUES} SELECT row_id, CAST(max(id) AS VARCHAR) AS listing_id, {ROW_SCORE}, "
    f"{names_sql('rule')} AS rule_violations, {names_sql('anomaly')} AS anomalies, {names_sql('text')} AS text_issues, "
    f"{names_sql('error')} AS statistical_errors FROM listings JOIN weighed USING (row_id) GROUP BY row_id"
)
LABELLED = (
    f"{ISSUES}, logged AS (SELECT row_id, (100.0 - greatest(0.0::DOUBLE, round(100.0 - sum(weight) * 3.0, 2))) / 100.0 AS sc, "
    "count(CASE WHEN source = 'rule' THEN 1 END) > 0 AS hit FROM weighed GROUP BY row_id), "
    "joined AS (SELECT row_id, coalesce(sc, 0.0::DOUBLE) AS score, coalesce(hit, false) OR "
    "coalesce(p <= 0 OR p > pf OR minimum_nights > 365, false) OR description IS NULL OR trim(description) = '' AS bad "
    "FROM numbers LEFT JOIN logged USING (row_id), fences), "
    "labelled AS (SELECT row_id, CAST(bad OR score > 0.40 AS INTEGER) AS truth, CAST(score >= 0.20 AS INTEGER) AS predicted, "
    "score FROM joined)"
)
ORACLE_SQL["evaluation_sample"] = (
    f"{LISTINGS}, {LABELLED} SELECT row_id, truth, predicted, round(score, 4) AS score FROM labelled "
    "ORDER BY md5(CAST(row_id AS VARCHAR) || ':42'), row_id LIMIT 200"
)


def metrics_sql(source: str) -> str:
    return (
        f"m AS (SELECT count(*) AS sample_size, {counted('truth = 1 AND predicted = 1')} AS tp, "
        f"{counted('truth <> 1 AND predicted = 1')} AS fp, {counted('truth = 1 AND predicted <> 1')} AS fn, "
        f"{counted('truth <> 1 AND predicted <> 1')} AS tn FROM {source}) "
        "SELECT sample_size, tp + fn AS positives, fp + tn AS negatives, tn, fp, fn, tp, "
        "round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 4) AS precision, "
        "round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 4) AS recall, "
        "round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0), 4) AS f1_score, "
        "round(coalesce(CAST(tp + tn AS DOUBLE) / nullif(sample_size, 0), 0.0), 4) AS accuracy FROM m"
    )


ORACLE_SQL["evaluation_metrics"] = f"{LISTINGS}, {LABELLED}, {metrics_sql('labelled')}"
AUC_OF = (
    "g AS (SELECT score AS s, count(*) AS n, count(CASE WHEN truth = 1 THEN 1 END) AS pos FROM {0} GROUP BY 1), "
    "r AS (SELECT pos, sum(n) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2.0 AS rank FROM g), "
    "t AS (SELECT CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(n) - sum(pos) AS DOUBLE) AS q FROM g), "
    "auc AS (SELECT round(((SELECT sum(CAST(pos * rank AS DOUBLE)) FROM r) - p * (p + 1) / 2) / (p * q), 4) AS roc_auc FROM t)"
)
SAMPLED = "sampled AS (SELECT * FROM labelled ORDER BY md5(CAST(row_id AS VARCHAR) || ':42'), row_id LIMIT 200)"
ORACLE_SQL["evaluation_job"] = (
    f"{LISTINGS}, {LABELLED}, {SAMPLED}, {AUC_OF.format('sampled')}, "
    + metrics_sql("sampled").replace(" FROM m", ", (SELECT roc_auc FROM auc) AS roc_auc FROM m")
)
LABEL_SCORES = (
    f"{DOCUMENT_TEXT}, scores AS (SELECT quality AS truth, CAST(confidence >= 0.75 AS INTEGER) AS predicted, "
    "confidence AS score FROM classified JOIN labels USING (doc_id))"
)
ORACLE_SQL["label_metrics"] = f"{LABEL_SCORES}, {metrics_sql('scores')}"
ORACLE_SQL["roc_points"] = (
    f"{LABEL_SCORES}, g AS (SELECT score AS threshold, {counted('truth = 1')} AS pos, {counted('truth <> 1')} AS neg "
    "FROM scores GROUP BY 1) SELECT round(threshold, 4) AS threshold, pos, neg, "
    "round(CAST(sum(neg) OVER w AS DOUBLE) / (SELECT sum(neg) FROM g), 4) AS fpr, "
    "round(CAST(sum(pos) OVER w AS DOUBLE) / (SELECT sum(pos) FROM g), 4) AS tpr FROM g "
    "WINDOW w AS (ORDER BY g.threshold DESC ROWS UNBOUNDED PRECEDING)"
)
# Rank sums with average ranks, not trapezoids.
ORACLE_SQL["roc_auc"] = (
    f"{LABEL_SCORES}, g AS (SELECT score AS s, count(*) AS n, {counted('truth = 1')} AS pos FROM scores GROUP BY 1), "
    "r AS (SELECT pos, sum(n) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - n + (n + 1) / 2.0 AS rank FROM g), "
    "t AS (SELECT CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(n) - sum(pos) AS DOUBLE) AS q FROM g) "
    "SELECT round(((SELECT sum(CAST(pos * rank AS DOUBLE)) FROM r) - p * (p + 1) / 2) / (p * q), 4) AS roc_auc FROM t"
)

# Trained models have no SQL equivalent; what must hold for any of them has.
ORACLE_SQL["network_reconstruction"] = (
    f"{LISTINGS} SELECT count(*) AS reconstructed_rows, true AS all_errors_valid, true AS at_most_projection FROM listings"
)

ORACLE_SQL["csv_round_trip"] = (
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, row_number() OVER (ORDER BY c_custkey) - 1 AS row_id, "
    "0::BIGINT AS corrupt_lines FROM customer"
)
