"""Table files in and out: CSV (plain or gzip), Parquet, JSON documents."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import snake_case
from plumbline.session import settle

SPEC_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("expected_dtype", T.StringType()),
        T.StructField("semantic_type", T.StringType()),
        T.StructField("is_nullable", T.BooleanType()),
        T.StructField("is_unique", T.BooleanType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("allowed_values", T.ArrayType(T.StringType())),
        T.StructField("format_pattern", T.StringType()),
        T.StructField("is_key_column", T.BooleanType()),
    ]
)


def standardize_column_names(df: DataFrame) -> DataFrame:
    """snake_case every header; two headers that become equal are an error."""
    names = [snake_case(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after standardizing: {twice}")
    return df.toDF(*names)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, partitions: int | None = None
) -> DataFrame:
    """Read CSV with a header; gzip is recognised by its extension.

    Pin ``schema`` for large inputs: inference reads the file twice. A gzip file
    is one split, so ``partitions`` spreads its rows right after the read.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


CORRUPT = "_corrupt_record"


def stage_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, row_key: str = "row_id"
) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV that fit a pinned ``schema``, and the lines that do not as ``_corrupt_record``, each with its place.

    The file is read once and settled. A line is one record here, so that a broken quote costs one line and
    not the rest of the file; nothing is inferred and no line is dropped.
    """
    fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    whole = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(whole).option("header", True).option("escape", '"').option("columnPruning", False)
    read = with_row_key(reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path), row_key)
    return read.where(F.col(CORRUPT).isNull()).drop(CORRUPT), read.where(F.col(CORRUPT).isNotNull()).select(row_key, CORRUPT)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    (writer.option("compression", compression) if compression else writer).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(
    spark: SparkSession,
    path: str,
    cache_path: str | None = None,
    schema: T.StructType | str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Load a raw CSV, standardize its headers and keep a Parquet copy."""
    df = standardize_column_names(read_csv(spark, path, schema, partitions))
    if cache_path is None:
        return df
    write_parquet(df, cache_path)
    return read_parquet(spark, cache_path)


def parquet_or(spark: SparkSession, cache_path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The cached Parquet table if it is there, else build and cache it."""
    try:
        return spark.read.parquet(cache_path)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        write_parquet(build(), cache_path)
        return spark.read.parquet(cache_path)


def fingerprint(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> str:
    """SHA-256 of a source's files (names, lengths, times of change) and the schema it is read with; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    line = F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    # One line per file; sums of hashes need no order and no list of them.
    mark = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64(line).cast("decimal(38,0)")).alias("a"), F.sum(F.xxhash64(F.lit(1), line).cast("decimal(38,0)")).alias("b")).first()
    kind = schema.json() if isinstance(schema, T.StructType) else str(schema)
    return hashlib.sha256(f"{mark.n}|{mark.a}|{mark.b}|{kind}".encode()).hexdigest()


def cached_table(spark: SparkSession, path: str, cache_path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """The Parquet copy of a CSV source, rebuilt when the source or its schema has changed.

    A manifest beside the copy keeps the source's fingerprint. It is written last, so a copy that was not finished is
    never taken for a whole one.
    """
    now, manifest = fingerprint(spark, path, schema), f"{cache_path}.manifest"
    try:
        kept = spark.read.schema("fingerprint string").json(manifest).first()
        if kept is not None and kept.fingerprint == now:
            return read_parquet(spark, cache_path)
    except AnalysisException as error:
        if not is_absent(error):
            raise
    write_json(spark.range(0).select(F.lit("").alias("fingerprint")), manifest)  # what follows may end half way
    write_parquet(standardize_column_names(read_csv(spark, path, schema)), cache_path)
    write_json(spark.range(1).select(F.lit(now).alias("fingerprint")), manifest)
    return read_parquet(spark, cache_path)


def with_row_key(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Row key of a table read from files: the row's number from 0, by file name and place in the file.

    A block of a file is read by one task in order, so rows are numbered where they are read and only
    a table with one row per block is ordered. The rows are settled: numbers are given once.
    """
    read = settle(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__block"),
            F.monotonically_increasing_id().alias("__place"),
        )
    )
    blocks = read.groupBy(F.col("__file").alias("__f"), F.col("__block").alias("__b")).agg(
        F.min("__place").alias("__first"), F.count("*").alias("__rows")
    )
    before = Window.orderBy("__f", "__b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    joined = read.join(blocks, (F.col("__file") == F.col("__f")) & (F.col("__block") == F.col("__b")))
    number = (F.col("__place") - F.col("__first") + F.col("__before")).cast("bigint")
    return joined.withColumn(name, number).select(*df.columns, name)


def is_absent(error: AnalysisException) -> bool:
    """A path that does not exist, unlike one that can't be read."""
    return error.getCondition() == "PATH_NOT_FOUND"


def write_json(df: DataFrame, path: str) -> None:
    """A flat result table as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_report(parts: Mapping[str, DataFrame], folder: str) -> None:
    """A report as one JSON-lines folder per part."""
    for name, part in parts.items():
        write_json(part, f"{folder}/{name}")


def nested_document(parts: Mapping[str, DataFrame]) -> DataFrame:
    """A one-row nested document from bounded report parts (one array per part).

    Only for parts with one row per column, rule or metric, never for row logs.
    """
    spark = next(iter(parts.values())).sparkSession
    columns = [
        part.agg(F.sort_array(F.collect_list(F.struct(*part.columns)))).scalar().alias(name)
        for name, part in parts.items()
    ]
    return spark.range(1).select(*columns)


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    """Schema specification: a JSON document ``{"columns": {name: {...}}}``.

    An absent file gives an empty specification.
    """
    body = T.StructType([f for f in SPEC_SCHEMA.fields if f.name != "column"])
    document = T.StructType([T.StructField("columns", T.MapType(T.StringType(), body))])
    try:
        raw = spark.read.schema(document).json(path, multiLine=True)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return spark.createDataFrame([], SPEC_SCHEMA)
    return raw.select(F.explode("columns").alias("column", "spec")).select("column", "spec.*")


def write_spec(
    spec: DataFrame, path: str, version: str = "1.0", descriptions: Mapping[str, str] | None = None
) -> None:
    """Write a specification in the form :func:`read_spec` reads, with its version.

    ``descriptions`` tell what a column holds; others are described by their type.
    """
    texts = spec.sparkSession.createDataFrame(list((descriptions or {}).items()), "column string, given string")
    told = spec.join(texts, "column", "left").withColumn(
        "description", F.coalesce("given", F.concat(F.col("expected_dtype"), F.lit(" column")))
    )
    body = F.struct(*[c for c in told.columns if c not in ("column", "given")])
    document = told.agg(F.map_from_entries(F.collect_list(F.struct("column", body))).alias("columns"))
    document.select(F.lit(version).alias("version"), "columns").write.mode("overwrite").json(path)
