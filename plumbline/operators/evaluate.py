"""Evaluation of scores against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numeric import as_double, count_where
from plumbline.functions.running import running_totals
from plumbline.functions.scalars import attach
from plumbline.functions.text import strip
from plumbline.operators.errors import MAX_NIGHTS, with_fences
from plumbline.session import settle

# Fixed values.
SAMPLE_ROWS = 200
SEED = 42
TRUE_ABOVE = 0.40
PREDICT_FROM = 0.20


def seeded_sample(df: DataFrame, key: str, rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """The same ``rows`` rows on every run: smallest hashes of key and seed."""
    drawn = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("__h", drawn).orderBy("__h", key).limit(rows).drop("__h")


def labelled(df: DataFrame, log: DataFrame, key: str, sample: DataFrame | None = None) -> DataFrame:
    """Truth, prediction and score per row of the sample (the whole table by default).

    ``log`` is the master log. Truth is a rule hit, an extreme value, missing
    text or a score above 0.40; the score is part of the truth, so the measures
    built on it are optimistic.
    """
    taken = with_fences(df)
    if sample is not None:
        taken = taken.join(sample.select(key), key, "left_semi")
    price = as_double(df, "price", currency=True)
    nights = as_double(df, "minimum_nights")
    extreme = (price <= 0) | (price > F.col("__fences")["price_fence"]) | (nights > MAX_NIGHTS)
    blank = F.col("description").isNull() | (strip(F.col("description")) == "")
    findings = log.select(
        F.col(key).alias("__k"),
        (F.size("rule_violations") > 0).alias("__rule"),
        ((100.0 - F.col("row_health_score")) / 100.0).alias("__score"),
    )
    joined = taken.select(
        key, F.coalesce(extreme, F.lit(False)).alias("__extreme"), blank.alias("__blank")
    ).join(findings, F.col(key) == F.col("__k"), "left")
    score = F.coalesce("__score", F.lit(0.0))
    truth = F.coalesce("__rule", F.lit(False)) | F.col("__extreme") | F.col("__blank") | (score > TRUE_ABOVE)
    return joined.select(
        key,
        truth.cast("int").alias("truth"),
        (score >= PREDICT_FROM).cast("int").alias("predicted"),
        score.alias("score"),
    )


def evaluation_metrics(rows: DataFrame) -> DataFrame:
    """One row: confusion matrix, precision, recall, F1, accuracy."""
    t, p = F.col("truth") == 1, F.col("predicted") == 1
    counts = rows.agg(
        F.count("*").alias("sample_size"),
        count_where(t & p).alias("tp"),
        count_where(~t & p).alias("fp"),
        count_where(t & ~p).alias("fn"),
        count_where(~t & ~p).alias("tn"),
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "sample_size",
        (tp + fn).alias("positives"),
        (fp + tn).alias("negatives"),
        "tn",
        "fp",
        "fn",
        "tp",
        F.round(ratio(tp, tp + fp), 4).alias("precision"),
        F.round(ratio(tp, tp + fn), 4).alias("recall"),
        F.round(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1_score"),
        F.round(ratio(tp + tn, F.col("sample_size")), 4).alias("accuracy"),
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """Positives and negatives per exact score, their running totals and the totals of all (struct ``t``)."""
    counts = settle(
        rows.groupBy((F.col("score") + F.lit(0.0)).alias("threshold")).agg(
            count_where(F.col("truth") == 1).alias("pos"), count_where(F.col("truth") != 1).alias("neg")
        )
    )
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return attach(running_totals(counts.withColumn("curve", F.lit(0)), "curve", "threshold", ["pos", "neg"]), totals, "t")


def roc_points(rows: DataFrame) -> DataFrame:
    """ROC curve: one row per distinct score, as it is."""
    t = F.col("t")
    return _ranked(rows).select(
        "threshold",
        "pos",
        "neg",
        F.try_divide((t["n"] - F.col("cum_neg") + F.col("neg")).cast("double"), t["n"]).alias("fpr"),
        F.try_divide((t["p"] - F.col("cum_pos") + F.col("pos")).cast("double"), t["p"]).alias("tpr"),
    )


def roc_auc(rows: DataFrame) -> DataFrame:
    """Area under the ROC curve; null when a class is empty.

    Twice the area counts, for every negative, the positives above it twice and those of its own
    score once, in whole numbers.
    """
    above = F.col("t")["p"] - F.col("cum_pos")
    twice = (F.col("neg") * (2 * above + F.col("pos"))).cast("decimal(38,0)")
    found = _ranked(rows).agg(F.sum(twice).alias("a"), F.first("t").alias("t"))
    whole = (F.col("t")["p"] * F.lit(2.0)) * F.col("t")["n"]
    return found.select(F.round(F.try_divide(F.col("a").cast("double"), whole), 4).alias("roc_auc"))
