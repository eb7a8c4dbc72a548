"""Multivariate anomalies: isolation forest, local outlier factor, reconstruction error."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.localfactor import local_factors
from plumbline.functions.neighbours import nearest
from plumbline.functions.numeric import as_double, count_where, percent
from plumbline.functions.quantiles import quantile_row
from plumbline.functions.scalars import attach
from plumbline.functions.skew import lookup_groups
from plumbline.operators import network
from plumbline.operators.profile import require_columns
from plumbline.session import settle, spread

# Fixed values.
FEATURES = ["price", "minimum_nights", "availability_365", "number_of_reviews"]
REASON_COLUMNS = ["price", "minimum_nights", "number_of_reviews"]
CONTAMINATION = 0.05
TREES = 100
TREE_ROWS = 256
LOF_NEIGHBOURS = 20
COMPONENTS = 2
SEED = 42
EULER = 0.5772156649

MODELS = ["isolation_forest", "local_outlier_factor", "autoencoder"]


def scaled_features(df: DataFrame, key: str, features: Sequence[str] = FEATURES) -> DataFrame:
    """``(key, z_<feature>...)``: nulls at the median, then zero mean and unit population deviation.

    The features are settled first: medians, moments and the scaled values read them again.
    """
    require_columns(df, features)
    raw = settle(df.select(F.col(key).alias("key"), *[as_double(df, f, currency=True).alias(f) for f in features]))
    medians = attach(raw, quantile_row(raw, list(features), {"m": 0.5}), "__m")
    filled = medians.select("key", *[F.coalesce(F.col(f), F.col("__m")[f"{f}_m"]).alias(f) for f in features])
    moments = filled.agg(*[a for f in features for a in (F.avg(f).alias(f"{f}_a"), F.stddev_pop(f).alias(f"{f}_s"))])
    s = F.col("__s")
    scale = {f: F.when(s[f"{f}_s"] == 0, F.lit(1.0)).otherwise(s[f"{f}_s"]) for f in features}
    return attach(filled, moments, "__s").select(
        "key", *[((F.col(f) - s[f"{f}_a"]) / scale[f]).alias(f"z_{f}") for f in features]
    )


def average_path(rows: float) -> float:
    """Mean path length of an unsuccessful search in a tree of ``rows`` rows."""
    if rows < 2:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1) + EULER) - 2.0 * (rows - 1) / rows


def _grow(pdf: pd.DataFrame, columns: Sequence[str], seed: int) -> pd.DataFrame:
    """One isolation tree over a sample (Liu et al. 2008) as rows of nodes."""
    pdf = pdf.sort_values("key")
    x = pdf[list(columns)].to_numpy()
    tree = int(pdf["tree"].iloc[0])
    draw = np.random.default_rng([seed, tree])
    height = math.ceil(math.log2(max(len(x), 2)))
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(nodes)
        nodes.append([tree, me, -1, 0.0, -1, -1, depth + average_path(len(rows)), len(x)])
        if parent >= 0:
            nodes[parent][4 + side] = me
        if depth >= height or len(rows) < 2:
            continue
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if not len(usable):
            continue
        axis = int(usable[int(draw.random() * len(usable))])
        cut = low[axis] + draw.random() * (high[axis] - low[axis])
        nodes[me][2], nodes[me][3] = axis, cut
        right = x[rows, axis] > cut
        todo += [(rows[~right], depth + 1, me, 0), (rows[right], depth + 1, me, 1)]
    return pd.DataFrame(nodes, columns=["tree", "node", "axis", "cut", "left", "right", "path", "size"])


def isolation_scores(scaled: DataFrame, columns: Sequence[str], trees: int = TREES, seed: int = SEED) -> DataFrame:
    """``(key, if_score)`` with scores near 1 for rows that are isolated early.

    Each tree draws its rows by a hash of row key and tree number, so runs
    repeat. The forest has at most ``trees * (2 * TREE_ROWS - 1)`` nodes; it is
    the only thing that passes through the driver.
    """
    rows = scaled.count()
    columns = list(columns)
    # About eight times the wanted rows pass the filter, then the smallest hashes are kept.
    share = min(1.0, 8.0 * TREE_ROWS / max(rows, 1))
    grain = 1 << 30
    number = F.sequence(F.lit(0), F.lit(trees - 1))
    chosen = F.filter(
        number, lambda t: F.pmod(F.xxhash64(F.col("key"), t, F.lit(seed)), F.lit(grain)) < int(share * grain)
    )
    drawn = scaled.select("key", *columns, F.explode(chosen).alias("tree")).withColumn(
        "h", F.xxhash64("key", "tree", F.lit(seed))
    )
    smallest = Window.partitionBy("tree").orderBy("h", "key")
    sample = drawn.withColumn("rn", F.row_number().over(smallest)).where(F.col("rn") <= TREE_ROWS)
    nodes = (
        spread(sample.select("key", "tree", *columns), "tree")
        .groupBy("tree")
        .applyInPandas(
            lambda pdf: _grow(pdf, columns, seed),
            "tree int, node int, axis int, cut double, left int, right int, path double, size int",
        )
        .toPandas()
    )
    forest = []
    for _, part in nodes.sort_values(["tree", "node"]).groupby("tree"):
        forest.append({c: part[c].to_numpy() for c in ("axis", "cut", "left", "right", "path", "size")})
    shared = scaled.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[columns].to_numpy()
            total = np.zeros(len(x))
            for tree in shared.value:
                at = np.zeros(len(x), dtype=np.int64)
                open_ = np.arange(len(x)) if tree["axis"][0] >= 0 else np.empty(0, dtype=np.int64)
                while len(open_):
                    here = at[open_]
                    right = x[open_, tree["axis"][here]] > tree["cut"][here]
                    at[open_] = np.where(right, tree["right"][here], tree["left"][here])
                    open_ = open_[tree["axis"][at[open_]] >= 0]
                total += tree["path"][at]
            unit = average_path(float(shared.value[0]["size"][0])) or 1.0
            yield pd.DataFrame({"key": pdf["key"], "if_score": 2.0 ** (-total / len(shared.value) / unit)})

    return scaled.select("key", *columns).mapInPandas(score, "key bigint, if_score double")


def lof_scores(scaled: DataFrame, columns: Sequence[str], k: int = LOF_NEIGHBOURS, box_rows: int | None = None) -> DataFrame:
    """``(key, lof)``: local outlier factor (Breunig et al. 2000), ties by key.

    Of rows with equal features the first ``k + 1`` by key can be neighbours of
    anything; the later ones have exactly the factor of copy ``k + 1``. So only
    these take part, and the factor is handed on to the others.
    """
    columns = list(columns)
    copy = Window.partitionBy(*columns).orderBy("key")
    standing = settle(
        scaled.select("key", *columns).withColumn("rn", F.row_number().over(copy)).where(F.col("rn") <= k + 1)
    )
    extra = {} if box_rows is None else {"box_rows": box_rows}
    # Tiles know their rows by key.
    odd = standing.groupBy("key").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("key").isNull())
    factors = local_factors(standing, columns, k, **extra) if odd.isEmpty() else _joined_factors(standing, columns, k, **extra)
    # Repeated vectors beyond copy k + 1 look their factor up.
    last = standing.where(F.col("rn") == k + 1).join(factors, "key").drop("key", "rn")
    sizes = scaled.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > k + 1)
    packed = [*columns]
    later = lookup_groups(
        scaled.select("key", *columns), sizes.join(last, columns).drop("n"), packed, how="inner"
    ).select("key", "lof")
    later = later.join(factors.select("key"), "key", "left_anti")
    return factors.unionByName(later)


def _joined_factors(standing: DataFrame, columns: Sequence[str], k: int, **extra: int) -> DataFrame:
    """``(key, lof)`` where keys repeat or are null: neighbours of all rows of a key count together, and meet by joins."""
    near = settle(nearest(standing, "key", columns, k, **extra).select("key", "neighbour", "distance"))
    reach = near.groupBy("key").agg(F.max("distance").alias("kdist"))
    density = (
        near.join(reach.withColumnRenamed("key", "neighbour"), "neighbour")
        .groupBy("key")
        .agg((1.0 / (F.avg(F.greatest("kdist", "distance")) + F.lit(1e-10))).alias("lrd"))
    )
    density = settle(density)
    around = (
        near.join(density.select(F.col("key").alias("neighbour"), F.col("lrd").alias("other")), "neighbour")
        .groupBy("key")
        .agg(F.avg("other").alias("mean_other"))
    )
    # Read three times by the caller; it has one row per standing row.
    return settle(around.join(density, "key").select("key", (F.col("mean_other") / F.col("lrd")).alias("lof")))


def principal_axes(scaled: DataFrame, columns: Sequence[str], components: int = COMPONENTS) -> np.ndarray:
    """(columns, components) weights of the leading principal components."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(scaled)
    return PCA(k=components, inputCol="v", outputCol="p").fit(vectors).pc.toArray()


def network_errors(scaled: DataFrame, columns: Sequence[str], evaluations: int = network.EVALUATIONS, seed: int = network.SEED) -> DataFrame:
    """``(key, mse)``: squared error of a relu network with a narrow middle layer, trained on all rows.

    ``scaled`` is read once per evaluation, so it should be settled. Its total error is not above that of
    :func:`reconstruction_errors`. An empty table gives no rows.
    """
    columns = list(columns)
    if scaled.isEmpty():
        return scaled.select("key", F.lit(None).cast("double").alias("mse"))
    layers = network.train(scaled, columns, principal_axes(scaled, columns), evaluations=evaluations, seed=seed)
    return network.squared_error(scaled.select("key", *columns), columns, layers).select("key", "mse")


def reconstruction_errors(scaled: DataFrame, columns: Sequence[str], components: int = COMPONENTS) -> DataFrame:
    """``(key, mse)``: squared error of the projection on the leading components.

    A linear autoencoder with the same bottleneck has this optimum.
    """
    columns = list(columns)
    axes = principal_axes(scaled, columns, components)
    codes = [
        sum((F.col(c) * F.lit(float(axes[i, m])) for i, c in enumerate(columns)), F.lit(0.0))
        for m in range(components)
    ]
    coded = scaled.select("key", *columns, *[code.alias(f"__c{m}") for m, code in enumerate(codes)])
    squares = []
    for i, c in enumerate(columns):
        back = sum((F.col(f"__c{m}") * F.lit(float(axes[i, m])) for m in range(components)), F.lit(0.0))
        squares.append((F.col(c) - back) * (F.col(c) - back))
    return coded.select("key", (sum(squares, F.lit(0.0)) / len(columns)).alias("mse"))


def flag_top_share(df: DataFrame, scores: Mapping[str, str], contamination: float, inclusive: Sequence[str] = ()) -> DataFrame:
    """Flag the rows above the ``1 - contamination`` quantile of each score.

    ``scores`` maps the score column to the flag column; scores named in
    ``inclusive`` are flagged from the quantile on. Adds ``<flag>_score``, the
    score scaled to 0..1.
    """
    cuts = quantile_row(df, list(scores), {"cut": 1.0 - contamination})
    ends = df.agg(*[a for s in scores for a in (F.min(s).alias(f"{s}_lo"), F.max(s).alias(f"{s}_hi"))])
    q, e = F.col("__cut"), F.col("__end")
    columns = {}
    for s, flag in scores.items():
        above = F.col(s) >= q[f"{s}_cut"] if s in inclusive else F.col(s) > q[f"{s}_cut"]
        columns[flag] = above
        columns[f"{flag}_score"] = (F.col(s) - e[f"{s}_lo"]) / (e[f"{s}_hi"] - e[f"{s}_lo"] + F.lit(1e-9))
    return attach(attach(df, cuts, "__cut"), ends, "__end").withColumns(columns).drop("__cut", "__end")


def anomaly_scores(
    df: DataFrame, key: str, features: Sequence[str] = FEATURES, contamination: float = CONTAMINATION, reconstruction: str = "network"
) -> DataFrame:
    """All three scores, flags and scaled scores per row (settled).

    ``reconstruction``: ``network`` (relu layers of 4, 2 and 4 units) or ``projection`` (two principal components).
    """
    errors = {"network": network_errors, "projection": reconstruction_errors}[reconstruction]
    scaled = settle(scaled_features(df, key, features))
    columns = [f"z_{f}" for f in features]
    scored = settle(
        isolation_scores(scaled, columns)
        .join(lof_scores(scaled, columns), "key")
        .join(errors(scaled, columns), "key")
    )
    names = {"if_score": MODELS[0], "lof": MODELS[1], "mse": MODELS[2]}
    return settle(flag_top_share(scored, names, contamination, inclusive=["mse"]))


def model_overlap(flags: DataFrame, models: Sequence[str] = MODELS) -> DataFrame:
    """One row: flags per model, agreement of the first two, Jaccard and containment."""
    a, b, c = (F.coalesce(F.col(m), F.lit(False)) for m in models)
    n = flags.agg(
        F.count("*").alias("total_rows"),
        count_where(a).alias("first_count"),
        count_where(b).alias("second_count"),
        count_where(c).alias("third_count"),
        count_where(a & b).alias("both_count"),
        count_where(a & b & c).alias("all_three_count"),
        count_where(a | b).alias("first_or_second_count"),
        count_where(a | b | c).alias("any_count"),
        count_where((a.cast("int") + b.cast("int") + c.cast("int")) >= 2).alias("consensus_count"),
    )
    zero = F.lit(0.0)
    jaccard = F.try_divide(F.col("both_count").cast("double"), F.col("first_or_second_count"))
    return n.select(
        "*",
        F.coalesce(percent(F.col("first_count"), F.col("total_rows"), 2), zero).alias("first_pct"),
        F.coalesce(percent(F.col("second_count"), F.col("total_rows"), 2), zero).alias("second_pct"),
        F.coalesce(percent(F.col("third_count"), F.col("total_rows"), 2), zero).alias("third_pct"),
        F.coalesce(F.round(jaccard, 4), zero).alias("jaccard"),
        F.coalesce(percent(F.col("both_count"), F.col("first_count"), 2), zero).alias("pct_first_in_second"),
        F.coalesce(percent(F.col("both_count"), F.col("second_count"), 2), zero).alias("pct_second_in_first"),
    )


def high_value_reasons(columns: Sequence[str], limits: Column) -> Column:
    """Array of reasons: values above the 95th percentile, else a general reason."""
    found = F.array_compact(
        F.array(
            *[
                F.when(F.col(c) > limits[f"{c}_p95"], F.concat(F.lit(f"{c} above its 95th percentile")))
                for c in columns
            ]
        )
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("multi-dimensional outlier")))


def with_reasons(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``reasons`` to rows whose ``columns`` are numeric."""
    limits = quantile_row(df, list(columns), {"p95": 0.95})
    return attach(df, limits, "__p").withColumn("reasons", high_value_reasons(columns, F.col("__p"))).drop("__p")


def anomaly_rows(
    df: DataFrame,
    key: str,
    row_id: str = "id",
    features: Sequence[str] = FEATURES,
    contamination: float = CONTAMINATION,
    scores: DataFrame | None = None,
) -> DataFrame:
    """Rows flagged by any model: values, scores, flags, consensus, reasons."""
    scored = scores if scores is not None else anomaly_scores(df, key, features, contamination)
    values = df.select(
        F.col(key).alias("key"),
        (F.col(row_id).cast("string") if row_id in df.columns else F.col(key).cast("string")).alias("listing_id"),
        *[as_double(df, f, currency=True).alias(f) for f in features],
    )
    reasoned = with_reasons(values, [c for c in REASON_COLUMNS if c in features])
    flagged = scored.where(reduce(lambda a, b: a | b, [F.col(m) for m in MODELS]))
    votes = sum((F.col(m).cast("int") for m in MODELS), F.lit(0))
    return flagged.join(reasoned, "key").select(
        F.col("key").alias(key),
        "listing_id",
        F.struct(*features).alias("feature_values"),
        F.struct("if_score", "lof", "mse", *[f"{m}_score" for m in MODELS]).alias("scores"),
        F.struct(*MODELS).alias("flagged_by"),
        (votes >= 2).alias("anomaly_consensus"),
        "reasons",
    )
