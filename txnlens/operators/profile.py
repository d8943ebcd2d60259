"""Profiling aggregates: class balance, hourly pivots, correlations,
histograms. Every operator is one or two hash aggregates with map-side
partial aggregation; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hour_bucket, hour_of_day
from .common import attach_params, join_small


def class_counts(df: DataFrame, label: str = "Class") -> DataFrame:
    """(label, n, pct): rows per class and their share in percent."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # the grouped table has one row per class; the empty window is over it
    total = F.sum("n").over(Window.partitionBy())
    return g.withColumn("pct", F.lit(100.0) * F.col("n") / total)


def positive_rate(df: DataFrame, label: str = "Class") -> DataFrame:
    """One row: rows, positives, positive rate in percent."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(label).cast("long").alias("n_pos"),
                  (F.avg(label) * F.lit(100.0)).alias("pos_rate_pct"))


def with_hour(df: DataFrame, time_col: str = "Time", exact: bool = False) -> DataFrame:
    """Adds ``Hour`` (fractional) and ``hour_bucket`` (0..23)."""
    out = df.withColumn("Hour", hour_of_day(time_col))
    return out if exact else out.withColumn("hour_bucket", hour_bucket(time_col))


def hourly_class_pivot(df: DataFrame, label: str = "Class", time_col: str = "Time",
                       exact: bool = False, classes=(0, 1)) -> DataFrame:
    """Hour × class counts, missing cells 0. ``exact`` groups by the
    fractional Hour as the reference does; default is the whole hour."""
    key = "Hour" if exact else "hour_bucket"
    h = with_hour(df, time_col, exact)
    p = h.groupBy(key).pivot(label, list(classes)).agg(F.count(F.lit(1))).na.fill(0)
    return p.select(key, *[F.col(str(c)).cast("long").alias(f"n_class{c}") for c in classes])


def hourly_positive_rate(df: DataFrame, label: str = "Class", time_col: str = "Time",
                         exact: bool = False) -> DataFrame:
    key = "Hour" if exact else "hour_bucket"
    h = with_hour(df, time_col, exact)
    return h.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("pos_rate"))


def label_correlations(df: DataFrame, features: list[str], label: str = "Class") -> DataFrame:
    """Pearson correlation of each feature with the label, ranked by |corr|.

    The features are unpivoted to (feature, x, y) rows and aggregated by
    feature: one small ``corr`` buffer per group keeps the aggregate inside
    whole-stage codegen (a wide row of many ``corr`` buffers exceeds the
    codegen field limit) and the partial aggregates are map-side, so only
    one row per feature and partition is shuffled. The label is never part
    of the unpivot.
    """
    y = F.col(label).cast("double").alias("_y")
    long = df.select(y, *[F.col(f).cast("double").alias(f) for f in features]) \
             .unpivot(["_y"], features, "feature", "_x")
    corr = long.groupBy("feature").agg(F.corr("_x", "_y").alias("corr"))
    w = Window.orderBy(F.abs(F.col("corr")).desc_nulls_last(), F.col("feature"))
    # one row per feature: the global window is over a tiny table
    return corr.withColumn("rank", F.row_number().over(w))


def top_features(corr: DataFrame, k: int = 10, skip: int = 0) -> DataFrame:
    """Ranks skip+1 .. skip+k of a correlation ranking."""
    return corr.where((F.col("rank") > skip) & (F.col("rank") <= skip + k))


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None,
              density: bool = False) -> DataFrame:
    """Equal-width histogram with the range taken per subset (``by``).

    Bin i covers [lo + i·w, lo + (i+1)·w); the last bin is closed. A constant
    subset gets the range (x − 0.5, x + 0.5). Output: (by, bin, lo, hi,
    bin_lo, bin_hi, n[, density]). Two aggregates: the per-subset range
    (one row per subset) and the (subset, bin) counts. A NULL subset is one
    of its own; NULL, NaN and infinite values fall in no bin.
    """
    keys = [by] if by else []
    x = F.col(value).cast("double")
    data = df.select(*keys, x.alias("_x")).where(F.abs("_x") < float("inf"))
    rng = data.groupBy(*keys).agg(F.min("_x").alias("_min"), F.max("_x").alias("_max"), F.count(F.lit(1)).alias("_n"))
    rng = rng.select(*keys, "_n",
                     F.when(F.col("_min") == F.col("_max"), F.col("_min") - 0.5).otherwise(F.col("_min")).alias("lo"),
                     F.when(F.col("_min") == F.col("_max"), F.col("_max") + 0.5).otherwise(F.col("_max")).alias("hi"))
    # one row per subset: size-checked broadcast (a single row when no ``by``)
    if keys:
        side = rng.withColumnRenamed(by, "_subset")
        joined = join_small(data, side, data[by].eqNullSafe(side["_subset"])).drop("_subset")
    else:
        joined = attach_params(data, rng)
    b = F.least(F.floor((F.col("_x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(bins)),
                F.lit(bins - 1)).cast("int")
    counts = joined.groupBy(*keys, b.alias("bin"), "lo", "hi", "_n").agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    out = counts.select(*keys, "bin", "lo", "hi",
                        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                        F.col("n"), "_n")
    if density:
        out = out.withColumn("density", F.col("n") / (F.col("_n") * width))
    return out.drop("_n")


def top_feature_histograms(df: DataFrame, corr: DataFrame, features: list[str], k: int = 8, bins: int = 50,
                           label: str = "Class") -> DataFrame:
    """Per-class histograms of the k features most correlated with the label
    (the first k of ``corr``): feature, rank, label and the columns of
    ``histogram``. The few features are unpivoted, so one pass counts them."""
    top = {r["feature"]: r["rank"] for r in top_features(corr, k).collect()}
    names = [f for f in features if f in top]
    long = df.select(F.col(label), *[F.col(f).cast("double").alias(f) for f in names]).unpivot([label], names, "feature", "_v")
    long = long.withColumn("_by", F.struct("feature", label))
    h = histogram(long, "_v", bins, by="_by")
    rank = F.lit(None).cast("int")
    for f in names:
        rank = F.when(F.col("_by.feature") == f, F.lit(top[f])).otherwise(rank)
    return h.select(F.col("_by.feature").alias("feature"), rank.cast("int").alias("rank"), F.col(f"_by.{label}").alias(label), *[c for c in h.columns if c != "_by"])
