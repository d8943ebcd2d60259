"""Scalers: fit = one aggregate into a one-row parameter table, transform =
a projection after attaching that row (a one-row broadcast).

* robust   (x − median) / (q75 − q25), IQR 0 → divide by 1
* standard (x − mean) / std_pop,       std 0 → divide by 1
* min-max  (x − min) / (max − min + 1e-8)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach_params
from .quantiles import approx_quantiles, exact_quantiles_multi

MINMAX_EPS = 1e-8


def _params_frame(spark: SparkSession, values: dict[str, float]) -> DataFrame:
    schema = T.StructType([T.StructField(k, T.DoubleType(), True) for k in values])
    return spark.createDataFrame([tuple(float(v) if v is not None else None for v in values.values())], schema)


def fit_robust(df: DataFrame, cols: list[str], exact: bool = True,
               accuracy: int = 100_000) -> DataFrame:
    """One row: ``<c>_center`` (median) and ``<c>_scale`` (IQR or 1) per column.

    Exact quantiles use distributed histogram refinement; ``exact=False``
    uses one ``percentile_approx`` pass."""
    vals = {}
    qs = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75]) if exact else {
        c: approx_quantiles(df, c, [0.25, 0.5, 0.75], accuracy) for c in cols}
    for c in cols:
        q25, q50, q75 = qs[c]
        iqr = None if q25 is None else q75 - q25
        vals[f"{c}_center"] = q50
        vals[f"{c}_scale"] = 1.0 if (iqr is None or iqr == 0) else iqr
    return _params_frame(df.sparkSession, vals)


# columns per aggregate: each ``avg`` buffer has two fields and whole-stage
# codegen stops at 100 fields per operator
_AGG_CHUNK = 40


def _chunked_agg(df: DataFrame, exprs: list) -> dict:
    out = {}
    for i in range(0, len(exprs), _AGG_CHUNK):
        out.update(df.agg(*exprs[i:i + _AGG_CHUNK]).first().asDict())
    return out


def fit_standard(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ``<c>_center`` (mean) and ``<c>_scale`` (population std or 1).

    Two narrow aggregates (means, then mean squared deviations around
    them): numerically stable, and each stays inside whole-stage codegen."""
    x = {c: F.col(c).cast("double") for c in cols}
    means = _chunked_agg(df, [F.avg(x[c]).alias(c) for c in cols])
    dev = _chunked_agg(df, [F.avg((x[c] - F.lit(means[c])) ** 2).alias(c) if means[c] is not None
                            else F.lit(None).cast("double").alias(c) for c in cols])
    vals = {}
    for c in cols:
        std = None if dev[c] is None else float(dev[c]) ** 0.5
        vals[f"{c}_center"] = means[c]
        vals[f"{c}_scale"] = 1.0 if not std else std
    return _params_frame(df.sparkSession, vals)


def fit_minmax(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"{c}_min"), F.max(F.col(c).cast("double")).alias(f"{c}_max")]
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, params: DataFrame, cols: list[str], suffix: str = "_scaled",
                 sources: dict[str, str] | None = None) -> DataFrame:
    """``out = (x − center) / scale`` for every column; ``sources`` maps an
    output base name to the input column when they differ."""
    sources = sources or {}
    p = params.select(*[F.col(f"{c}_center").alias(f"__{c}_center") for c in cols],
                      *[F.col(f"{c}_scale").alias(f"__{c}_scale") for c in cols])
    out = attach_params(df, p)
    for c in cols:
        src = F.col(sources.get(c, c)).cast("double")
        out = out.withColumn(f"{c}{suffix}", (src - F.col(f"__{c}_center")) / F.col(f"__{c}_scale"))
    return out.drop(*[f"__{c}_center" for c in cols], *[f"__{c}_scale" for c in cols])


def apply_minmax(df: DataFrame, params: DataFrame, cols: list[str], suffix: str = "_norm",
                 negate: set[str] | None = None) -> DataFrame:
    """(x − min)/(max − min + eps); a column in ``negate`` is scaled as −x
    (its min/max are those of x, so −x has min = −max)."""
    negate = negate or set()
    p = params.select(*[F.col(f"{c}_min").alias(f"__{c}_min") for c in cols],
                      *[F.col(f"{c}_max").alias(f"__{c}_max") for c in cols])
    out = attach_params(df, p)
    for c in cols:
        x, lo, hi = F.col(c).cast("double"), F.col(f"__{c}_min"), F.col(f"__{c}_max")
        if c in negate:
            x, lo, hi = -x, -hi, -lo
        out = out.withColumn(f"{c}{suffix}", (x - lo) / (hi - lo + F.lit(MINMAX_EPS)))
    return out.drop(*[f"__{c}_min" for c in cols], *[f"__{c}_max" for c in cols])


def minmax(df: DataFrame, cols: list[str], suffix: str = "_norm", negate: set[str] | None = None) -> DataFrame:
    return apply_minmax(df, fit_minmax(df, cols), cols, suffix, negate)
