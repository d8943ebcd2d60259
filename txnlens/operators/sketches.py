"""Mergeable quantile sketches (KLL): percentiles refreshed without a reread.

Each part of the data (a file, a day, a micro-batch) leaves one small sketch a
column in a written table, made with map-side partial aggregates; a scaler or a
threshold comes from the merge of the sketches alone. The exact way
(``quantiles``) stays the default everywhere; this one is for callers who can't
read all data again.

Rank bound: for size k the share of rows below a sketched quantile is off by at
most 2.296 / k^0.9021 in 99 of 100 sketches, whatever the number of rows
and merges (the single-sided bound published with the algorithm); ``rank_bound``
gives twice that. Minimum and maximum are exact. Sketches are randomised, so
values between them differ from run to run, within the bound.

NULL and NaN are left out; a part without values leaves no sketch, and without a
sketch there are no quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import complete_rows

SIZE = 1000


def rank_bound(size: int = SIZE) -> float:
    return 2 * 2.296 / size ** 0.9021


def sketches(df: DataFrame, columns: list[str], part: str | None = None, size: int = SIZE) -> DataFrame:
    """(part, column, n, sketch): one row a part and column with values.
    ``part`` names the column that tells the parts apart (None: one part)."""
    key = F.col(part) if part else F.lit(None).cast("string")
    long = df.select(key.alias("part"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("_v")).select("part", "_v.*")
    return complete_rows(long, ["x"]).groupBy("part", "column").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("x", size).alias("sketch"))


def write_sketches(df: DataFrame, columns: list[str], path: str, batch_id: int, size: int = SIZE) -> None:
    """The sketches of one batch; a replay of the batch overwrites them."""
    sketches(df, columns, None, size).drop("part").write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column string, n long, sketch binary, batch_id long").parquet(path)


def merged(parts: DataFrame) -> DataFrame:
    """(column, n, sketch) over all parts; the order of the merge does not
    matter for the bound."""
    return parts.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(parts: DataFrame, probabilities: list[float]) -> DataFrame:
    """(column, n, q, value) from sketches alone, a row a probability."""
    each = [F.struct(F.lit(float(p)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probabilities]
    return merged(parts).select("column", "n", F.explode(F.array(*each)).alias("_r")).select("column", "n", "_r.*")


def robust_params(parts: DataFrame, columns: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """Per column the median and the distance of the quartiles, as a robust
    scaler needs them: two numbers a column, from the sketches."""
    got: dict[str, dict[float, float]] = {}
    for r in quantiles(parts, [0.25, 0.5, 0.75]).collect():  # three rows a column
        got.setdefault(r["column"], {})[r["q"]] = r["value"]
    return {c: (got[c][0.5], got[c][0.75] - got[c][0.25]) if c in got else (None, None) for c in columns}


def rank_errors(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """(q, n, value, error): how far the share of rows below each value is
    from q. Ties make a range of shares; the distance to it counts."""
    x = complete_rows(df.select(F.col(column).cast("double").alias("x")), ["x"])
    v = values.select(F.sort_array(F.collect_list(F.struct("q", "value"))).alias("vs")).first()["vs"]  # as many as probabilities
    below = [F.sum((F.col("x") < F.lit(r["value"])).cast("long")).alias(f"b{i}") for i, r in enumerate(v)]
    upto = [F.sum((F.col("x") <= F.lit(r["value"])).cast("long")).alias(f"u{i}") for i, r in enumerate(v)]
    row = x.agg(F.count(F.lit(1)).alias("n"), *below, *upto)
    rows = F.array(*[F.struct(F.lit(r["q"]).alias("q"), F.lit(r["value"]).alias("value"), F.col(f"b{i}").alias("b"), F.col(f"u{i}").alias("u"))
                     for i, r in enumerate(v)])
    out = row.select("n", F.explode(rows).alias("r")).select("n", "r.*")
    error = F.greatest(F.lit(0.0), F.col("b") / F.col("n") - F.col("q"), F.col("q") - F.col("u") / F.col("n"))
    return out.select("q", "n", "value", error.alias("error"))
