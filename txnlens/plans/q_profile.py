"""Profiling queries: class balance, hourly pivots, correlations,
histograms, scalers and engineered features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import profile, scaling
from ..operators.features import engineer_features, fit_feature_scaler
from ..session import materialize
from ..sources.tables import ORACLE_WIDTH, txn, txn_ml, with_views
from .catalog import R, register

VCOLS = [f"V{i}" for i in range(1, ORACLE_WIDTH + 1)]  # of the SQL texts


# -- A1/A2/A3 ------------------------------------------------------------------

@register("class_balance", "A1 A2", with_views(f"""
SELECT Class, count(*) AS n, {R('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct
FROM txn GROUP BY Class"""))
def class_balance(spark, sf):
    c = profile.class_counts(txn(spark, sf))
    return c.select("Class", "n", rounded("pct").alias("pct"))


@register("positive_rate", "A1 A3", with_views(f"""
SELECT count(*) AS n_rows, CAST(sum(Class) AS BIGINT) AS n_pos, {R('avg(Class) * 100.0')} AS pos_rate_pct
FROM txn"""))
def positive_rate(spark, sf):
    r = profile.positive_rate(txn(spark, sf))
    return r.select("n_rows", "n_pos", rounded("pos_rate_pct").alias("pos_rate_pct"))


# -- P2 + A4/A5: the minimum slice --------------------------------------------

HOUR_SQL = "((Time / 3600.0) % 24.0)"


@register("hourly_class_pivot", "P2 A4", with_views(f"""
SELECT CAST(floor({HOUR_SQL}) AS INTEGER) AS hour_bucket,
       count(*) FILTER (WHERE Class = 0) AS n_class0,
       count(*) FILTER (WHERE Class = 1) AS n_class1
FROM txn GROUP BY 1"""))
def hourly_class_pivot(spark, sf):
    return profile.hourly_class_pivot(txn(spark, sf))


@register("hourly_class_pivot_exact", "P2 A4", with_views(f"""
SELECT {R(HOUR_SQL)} AS Hour,
       count(*) FILTER (WHERE Class = 0) AS n_class0,
       count(*) FILTER (WHERE Class = 1) AS n_class1
FROM txn GROUP BY {HOUR_SQL}"""))
def hourly_class_pivot_exact(spark, sf):
    p = profile.hourly_class_pivot(txn(spark, sf), exact=True)
    return p.select(rounded("Hour").alias("Hour"), "n_class0", "n_class1")


@register("hourly_positive_rate", "P2 A5", with_views(f"""
SELECT CAST(floor({HOUR_SQL}) AS INTEGER) AS hour_bucket, count(*) AS n, {R('avg(Class)')} AS pos_rate
FROM txn GROUP BY 1"""))
def hourly_positive_rate(spark, sf):
    r = profile.hourly_positive_rate(txn(spark, sf))
    return r.select("hour_bucket", "n", rounded("pos_rate").alias("pos_rate"))


# -- A6 / T2 -------------------------------------------------------------------

_CORR_UNPIVOT = " UNION ALL ".join(
    f"SELECT '{v}' AS feature, corr({v}, CAST(Class AS DOUBLE)) AS c FROM txn_ml" for v in VCOLS)
CORR_SQL = with_views(f"""
WITH cs AS ({_CORR_UNPIVOT}),
ranked AS (SELECT feature, c, row_number() OVER (ORDER BY abs(c) DESC NULLS LAST, feature) AS rnk FROM cs)
SELECT feature, {R('c')} AS corr, CAST(rnk AS INTEGER) AS rank FROM ranked""", ml=True)


def _corr(spark, sf):
    t = txn_ml(spark, sf)
    return profile.label_correlations(t, [c for c in t.columns if c.startswith("V")])


@register("feature_label_correlation", "P1 A6", CORR_SQL)
def feature_label_correlation(spark, sf):
    c = _corr(spark, sf)
    return c.select("feature", rounded("corr").alias("corr"), F.col("rank").cast("int").alias("rank"))


@register("top_correlated_features", "A6 T2",
          f"SELECT * FROM ({CORR_SQL}) q WHERE rank <= 10")
def top_correlated_features(spark, sf):
    c = profile.top_features(_corr(spark, sf), k=10)
    return c.select("feature", rounded("corr").alias("corr"), F.col("rank").cast("int").alias("rank"))


# -- A8 / A9 -------------------------------------------------------------------

def _hist_sql(value: str, bins: int, density: bool, source: str = "txn", ml: bool = False) -> str:
    dens = f", {R('n / (cnt * ((hi - lo) / %d.0))' % bins)} AS density" if density else ""
    return with_views(f"""
WITH d AS (SELECT Class, CAST({value} AS DOUBLE) AS x FROM {source} WHERE {value} IS NOT NULL),
r AS (SELECT Class, count(*) AS cnt,
             CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
      FROM d GROUP BY Class),
b AS (SELECT d.Class, CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin,
             lo, hi, cnt FROM d JOIN r USING (Class)),
c AS (SELECT Class, bin, lo, hi, cnt, count(*) AS n FROM b GROUP BY Class, bin, lo, hi, cnt)
SELECT Class, bin, {R('lo + bin * ((hi - lo) / %d.0)' % bins)} AS bin_lo,
       {R('lo + (bin + 1) * ((hi - lo) / %d.0)' % bins)} AS bin_hi, n{dens}
FROM c""", ml=ml)


def _hist(df, value, bins, density):
    h = profile.histogram(df, value, bins, by="Class", density=density)
    cols = ["Class", "bin", rounded("bin_lo").alias("bin_lo"), rounded("bin_hi").alias("bin_hi"), "n"]
    if density:
        cols.append(rounded("density").alias("density"))
    return h.select(*cols)


@register("amount_histogram", "P4 A8", _hist_sql("Amount", 50, False))
def amount_histogram(spark, sf):
    return _hist(txn(spark, sf), "Amount", 50, False)


@register("amount_density", "A8 A9", _hist_sql("Amount", 50, True))
def amount_density(spark, sf):
    return _hist(txn(spark, sf), "Amount", 50, True)


@register("feature_histogram_v1", "A8", _hist_sql("V1", 50, False, "txn_ml", ml=True))
def feature_histogram_v1(spark, sf):
    return _hist(txn_ml(spark, sf), "V1", 50, False)


@register("top_feature_histograms", "T2 A6 A8", with_views(f"""
WITH c AS ({" UNION ALL ".join(f"SELECT '{v}' AS feature, corr({v}, CAST(Class AS DOUBLE)) AS c FROM txn_ml" for v in VCOLS)}),
k AS (SELECT feature, row_number() OVER (ORDER BY abs(c) DESC, feature) AS rank FROM c QUALIFY rank <= 8),
l AS (SELECT feature, rank, Class, x FROM (UNPIVOT (SELECT Class, {", ".join(VCOLS)} FROM txn_ml) ON {", ".join(VCOLS)} INTO NAME feature VALUE x) JOIN k USING (feature)),
r AS (SELECT feature, Class, min(x) AS lo, max(x) AS hi FROM l GROUP BY ALL),
b AS (SELECT feature, rank, Class, lo, hi, CAST(least(floor((x - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin FROM l JOIN r USING (feature, Class))
SELECT feature, CAST(any_value(rank) AS INTEGER) AS rank, Class, bin, count(*) AS n,
       {R('any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / 20)')} AS bin_lo FROM b GROUP BY feature, Class, bin""", ml=True))
def top_feature_histograms(spark, sf):
    t = txn_ml(spark, sf)
    cols = [c for c in t.columns if c.startswith("V")]
    h = profile.top_feature_histograms(t, profile.label_correlations(t, cols), cols, 8, bins=20)
    return h.select("feature", "rank", "Class", "bin", "n", rounded("bin_lo").alias("bin_lo"))


# -- N1 / N2 / N3, P1-P3, P9 ---------------------------------------------------

_ROBUST_PARAMS = """SELECT
  quantile_cont(Amount, 0.5) AS a_c,
  CASE WHEN quantile_cont(Amount, 0.75) - quantile_cont(Amount, 0.25) = 0 THEN 1.0
       ELSE quantile_cont(Amount, 0.75) - quantile_cont(Amount, 0.25) END AS a_s,
  quantile_cont(Time, 0.5) AS t_c,
  CASE WHEN quantile_cont(Time, 0.75) - quantile_cont(Time, 0.25) = 0 THEN 1.0
       ELSE quantile_cont(Time, 0.75) - quantile_cont(Time, 0.25) END AS t_s
FROM txn"""


@register("robust_scaled", "N1 J5", with_views(f"""
WITH p AS ({_ROBUST_PARAMS})
SELECT id, {R('(Amount - a_c) / a_s')} AS Amount_scaled, {R('(Time - t_c) / t_s')} AS Time_scaled
FROM txn CROSS JOIN p"""))
def robust_scaled(spark, sf):
    t = txn(spark, sf)
    s = scaling.apply_scaler(t, fit_feature_scaler(t), ["Amount", "Time"])
    return s.select("id", rounded("Amount_scaled").alias("Amount_scaled"), rounded("Time_scaled").alias("Time_scaled"))


_ENG_COLS = ", ".join(f"{R(v)} AS {v}" for v in VCOLS)


@register("engineered_features", "P1 P2 P3 N1 P9", with_views(f"""
WITH p AS ({_ROBUST_PARAMS.replace('FROM txn', 'FROM txn_ml')})
SELECT id, Class, {_ENG_COLS},
       {R('(Amount - a_c) / a_s')} AS Amount_scaled, {R('(Time - t_c) / t_s')} AS Time_scaled,
       {R(HOUR_SQL)} AS Hour, {R('ln(1 + Amount)')} AS Amount_log
FROM txn_ml CROSS JOIN p""", ml=True))
def engineered_features(spark, sf):
    # fitted on the rows it transforms, read once into a narrow table
    narrow = materialize(txn_ml(spark, sf, 0).select("Amount", "Time"), "scaler-rows")
    f = engineer_features(txn_ml(spark, sf), fit_feature_scaler(narrow), keep=["id", "Class"])
    return f.select("id", "Class", *[rounded(c).alias(c) for c in f.columns if c not in ("id", "Class")])


@register("standard_scaled", "N2 J5", with_views(f"""
WITH p AS (SELECT avg(Amount) AS a_m, CASE WHEN stddev_pop(Amount) = 0 THEN 1.0 ELSE stddev_pop(Amount) END AS a_s,
                  avg(Time) AS t_m, CASE WHEN stddev_pop(Time) = 0 THEN 1.0 ELSE stddev_pop(Time) END AS t_s FROM txn)
SELECT id, {R('(Amount - a_m) / a_s')} AS Amount_std, {R('(Time - t_m) / t_s')} AS Time_std
FROM txn CROSS JOIN p"""))
def standard_scaled(spark, sf):
    t = txn(spark, sf)
    s = scaling.apply_scaler(t, scaling.fit_standard(t, ["Amount", "Time"]), ["Amount", "Time"], suffix="_std")
    return s.select("id", rounded("Amount_std").alias("Amount_std"), rounded("Time_std").alias("Time_std"))


@register("minmax_scaled", "N3 J5", with_views(f"""
WITH p AS (SELECT min(Amount) AS a0, max(Amount) AS a1, min(Time) AS t0, max(Time) AS t1 FROM txn)
SELECT id, {R('(Amount - a0) / (a1 - a0 + 1e-8)')} AS Amount_norm, {R('(Time - t0) / (t1 - t0 + 1e-8)')} AS Time_norm
FROM txn CROSS JOIN p"""))
def minmax_scaled(spark, sf):
    s = scaling.minmax(txn(spark, sf), ["Amount", "Time"])
    return s.select("id", rounded("Amount_norm").alias("Amount_norm"), rounded("Time_norm").alias("Time_norm"))


# -- A7: exact percentiles -------------------------------------------------------

@register("amount_percentiles", "A7", with_views(f"""
SELECT {R('quantile_cont(Amount, 0.25)')} AS p25, {R('quantile_cont(Amount, 0.5)')} AS p50,
       {R('quantile_cont(Amount, 0.75)')} AS p75, {R('quantile_cont(Amount, 0.95)')} AS p95,
       {R('quantile_cont(Time, 0.5)')} AS time_p50 FROM txn"""))
def amount_percentiles(spark, sf):
    from ..operators.quantiles import exact_quantiles_multi
    from ..operators.scaling import _params_frame

    t = txn(spark, sf)
    q = exact_quantiles_multi(t, ["Amount", "Time"], [0.25, 0.5, 0.75, 0.95])
    p = _params_frame(spark, {"p25": q["Amount"][0], "p50": q["Amount"][1], "p75": q["Amount"][2],
                              "p95": q["Amount"][3], "time_p50": q["Time"][1]})
    return p.select(*[rounded(c).alias(c) for c in p.columns])


@register("amount_sketch_ranks", "A7 N1", with_views(f"""
WITH q AS (SELECT unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS q)
SELECT CAST(q AS DOUBLE) AS q, (SELECT count(Amount) FROM txn WHERE NOT isnan(Amount)) AS n, true AS within,
       CASE WHEN q = 0 THEN {R('(SELECT min(Amount) FROM txn WHERE NOT isnan(Amount))')}
            WHEN q = 1 THEN {R('(SELECT max(Amount) FROM txn WHERE NOT isnan(Amount))')} END AS exact_end FROM q"""))
def amount_sketch_ranks(spark, sf):
    """Percentiles from the merged sketches of each hour's rows, and whether
    their ranks among all rows lie within the bound."""
    from ..operators import sketches as sk

    t = txn(spark, sf).withColumn("hour", F.floor(F.col("Time") / 3600.0))
    parts = materialize(sk.sketches(t, ["Amount"], "hour"), "sketches")
    values = sk.quantiles(parts, [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0])
    e = sk.rank_errors(t, "Amount", values)
    return e.select("q", "n", (F.col("error") <= sk.rank_bound()).alias("within"),
                    F.when(F.col("q").isin(0.0, 1.0), rounded("value")).alias("exact_end"))


# -- A10: per-row mean squared error of arrays ------------------------------------

@register("vector_centroid_mse", "A10 A15", """
WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
                  generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY label, i)
SELECT vec_id, label, round(avg((x - m) * (x - m)), 6) + 0.0 AS mse FROM e JOIN c USING (label, i)
GROUP BY vec_id, label""")
def vector_centroid_mse(spark, sf):
    from ..functions.columns import mean_squared_error
    from ..operators.common import join_small
    from ..sources.tables import table

    emb = table(spark, sf, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    parts = emb.select("label", F.posexplode("v").alias("i", "x"))
    cent = parts.groupBy("label", "i").agg(F.avg("x").alias("m"))
    # one array per label: bounded by the vector width
    cent = cent.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("s")) \
               .select("label", F.transform("s", lambda s: s["m"]).alias("centroid"))
    j = join_small(emb, cent, ["label"])
    return j.select("vec_id", "label", rounded(mean_squared_error("v", "centroid")).alias("mse"))
