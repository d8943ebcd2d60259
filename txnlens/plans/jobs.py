"""End-to-end Spark jobs (the application flows): preprocess → train →
score a stream → monitor. Each step reads and writes Parquet/JSON under a
root folder, keyed by ``id``; nothing passes through driver memory except
fitted parameters of bounded size.

    python -m txnlens.plans.jobs preprocess <transactions.csv> <root>
    python -m txnlens.plans.jobs profile <transactions.csv> <root>
    python -m txnlens.plans.jobs train <root>
    python -m txnlens.plans.jobs score <stream dir> <root>
    python -m txnlens.plans.jobs monitor <root>
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ensemble, forest, metrics, monitor, profile, reconstruct, resample, sampling
from ..operators.ensemble_features import align_scores, apply_score_range, fit_score_range
from ..schemas import ENSEMBLE_FEATURES
from ..operators.features import engineer_features, feature_columns, fit_feature_scaler
from ..operators.graph_model import fit_graph_classifier, graph_features, graph_scores
from ..sources.files import read_features, write_features, write_report
from ..sources.models import ModelSet, load_models, save_models, save_params
from ..streaming.scoring import ScoringModels, read_monitoring, start_scoring, transaction_stream


def preprocess(spark: SparkSession, txn: DataFrame, root: str, seed: int = 42, balance: bool = False) -> DataFrame:
    """Scale (fit on the training part), derive, split, optionally over-sample, save."""
    split = sampling.stratified_split(txn, 0.2, "Class", seed=seed)
    scaler = fit_feature_scaler(split.where(F.col("split") == "train"))
    feats = engineer_features(split, scaler, keep=["id", "Time", "Amount", "Class", "split"])
    write_features(feats, f"{root}/features")
    save_params(scaler, f"{root}/models/scaler")
    if balance:
        train = read_features(spark, f"{root}/features", "train")
        cols = feature_columns(train)
        bal = resample.smote(train, cols, "Class", 1, k=5, seed=seed)
        write_features(bal.withColumn("split", F.lit("balanced")), f"{root}/balanced")
    return read_features(spark, f"{root}/features")


def profile_reports(spark: SparkSession, txn: DataFrame, root: str) -> None:
    """The tables behind the profiling charts."""
    write_report(profile.class_counts(txn), root, "class_distribution")
    write_report(profile.hourly_class_pivot(txn), root, "hourly_counts")
    write_report(profile.hourly_positive_rate(txn), root, "hourly_rate")
    write_report(profile.histogram(txn, "Amount", 50, by="Class"), root, "amount_distribution")
    vcols = [c for c in txn.columns if c.startswith("V")]
    if vcols:
        corr = profile.label_correlations(txn, vcols)
        write_report(corr, root, "feature_correlation")
        write_report(profile.top_feature_histograms(txn, corr, vcols, 8), root, "top_feature_distributions")


def train(spark: SparkSession, root: str, n_trees: int = 100, seed: int = 42, search_trials: int = 20) -> ModelSet:
    feats = read_features(spark, f"{root}/features")
    cols = feature_columns(feats)
    tr = feats.where(F.col("split") == "train")
    te = feats.where(F.col("split") == "test")
    iso = forest.fit_isolation_forest(tr, cols, n_trees=n_trees, seed=seed)
    rec = reconstruct.fit_reconstruction(tr.where(F.col("Class") == 0), cols, k=16)
    # graph scores on the test rows, propagated over their own similarity graph
    h = graph_features(te.select("id", "Time", "Amount", *cols), cols, hops=3)
    g_model = fit_graph_classifier(graph_features(tr.select("id", "Time", "Amount", *cols), cols, hops=3)
                                   .join(tr.select("id", "Class"), "id"), cols)
    g = graph_scores(g_model, h.join(te.select("id", "Class"), "id")).select("id", "Class", "graph_score")
    r = reconstruct.reconstruction_score(te, rec).select("id", "reconstruction_score", "reconstruction_pred")
    i = forest.score_isolation_forest(te, iso).select("id", "iso_score", "iso_pred")
    scores = align_scores(g, r, i)
    write_features(scores, f"{root}/scores", partition_by=None)
    scores = read_features(spark, f"{root}/scores")
    span = fit_score_range(scores)
    ens = apply_score_range(scores, span).select("id", "Class", *ENSEMBLE_FEATURES)
    write_report(profile.histogram(reconstruct.reconstruction_score(tr, rec), "reconstruction_score", 50, by="Class", density=True),
                 root, "reconstruction_error_density")
    parts = sampling.stratified_split(ens, 0.3, "Class", seed=seed)
    fit_part = parts.where(F.col("split") == "train").drop("split")
    trials = ensemble.search(sampling.stratified_folds(fit_part, 3, seed=seed), n_trials=search_trials)
    best = ensemble.best_trial(trials).first().asDict()
    model = ensemble.fit_ensemble(fit_part, best["model"], best, seed=seed)
    test = ensemble.predict_proba(model, parts.where(F.col("split") == "test"))
    write_report(trials, root, "ensemble_trials")
    write_report(metrics.model_comparison(test, {
        "graph": ("graph_score", False), "reconstruction": ("reconstruction_norm", False),
        "isolation_forest": ("iso_norm", False), "ensemble": ("ensemble_prob", False)}), root, "model_comparison")
    imp = ensemble.feature_importance(model)
    if imp is not None:
        write_report(imp, root, "ensemble_feature_importance")
    ms = ModelSet(read_features(spark, f"{root}/models/scaler"), iso, rec, model, cols, g_model, span)
    save_models(spark, ms, f"{root}/models", write_scaler=False)  # saved by preprocess
    return ms


def score_stream(spark: SparkSession, source: str, root: str, schema, fmt: str = "parquet"):
    ms = load_models(spark, f"{root}/models")
    q = start_scoring(transaction_stream(spark, source, schema, fmt), ScoringModels(ms.scaler, ms.forest, ms.ensemble, ms.reconstruction, ms.graph, ms.score_range),
                      f"{root}/logs", f"{root}/logs/_checkpoint", available_now=True)
    q.awaitTermination()


def monitor_reports(spark: SparkSession, root: str) -> None:
    alerts, stats, cases = read_monitoring(spark, f"{root}/logs")
    write_report(monitor.alert_summary(alerts), root, "alert_summary")
    write_report(monitor.overall_rate(stats), root, "overall_rate")
    write_report(monitor.recent_alerts(alerts), root, "recent_alerts")
    write_report(profile.histogram(alerts, "confidence", 20), root, "confidence_histogram")
    write_report(stats, root, "batch_stats")
    write_report(cases.agg(F.count(F.lit(1)).alias("n_cases")), root, "stream_cases")


def main(argv: list[str]) -> None:
    from ..session import get_spark
    from ..sources.files import read_transactions_csv

    spark = get_spark("txnlens-jobs")
    cmd = argv[0]
    if cmd == "preprocess":
        preprocess(spark, read_transactions_csv(spark, argv[1]), argv[2])
    elif cmd == "profile":
        profile_reports(spark, read_transactions_csv(spark, argv[1]), argv[2])
    elif cmd == "train":
        train(spark, argv[1])
    elif cmd == "score":
        schema = spark.read.parquet(argv[1]).schema
        score_stream(spark, argv[1], argv[2], schema)
    elif cmd == "monitor":
        monitor_reports(spark, argv[1])
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
