"""The serving chain as one PipelineModel: saved, loaded, bit-equal."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from txnlens.operators.chain import FeatureScaling, ForestOutliers, ReconstructionErrors, chain
from txnlens.operators.ensemble import fit_ensemble
from txnlens.operators.ensemble_features import apply_score_range, fit_score_range
from txnlens.operators.graph_model import fit_graph_classifier, graph_features, graph_scores
from txnlens.session import materialize
from txnlens.streaming.scoring import ScoringModels, score_frame


def scores(df):
    return {r["id"]: (r["prediction"], r["confidence"], r["iso_score"]) for r in df.select("id", "prediction", "confidence", "iso_score").collect()}


def test_saved_chain_gives_equal_scores(spark, tmp_root):
    df = spark.range(240).select("id", (F.col("id") * 400.0).alias("Time"), (F.rand(3) * 90 + 1).alias("Amount"),
                                 F.randn(4).alias("V1"), F.randn(5).alias("V2"), (F.col("id") % 6 == 0).cast("int").alias("Class"))
    df = materialize(df, "chain-test")
    learned = Pipeline(stages=[FeatureScaling(), ForestOutliers(n_trees=12, max_samples=64), ReconstructionErrors(k=2)]).fit(df)
    scaler, forest, recon = (s.model for s in learned.stages)
    s = materialize(learned.transform(df), "chain-scores")
    h = materialize(graph_features(s.select("id", "Time", "Amount", *[c for c in forest.features if c not in ("Time", "Amount")]), forest.features), "chain-h")
    label = df.select("id", "Class")
    graph = fit_graph_classifier(h.join(label, "id"), forest.features, max_iter=5)
    both = materialize(s.join(graph_scores(graph, h).select("id", "graph_score"), "id"), "chain-both")
    span = fit_score_range(both)
    ensemble = fit_ensemble(apply_score_range(both, span), "lr", {"C": 1.0})
    models = ScoringModels(scaler, forest, ensemble, recon, graph, span)
    want = scores(score_frame(df, models))
    whole = chain(scaler, forest, recon, graph, span, ensemble)
    whole.write().overwrite().save(f"{tmp_root}/chain")
    loaded = PipelineModel.load(f"{tmp_root}/chain")
    assert [type(x) for x in loaded.stages] == [type(x) for x in whole.stages] and [x.uid for x in loaded.stages] == [x.uid for x in whole.stages]
    assert len(want) == 240 and scores(loaded.transform(df)) == want
    # without one of the parts the forest serves alone
    alone = chain(scaler, forest, recon, None, span, ensemble)
    alone.write().overwrite().save(f"{tmp_root}/alone")
    got = scores(PipelineModel.load(f"{tmp_root}/alone").transform(df))
    assert got == scores(score_frame(df, ScoringModels(scaler, forest))) and all(c == abs(i) for _, c, i in got.values())
