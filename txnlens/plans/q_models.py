"""Model queries (randomised / iterative: rows-only checks). Training rows
are the 'train' part of the stratified 80/20 split of the vectors of txn_ml;
every row of the table is scored."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..functions.columns import hour_of_day, rounded
from ..operators import autoencoder, ensemble, forest, graph_model, graph_network, metrics, reconstruct, sampling, tuning
from ..operators.features import LateFeatures, engineer_features, feature_columns, fit_feature_scaler
from ..session import default_parallelism
from ..sources.tables import ORACLE_WIDTH, txn, txn_ml, txn_ml_kept, txn_ml_keyed, with_views
from .catalog import REGISTRY, R, register
from .q_graph import _sql as _graph_sql
from .q_scores import _auc_sql, scores
from .q_scores import _sql as _scores_sql


def features_with_split(spark, sf):
    """The working set of a training job: vectors are split as groups, the
    scaler is fitted on the training part. The models that read it are
    CPU-bound, so it is spread over the tasks once: as narrow events, to which
    every reader joins the vectors, or as wide rows if these aren't broadcast."""
    t, narrow = txn_ml_kept(spark, sf)
    t = sampling.grouped_split(t, "vec_id", 0.2, "Class", seed=42)
    scaler = fit_feature_scaler(t.where(F.col("split") == "train"))
    f = engineer_features(t, scaler, keep=["id", "vec_id", "Time", "Amount", "Class", "split"])
    s = f if narrow else f.repartition(default_parallelism(spark)).persist(StorageLevel.MEMORY_AND_DISK)
    return s, feature_columns(f)


def late_features_with_split(spark, sf):
    """The same working set for operators that move its rows: the narrow rows,
    kept, what attaches their features, and the features; wide rows and nothing
    to attach if the vectors are not broadcast."""
    keyed = txn_ml_keyed(spark, sf)
    if keyed is None:
        f, cols = features_with_split(spark, sf)
        return f, None, cols
    t, vec = keyed
    t = t.persist(StorageLevel.MEMORY_AND_DISK)
    t = sampling.grouped_split(t, "vec_id", 0.2, "Class", seed=42)
    scaler = fit_feature_scaler(t.where(F.col("split") == "train"))
    late = LateFeatures(["vec_row", "Time", "Amount"], lambda d: engineer_features(d.join(vec, "vec_row"), scaler, keep=[c for c in d.columns if c != "vec_row"]))
    return t, late, feature_columns(late.add(t))


@register("isolation_forest_scores", "M1 M2 A7 P7")
def isolation_forest_scores(spark, sf):
    f, cols = features_with_split(spark, sf)
    s = forest.fit_and_score(f, F.col("split") == "train", cols, keep=["id", "split"], n_trees=100,
                             max_samples=256, contamination=0.1, seed=42)
    return s.select("id", "split", rounded("iso_score").alias("iso_score"), "iso_pred")


@register("reconstruction_scores", "M4 N2 A10 A7 P6 P4")
def reconstruction_scores(spark, sf):
    f, cols = features_with_split(spark, sf)
    normals = f.where((F.col("split") == "train") & (F.col("Class") == 0))
    model = reconstruct.fit_reconstruction(normals, cols, k=16, quantile=0.95)
    s = reconstruct.reconstruction_score(f, model)
    return s.select("id", "split", rounded("reconstruction_score").alias("reconstruction_score"),
                    "reconstruction_pred")


@register("autoencoder_scores", "M4 N2 A10 A7 P6 P4")
def autoencoder_scores(spark, sf):
    f, cols = features_with_split(spark, sf)
    model = autoencoder.fit_autoencoder(f.where((F.col("split") == "train") & (F.col("Class") == 0)), cols, epochs=10)
    s = reconstruct.reconstruction_score(f, model)
    return s.select("id", "split", rounded("reconstruction_score").alias("reconstruction_score"), "reconstruction_pred")


AUTO_FEATURES, AUTO_THRESHOLD = [f"V{i}" for i in range(1, 7)], 0.05


def fixed_autoencoder():
    """Layers 6 → 4 → 2 → 4 → 6 with weights by a rule: round(cos(k), 3) for the k-th."""
    import numpy as np

    model = autoencoder.Autoencoder(AUTO_FEATURES, (4, 2, 4), np.zeros(6), np.full(6, 2.0), threshold=AUTO_THRESHOLD)
    model.flat = np.round(np.cos(np.arange(1, model.weights.size + 1)), 3)
    return model


def _autoencoder_sql() -> str:
    model = fixed_autoencoder()
    w = model.weights.split(model.flat)
    z = [f"z{i}" for i in range(6)]
    x, ctes = z, ["l0 AS (SELECT id, " + ", ".join(f"{c} / 2.0 AS {n}" for c, n in zip(AUTO_FEATURES, z)) + " FROM txn_ml)"]
    for i in range(4):
        m, b = w[f"w{i}"], w[f"b{i}"]
        terms = [" + ".join([f"{c} * ({float(m[a, j])!r})" for a, c in enumerate(x)] + [f"({float(b[j])!r})"]) for j in range(m.shape[1])]
        x = [f"x{j}" for j in range(m.shape[1])]
        new = ", ".join(f"greatest(0, {t}) AS {c}" if i < 3 else f"{t} AS {c}" for t, c in zip(terms, x))
        ctes.append(f"l{i + 1} AS (SELECT id, {', '.join(z)}, {new} FROM l{i})")
    err = " + ".join(f"(x{j} - z{j}) * (x{j} - z{j})" for j in range(6))
    return "WITH " + ", ".join(ctes) + f", e AS (SELECT id, ({err}) / 6.0 AS err FROM l4) " \
        f"SELECT id, {R('err')} AS reconstruction_score, CAST(err > {AUTO_THRESHOLD} AS INTEGER) AS reconstruction_pred FROM e"


@register("autoencoder_fixed", "M4 A10 P6", with_views(_autoencoder_sql(), ml=True))
def autoencoder_fixed(spark, sf):
    """Errors of an autoencoder with fixed weights."""
    s = reconstruct.reconstruction_score(txn_ml(spark, sf, 6), fixed_autoencoder())
    return s.select("id", rounded("reconstruction_score").alias("reconstruction_score"), "reconstruction_pred")


@register("graph_node_scores", "M3 J1 J2 J3")
def graph_node_scores(spark, sf):
    f, late, cols = late_features_with_split(spark, sf)
    nodes = graph_model.graph_features(f, cols, hops=3, keep=("Class", "split"), late=late)
    model = graph_model.fit_graph_classifier(nodes.where(F.col("split") == "train"), cols)
    s = graph_model.graph_scores(model, nodes)
    return s.select("id", "split", "Class", rounded("graph_score").alias("graph_score"))


@register("graph_network_scores", "M3 J1 J2 J3 T6")
def graph_network_scores(spark, sf):
    """The trained network: three convolutions, the best epoch by validation AUC."""
    f, late, cols = late_features_with_split(spark, sf)
    net = graph_network.GraphNetwork(cols)
    blocks = graph_network.graph_blocks(f, net, "Class", "split", late=late, spread=True)
    net = graph_network.fit_graph_network(f, cols, epochs=30, blocks=blocks, net=net)
    s = graph_network.score_graph_network(f, net, blocks=blocks).join(f.select("id", "Class", "split"), "id")
    return s.select("id", "split", "Class", rounded("graph_score").alias("graph_score"))


FIXED_HIDDEN = 4


def fixed_network():
    """A network of two inputs with weights by a rule: round(sin(k), 3) for the k-th."""
    import numpy as np

    net = graph_network.GraphNetwork(["Amount", "Hour"], FIXED_HIDDEN, mean=np.zeros(2), scale=np.array([100.0, 24.0]))
    net.flat = np.round(np.sin(np.arange(1, net.weights.size + 1)), 3)
    return net


def _network_sql() -> str:
    net = fixed_network()
    w = net.weights.split(net.flat)

    def dense(names, m, b):
        return [" + ".join([f"{x} * ({float(m[i, j])!r})" for i, x in enumerate(names)] + [f"({float(b[j])!r})"]) for j in range(m.shape[1])]
    x = ["x0", "x1"]
    out = ["deg AS (SELECT dst AS id, count(*) AS d FROM sym GROUP BY dst)", "n0 AS (SELECT id, Amount / 100.0 AS x0, Hour / 24.0 AS x1 FROM pos)"]
    for i in range(graph_network.LAYERS):
        sums = ", ".join(f"sum(n.{c} / sqrt(dg.d)) / sqrt(any_value(dd.d)) AS {c}" for c in x)
        out.append(f"p{i} AS (SELECT s.dst AS id, {sums} FROM sym s JOIN n{i} n ON n.id = s.src JOIN deg dg ON dg.id = s.src JOIN deg dd ON dd.id = s.dst GROUP BY s.dst)")
        nxt = dense(x, w[f"w{i}"], w[f"b{i}"])
        x = [f"x{j}" for j in range(len(nxt))]
        out.append(f"n{i + 1} AS (SELECT id, " + ", ".join(f"greatest(0, {e}) AS {c}" for e, c in zip(nxt, x)) + f" FROM p{i})")
    top = dense(x, w["u"], w["c"])
    q = [f"q{j}" for j in range(len(top))]
    out.append("q AS (SELECT id, " + ", ".join(f"greatest(0, {e}) AS {c}" for e, c in zip(top, q)) + f" FROM n{graph_network.LAYERS})")
    return ", " + ", ".join(out) + f" SELECT id, {R('1.0 / (1.0 + exp(-(' + dense(q, w['v'], w['e'])[0] + ')))')} AS graph_score FROM q"


@register("graph_network_fixed", "M3", _graph_sql(_network_sql()))
def graph_network_fixed(spark, sf):
    """One forward pass with fixed weights."""
    t = txn(spark, sf).withColumn("Hour", hour_of_day("Time"))
    return graph_network.score_graph_network(t, fixed_network()).select("id", rounded("graph_score").alias("graph_score"))


def _ensemble_split(spark, sf):
    s = scores(spark, sf)
    from ..operators.ensemble_features import ensemble_features

    e = ensemble_features(s)
    return sampling.stratified_split(e, 0.3, "Class", seed=42, key="id")


@register("ensemble_scores", "M6 M8")
def ensemble_scores(spark, sf):
    e = _ensemble_split(spark, sf)
    model = ensemble.fit_ensemble(e.where(F.col("split") == "train"), "lr", {"C": 1.0})
    p = ensemble.predict_proba(model, e.where(F.col("split") == "test"))
    return p.select("id", "Class", rounded("ensemble_prob").alias("ensemble_prob"), "ensemble_pred")


@register("ensemble_feature_importance", "M12 T5")
def ensemble_feature_importance(spark, sf):
    e = _ensemble_split(spark, sf)
    model = ensemble.fit_ensemble(e.where(F.col("split") == "train"), "rf",
                                  {"n_estimators": 100, "max_depth": 5})
    return ensemble.feature_importance(model)


@register("ensemble_search", "M7 R5 T6")
def ensemble_search(spark, sf):
    e = _ensemble_split(spark, sf).where(F.col("split") == "train").drop("split")
    folds = sampling.stratified_folds(e, 3, "Class", seed=42, key="id")
    trials = ensemble.search(folds, n_trials=20, fold_col="fold")
    return ensemble.best_trial(trials)


@register("ensemble_adaptive_search", "M7 R5 T6")
def ensemble_adaptive_search(spark, sf):
    """The best setting judged on all rows, by adaptive proposals."""
    e = _ensemble_split(spark, sf).where(F.col("split") == "train").drop("split")
    folds = sampling.stratified_folds(e, 3, "Class", seed=42, key="id")
    trials = tuning.adaptive_search(folds, n_trials=12)
    return ensemble.best_trial(trials.where("share = 1.0")).drop("share")


BLEND_WEIGHTS = (0.0, 0.25, 0.5, 0.75, 1.0)


def _blend_auc(w: float) -> str:
    return R(_auc_sql(f"round({w!r} * graph_score + {1 - w!r} * reconstruction_score, 9)"))


_BLENDS = _scores_sql(", t AS (" + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS trial, {w!r}::DOUBLE AS weight, {_blend_auc(w)} AS auc" for i, w in enumerate(BLEND_WEIGHTS)) + ") ")


def _blend_trials(spark, sf):
    names = [f"{i}" for i in range(len(BLEND_WEIGHTS))]
    s = scores(spark, sf)
    s = s.select("Class", *[rounded(F.lit(w) * F.col("graph_score") + F.lit(1 - w) * F.col("reconstruction_score"), 9).alias(n)
                            for n, w in zip(names, BLEND_WEIGHTS)])
    c = metrics.model_comparison(s, {n: (n, False) for n in names})
    weight = F.element_at(F.array(*map(F.lit, BLEND_WEIGHTS)), F.col("trial") + 1)
    return c.select(F.col("model").cast("int").alias("trial"), rounded("auc").alias("auc")).select("trial", weight.alias("weight"), "auc")


@register("blend_trials", "T6 M9", _BLENDS + "SELECT trial, weight, auc FROM t")
def blend_trials(spark, sf):
    """A trial table: the AUC of fixed blends of two scores."""
    return _blend_trials(spark, sf)


@register("blend_best", "T6 M9", _BLENDS + "SELECT trial, weight, auc FROM t ORDER BY auc DESC, trial LIMIT 1")
def blend_best(spark, sf):
    """Keep-best over that trial table."""
    return ensemble.best_trial(_blend_trials(spark, sf))


FOREST_FEATURES, FOREST_TREES, FOREST_OFFSET = ["V1", "V2", "V3"], 5, -0.45


def fixed_forest():
    """Complete trees of depth 2 by a rule: split k at round(0.2 sin(k), 3), leaf k of 1 + 7k mod 40 rows."""
    import math

    import pandas as pd

    nodes = []
    for t in range(FOREST_TREES):
        for n in range(7):
            k, inner = 7 * t + n, n < 3
            nodes.append((t, n, (t + n) % 3 if inner else -1, round(0.2 * math.sin(k), 3) if inner else None,
                          2 * n + 1 if inner else -1, 2 * n + 2 if inner else -1, 0 if inner else 1 + 7 * k % 40, (n + 1).bit_length() - 1))
    pdf = pd.DataFrame(nodes, columns=[f.name for f in forest.NODE_SCHEMA.fields])
    return forest.IsolationForestModel(FOREST_FEATURES, pdf, 256, FOREST_TREES, FOREST_OFFSET, 0.1)


def _forest_sql() -> str:
    nodes = fixed_forest().nodes.set_index(["tree", "node"])

    def length(n: str) -> str:  # average path length of n rows
        return f"CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END"

    def walk(t: int, n: int) -> str:
        r = nodes.loc[(t, n)]
        if r["feature"] < 0:
            return f"({int(r['depth'])} + {length(str(int(r['size'])))})"
        x = f"coalesce({FOREST_FEATURES[int(r['feature'])]}, 0)"
        return f"(CASE WHEN {x} < {float(r['threshold'])!r} THEN {walk(t, int(r['left']))} ELSE {walk(t, int(r['right']))} END)"
    total = " + ".join(walk(t, 0) for t in range(FOREST_TREES))
    return f"WITH d AS (SELECT id, -power(2.0, -(({total}) / {FOREST_TREES}.0) / ({length('256')})) - ({FOREST_OFFSET}) AS v FROM txn_ml) " \
        f"SELECT id, {R('v')} AS iso_score, CAST(v < 0 AS INTEGER) AS iso_pred FROM d"


@register("isolation_forest_fixed", "M2 P7", with_views(_forest_sql(), ml=True))
def isolation_forest_fixed(spark, sf):
    """Decision values and flags of a fixed forest."""
    s = forest.score_isolation_forest(txn_ml(spark, sf, 3), fixed_forest())
    return s.select("id", rounded("iso_score").alias("iso_score"), "iso_pred")


@register("ensemble_comparison", "M9 M11")
def ensemble_comparison(spark, sf):
    e = _ensemble_split(spark, sf)
    model = ensemble.fit_ensemble(e.where(F.col("split") == "train"), "lr", {"C": 1.0})
    test = ensemble.predict_proba(model, e.where(F.col("split") == "test"))
    base = metrics.model_comparison(test, {"graph": ("graph_score", False),
                                           "reconstruction": ("reconstruction_norm", False),
                                           "isolation_forest": ("iso_norm", False),
                                           "ensemble": ("ensemble_prob", False)})
    return base.select("model", rounded("auc").alias("auc"))


# -- checks of the model path that SQL can express --------------------------------

@register("grouped_split", "R2", with_views("""
WITH g AS (SELECT DISTINCT vec_id, Class FROM txn_ml),
r AS (SELECT vec_id, row_number() OVER (PARTITION BY Class ORDER BY md5(CAST(vec_id AS VARCHAR) || '-42'), vec_id) - 1 AS rn,
             count(*) OVER (PARTITION BY Class) AS cnt FROM g)
SELECT t.id, t.vec_id, t.Class, CASE WHEN rn < round(0.2 * cnt) THEN 'test' ELSE 'train' END AS split
FROM txn_ml t JOIN r USING (vec_id)""", ml=True))
def grouped_split(spark, sf):
    return sampling.grouped_split(txn_ml(spark, sf), "vec_id", 0.2).select("id", "vec_id", "Class", "split")


FIXED_K = 16
_ERROR = "(" + " + ".join(f"V{i} * V{i}" for i in range(FIXED_K + 1, ORACLE_WIDTH + 1)) + f") / {ORACLE_WIDTH}.0"


def _fixed_errors(spark, sf):
    """Reconstruction with a fixed component matrix (the first 16 axes), so
    the error of a row is the mean square of its other components."""
    import numpy as np

    t = txn_ml(spark, sf)
    cols = [c for c in t.columns if c.startswith("V")]
    model = reconstruct.ReconstructionModel(cols, [0.0] * len(cols), [1.0] * len(cols), np.eye(len(cols))[:, :FIXED_K], 0.0)
    err = reconstruct.reconstruction_score(t, model).select("id", "Class", "reconstruction_score").persist(StorageLevel.MEMORY_AND_DISK)
    return model, err


@register("reconstruction_fixed", "M4 A7 P6", with_views(f"""
WITH e AS (SELECT id, {_ERROR} AS err FROM txn_ml)
SELECT id, {R('err')} AS reconstruction_score, CAST(err > (SELECT quantile_cont(err, 0.95) FROM e) AS INTEGER) AS reconstruction_pred
FROM e""", ml=True))
def reconstruction_fixed(spark, sf):
    from ..operators.quantiles import exact_quantiles

    _, err = _fixed_errors(spark, sf)
    p95 = exact_quantiles(err, "reconstruction_score", [0.95])[0]
    return err.select("id", rounded("reconstruction_score").alias("reconstruction_score"),
                      (F.col("reconstruction_score") > F.lit(p95)).cast("int").alias("reconstruction_pred"))


@register("reconstruction_error_density", "A9 M4", with_views(f"""
WITH e AS (SELECT Class, round({_ERROR}, 9) AS x FROM txn_ml),
r AS (SELECT Class, min(x) AS lo, max(x) AS hi, count(*) AS cnt FROM e GROUP BY Class),
b AS (SELECT e.Class, lo, hi, cnt, CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin FROM e JOIN r USING (Class))
SELECT Class, bin, count(*) AS n, {R('count(*) / (any_value(cnt) * ((any_value(hi) - any_value(lo)) / 50))', 4)} AS density
FROM b GROUP BY Class, bin""", ml=True))
def reconstruction_error_density(spark, sf):
    from ..operators import profile

    _, err = _fixed_errors(spark, sf)
    h = profile.histogram(err.select("Class", rounded("reconstruction_score", 9).alias("x")), "x", 50, by="Class", density=True)
    return h.select("Class", "bin", "n", rounded("density", 4).alias("density"))


@register("ensemble_serving", "M8 S3 N3 M5", REGISTRY["ensemble_features"].sql)
def ensemble_serving(spark, sf):
    """Score range fitted and saved by training, loaded and applied by serving."""
    from ..operators.ensemble_features import apply_score_range, fit_score_range
    from ..schemas import ENSEMBLE_FEATURES
    from ..session import scratch_path
    from ..sources.models import load_params, save_params

    s = scores(spark, sf)
    path = scratch_path(spark, "score-range")
    save_params(fit_score_range(s), path)
    e = apply_score_range(s, load_params(spark, path)).select("id", "Class", *ENSEMBLE_FEATURES)
    return e.select("id", "Class", *[rounded(c).alias(c) if c.endswith(("norm", "score")) else F.col(c) for c in ENSEMBLE_FEATURES])
